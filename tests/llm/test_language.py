"""Language mixtures: held-out accuracy, EM against a grid, odd inputs."""

import zlib

import numpy as np

from tracewarden.llm import language
from tracewarden.llm.queries import QUERIES

WORDS = {"en": "the and of that with this have from they which would there", "de": "und der die nicht ist ein mit sich auch werden über zwischen",
         "fr": "le les des une dans pour que est avec sont être où"}


def text_of(lang, n, rng):
    return " ".join(rng.choice(WORDS[lang].split(), n))


def model_of():
    rng = np.random.default_rng(3)
    langs = sorted(WORDS)
    counts = np.stack([np.bincount(language.trigrams(text_of(x, 3000, rng).encode()), minlength=language.BUCKETS) for x in langs])
    return language.Model(langs, counts.astype(float)), rng


def test_mixtures():
    model, rng = model_of()
    for lang in WORDS:
        assert model.mixture(text_of(lang, 60, rng).encode())[0][0] == lang
        assert len(model.mixture(text_of(lang, 60, rng).encode())) == 1
    both = model.mixture((text_of("en", 140, rng) + " " + text_of("de", 60, rng)).encode())
    assert [x for x, _ in both] == ["en", "de"] and 0.55 < both[0][1] < 0.85
    assert {x for x, _ in model.mixture(" ".join(text_of(x, 80, rng) for x in WORDS).encode())} == set(WORDS)
    assert model.mixture(None) == model.mixture(b"") == model.mixture(b"12 %% 3\n") == []
    assert language.Model([], np.zeros((0, language.BUCKETS))).mixture(b"words") == []


def test_em_finds_the_maximum():
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.ones(30), 2)
    counts = rng.multinomial(4000, 0.3 * p[0] + 0.7 * p[1])
    _, found = language._proportions(p, counts, np.ones(1))
    best = max(float(counts @ np.log(a * p[0] + (1 - a) * p[1])) for a in np.linspace(0.001, 0.999, 999))
    assert found > best - 2


def test_query_on_the_table(spark):
    rows = QUERIES["op7_language_mixture"](spark, "/root/testdata/sf0.001").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    rows = [(1, "the and of", "en", 1), (1, "the and of", "en", 1), (None, "the of", "en", 2), (2, None, "en", 3), (3, "", None, 4),
            (5, "42", "de", 5), (6, "und der die", None, 6), (7, "x" * 300_000, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, language int")
    model = language.learn(docs.filter(~language.held_out()))
    assert model.languages == ["en"]
    got = sorted((r.doc_id or 0, r.language.pred) for r in language.identified(docs, model).collect())
    assert got == [(0, "en"), (1, "en"), (1, "en"), (2, "und"), (3, "und"), (5, "und"), (6, "en"), (7, "en")]
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == 5
    assert language.keep_identified(docs.limit(0)).collect() == []
    assert language.keep_identified(docs.withColumn("lang", language.F.lit(None).cast("string"))).count() == 5
