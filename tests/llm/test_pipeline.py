"""The pipeline, stage by stage, against plain versions on the smallest table."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_quality import slow as slow_measures
from tests.llm.test_repeats import slow as slow_repeats
from tests.llm.test_similar import slow_keep
from tracewarden.llm import simhash
from tracewarden.session import written_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(written_table(stage(spark, docs[-1], SF), f"test-{name}"))
    return docs


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=str)


def test_columns_stay(stages):
    assert all(d.dtypes == stages[0].dtypes for d in stages[1:-1])


def test_quality_drops_only_failing_texts(stages):
    before, after = rows(stages[0]), rows(stages[1])
    assert not Counter(after) - Counter(before)
    def failed(text):
        m = slow_measures(text)
        return m[0] < 10 or 100 * m[4] > 20 * m[0]
    assert not any(failed(r[1]) for r in after)
    good = [r for r in before if not failed(r[1])]
    assert len(after) >= 0.9 * len(good)


def test_language_keeps_all_clear_texts(stages):
    assert rows(stages[1]) == rows(stages[2])


def test_one_of_each_component(stages):
    before, after = rows(stages[2]), rows(stages[3])
    kept, pairs = slow_keep([(r[0], r[1]) for r in before])
    assert pairs > 0 and after == [r for r in before if r[0] in set(kept)]
    assert len(after) < len(before)


def test_repeats_go(stages):
    before = rows(stages[3])
    want = []
    for r, (n, gone, kept) in zip(before, slow_repeats([r[1] for r in before], 35)):
        if not gone:
            want.append(r)
        elif gone < n:
            want.append((r[0], kept, r[2], r[3], len(kept)))
    assert rows(stages[4]) == sorted(want, key=str)


def test_packed(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in rows(stages[4]):
        ids = [*library.encode(r[1], add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r[0], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    got = stages[5].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert len({r.sequence_id for r in got}) <= 1.05 * sum(r.length for r in got) / 2048 + 1


def test_odd_rows(spark):
    text = " ".join(f"word{i} runs" for i in range(40))
    odd = [(None, text, "en", 1), (None, text, "en", 1), (3, text, None, 2), (4, None, "en", 3), (4, "", "fr", 4)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, key int")
    for name in ("key", "marks", "repeats", "quality", "stratum", "cutoffs", "language", "fp"):
        docs = docs.withColumn(name, docs["key"])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(3, text), (4, "")]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.withColumn("n_chars", docs["key"]).limit(0), SF).collect() == []
        stage(spark, docs, SF).collect()
