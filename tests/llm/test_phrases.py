"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracewarden.llm import phrases


def slow(rows, least, longest=5, keep=2000, share=100):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, min(longest, len(words) - i) + 1):
                    f[lang, *words[i:i + m]] += 1
    found = {p: a for p, a in f.items() if a >= least and len(p) > 2}
    out = {}
    for p, a in found.items():
        lang, words = p[0], p[1:]
        if any(q[0] == lang and len(q) > len(p) and 100 * b >= share * a
               and any(q[i:i + len(words)] == words for i in range(1, len(q) - len(words) + 1)) for q, b in found.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, *words[:k]] * f[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, *words[:k]], f[lang, *words[k:]]))
    return sorted((lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, rs in out.items()
                  for rank, (s, a, p, l, r) in enumerate(sorted(rs)[:keep], 1))


def made(n=300):
    random.seed(3)
    words = ["the", "The", "of", "a", "é", "日本", "x\x00y", "\x1c", "red", "fox", "<s>", "\xa0"]
    texts = ["", None, "  ", "...", "one two three four five six", "lonely"]
    for _ in range(n):
        texts.append("".join(random.choice(words) + random.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "\x0b"])
                             for _ in range(random.randrange(30))))
    texts += ["stock phrase that always returns whole"] * 20
    return [(t, random.choice(["en", "fr", None, "und"])) for t in texts]


@pytest.mark.parametrize("hot", [phrases.HOT, 12, 0])
def test_equal_to_plain_counts(spark, monkeypatch, hot):
    monkeypatch.setattr(phrases, "MAX_HOT", 1 << 40)
    rows = made()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    for least, keep, share in ((6, 2000, 100), (3, 7, 60)):
        found = phrases.collocations(docs, least, 5, keep, share, hot=hot)
        assert sorted(tuple(r) for r in found.collect()) == slow(rows, least, 5, keep, share)


def test_buffers_and_groups_of_any_size():
    sizes = []
    for rows_at_once in (1, 50, 1 << 19):
        phrases.GROUP_ROWS, before = rows_at_once, phrases.GROUP_ROWS
        try:
            table = pa.table({"lang": ["a"] * 6, "key": ["x y"] * 3 + ["x z"] * 3, "routed": pa.array([2] * 6, pa.int32()),
                              "words": [list("xyab"), list("xya"), list("xyb")] + [list("xzabc")] * 3, "f": [5, 3, 1, 4, 4, 4]})
            found = [b.to_pylist() for b in phrases._count_groups(5, 4)(iter(table.to_batches(max_chunksize=1)))]
            sizes.append(sorted((r["phrase"], r["f"]) for b in found for r in b))
        finally:
            phrases.GROUP_ROWS = before
    assert sizes == [[("x y a", 8), ("x y a b", 5), ("x z a", 12), ("x z a b", 12), ("x z a b c", 12)]] * 3


def test_scores_beyond_64_bits(spark):
    big = 10 ** 14
    row = spark.createDataFrame([("en", "a b", 2, big, 1)], "lang string, phrase string, size int, f long, x int")
    counts = row.select("lang", "phrase", "size", "f").unionByName(
        spark.createDataFrame([("en", "a", 1, big + 3), ("en", "b", 1, big + 7)], "lang string, phrase string, size int, f long"))
    totals = spark.createDataFrame([("en", 9 * 10 ** 16)], "lang string, n long")
    before = phrases.phrase_counts
    phrases.phrase_counts = lambda *_: (counts, totals)
    try:
        found = phrases.collocations(row).collect()
    finally:
        phrases.phrase_counts = before
    assert [r.score for r in found] == [1000 * big * 9 * 10 ** 16 // ((big + 3) * (big + 7))]


def test_odd_tables(spark):
    docs = spark.createDataFrame([("a b " * 200, None, 1)], "text string, lang string, phrase int").withColumn("f", F.lit(1))
    assert phrases.collocations(docs.limit(0)).collect() == []
    found = {r.phrase: (r.lang, r.a, r.n) for r in phrases.collocations(docs).collect()}
    assert found["a b a b a"] == ("und", 198, 400) and found["a b"] == ("und", 200, 400)
