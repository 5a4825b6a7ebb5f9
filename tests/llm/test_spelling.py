"""Spelling variants against a comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tracewarden.llm import spelling


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow(n, ratio=10):
    form, out = {}, []
    for w in n:
        close = sorted((-n[v], v) for v in n if near(v, w))
        form[w] = close[0][1] if close and -close[0][0] >= ratio * n[w] else None
        out.append([w, form[w], None, n[w], len(close), n[form[w]] if form[w] else None])
    for row in out:
        row[2] = row[0]
        while form[row[2]]:
            row[2] = form[row[2]]
    return sorted((tuple(r) for r in out), key=str)


def slow_words(rows, shortest=7):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= shortest:
                n[run] += 1
    return n


@pytest.mark.parametrize("alphabet", ["ab", "abé😀"])
def test_variants_equal_a_comparison_of_all(spark, alphabet):
    random.seed(len(alphabet))
    n = {"".join(random.choice(alphabet) for _ in range(random.randrange(1, 7))): random.choice([1, 2, 2, 3, 20, 25, 300, 4000])
         for _ in range(150)}
    words = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    got = spelling.variants(words, fewest=2)
    assert sorted((tuple(r) for r in got.collect()), key=str) == slow({w: k for w, k in n.items() if k >= 2})


def test_long_chains_of_forms(spark):
    n = {"a" * 9 + "b" * k: 10 ** (15 - k) for k in range(15)}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    found = {r.word: r.root for r in spelling.variants(words).collect()}
    assert set(found.values()) == {"a" * 9} and len(found) == 15


def test_words_of_documents(spark):
    rows = [(i, "Straße STRASSE façade×÷ Élégance élégance " + f"wordword{i % 7} " + "x" * 3 + " misspelling Misspelling" * 3) for i in range(300)]
    rows += [(None, "nullable identity"), (None, None), (1, ""), (2, "tiny"), (2, "Longestword" * 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit(1), "n": F.lit(2), "h": F.lit(3)})
    want = slow_words(rows)
    assert any("mispelling" in w or "misspeling" in w for w in want)
    assert {r.word: r.n for r in spelling.document_words(docs, 7, 31).collect()} == dict(want)
    plain = {r.word for r in spelling.document_words(docs, 7).collect()}
    assert "misspelling" in plain and "straße" not in plain
    got = spelling.variants(spelling.document_words(docs, 7, 31))
    assert sorted((tuple(r) for r in got.collect()), key=str) == slow({w: k for w, k in want.items() if k >= 2})


def test_odd_tables(spark):
    words = spark.createDataFrame([("same", 1, 0), ("same", 1, 1), (None, 9, 0), ("", 9, 0)], "word string, n long, form int")
    assert [tuple(r) for r in spelling.variants(words).collect()] == [("same", None, "same", 2, 0, None)]
    assert spelling.variants(words.limit(0)).collect() == []
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.document_words(docs, 7, 31)).collect() == []


def test_ranges_are_bounded_by_the_alphabet(spark):
    words = spark.createDataFrame([("abcdef" + c + str(k), 5) for c in "uvwxyz" for k in range(20)], "word string, n long")
    most = spelling.rotations(words).groupBy("range").count().agg(F.max("count")).first()[0]
    assert most <= 20 + 1
