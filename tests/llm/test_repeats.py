"""Substring dedup against all windows of all texts."""

import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tracewarden.llm import repeats


def slow(texts, width):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def test_against_all_windows(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)] + ["ñ", "a b", "x"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [text(n) for n in (34, 35, 36, 60, 200)]
    docs = [None, "", " \n\t", "a", " ".join(["same"] * 90), " ".join(["p", "q"] * 70), " ".join(text(34)), " ".join(text(20_000))]
    for _ in range(60):
        body = text(rng.randrange(0, 150))
        for _ in range(rng.randrange(0, 3)):
            at, p = rng.randrange(0, len(body) + 1), rng.choice(passages)
            cut = p[rng.randrange(0, 4):]
            body[at:at] = cut
        docs.append((" " if rng.random() < 0.8 else "\n ").join(body))
    docs += docs[8:14] * 3
    frame = spark.createDataFrame(
        [(i // 2 if i % 7 else None, t, "k") for i, t in enumerate(docs)], "doc_id bigint, text string, __key string").repartition(4)
    got = Counter((r.doc_id, r.text, r.repeats.n_words, r.repeats.n_removed, r.repeats.kept)
                  for r in repeats.remove_repeats(frame).collect())
    want = Counter((i // 2 if i % 7 else None, t, *s) for (i, t), s in zip(enumerate(docs), slow(docs, 35)))
    assert got == want
    assert sum(s[1] > 0 for s in slow(docs, 35)) > 20


def test_spans_are_maximal(spark):
    p = " ".join(f"p{i}" for i in range(50))
    frame = spark.createDataFrame([(1, f"a b {p} c"), (2, f"d {p}")], "doc_id bigint, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.repeats.spans] for r in repeats.remove_repeats(frame).collect()}
    assert got == {1: [(2, 52)], 2: [(1, 51)]}


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=0, max_size=200))
def test_segments_hold_each_window_once(words):
    anchor, content, start, n = repeats.segments(words, 35)
    assert sum(n.tolist()) == max(0, len(words) - 34)
    assert start.tolist() == [sum(n[:k].tolist()) for k in range(len(n))]
    # The same content means the same words.
    by = {}
    for a, c, s, k in zip(anchor.tolist(), content.tolist(), start.tolist(), n.tolist()):
        assert by.setdefault((a, c), words[s:s + k + 34]) == words[s:s + k + 34]
