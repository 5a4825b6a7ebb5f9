"""SimHash near-duplicates against a comparison of all pairs."""

from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tracewarden.llm import simhash

SCHEMA = "doc_id bigint, text string"


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(ids, fps):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(fps)):
        groups[root(i)].append(i)
    out = [None] * len(fps)
    for members in groups.values():
        least = min((ids[i] for i in members if ids[i] is not None), default=None)
        for i in members:
            out[i] = least
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["Éa", " x", "THE"]
    docs = [None, "", " \n", "one", "one two", "A b\tc", "a b c", "A b c d"]
    base = [list(rng.choice(vocabulary, 120)) for _ in range(12)]
    for words in base:
        docs.append(" ".join(words))
        for edits in (1, 1, 1, 2, 4):
            words = list(words)
            for at in rng.integers(0, 120, edits):
                words[at] = str(rng.choice(vocabulary))
            docs.append(" ".join(words))
    docs += docs[5:20]
    docs.append(" ".join(rng.choice(vocabulary, 40_000)))
    ids = list(range(100, 100 + len(docs)))
    ids[3], ids[7] = None, 101
    return list(zip(ids, docs))


def test_against_all_pairs(spark, rows):
    frame = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA + ", fp string, component long").repartition(3)
    got = sorted((r[0] if r[0] is not None else -1, r[1], r[2]) for r in simhash.near_duplicates(frame).collect())
    ids, fps = [i for i, _ in rows], [slow_fingerprint(t) for _, t in rows]
    want = sorted((i if i is not None else -1, f"{f:016x}", c) for i, f, c in zip(ids, fps, slow_components(ids, fps)))
    assert got == want
    assert len({c for _, _, c in want}) < len(want) - 20


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=6), st.integers(0, 10**6), st.booleans())
def test_trie_keeps_components(seeds, salt, tiny):
    rng = np.random.default_rng(salt)
    some = set(seeds)
    for _ in range(120):
        x = int(rng.choice(np.array(sorted(some), dtype=np.uint64)))
        for b in rng.integers(0, 64, rng.integers(1, 6)):
            x ^= 1 << int(b)
        some.add(x)
    fps = np.array(sorted(some), dtype=np.uint64)
    direct, simhash.DIRECT = simhash.DIRECT, 4 if tiny else 1 << 16
    try:
        roots = simhash.trie_links(fps)
    finally:
        simhash.DIRECT = direct
    assert roots.tolist() == slow_components(list(range(len(fps))), [int(f) for f in fps])


def test_buckets_bring_all_links_together(spark):
    rng = np.random.default_rng(1)
    pairs = []
    for _ in range(200):
        x = int(rng.integers(0, 2**63)) * 2 + 1
        y = x
        for b in rng.choice(64, 3, replace=False):
            y ^= 1 << int(b)
        pairs.append((x, y))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    frame = spark.createDataFrame([(signed(v),) for p in pairs for v in p], "fp bigint")
    found = {(r[0], r[1]) for r in simhash.links(frame).collect()}
    for x, y in pairs:
        assert (signed(max(x, y)), signed(min(x, y))) in found
