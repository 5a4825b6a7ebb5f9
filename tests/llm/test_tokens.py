"""Forced-boundary BPE, the remembering encoder, wavelet files and packing against the tokenizers library and plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tracewarden.llm import bpe, encode, packing, wavelet
from tracewarden.session import new_folder, written_table

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
PARTS = ["a", "B", " ", "  ", "\n", "\t", "1", "23", "'s", "'", " 'll", "\xa0", " ", "\x1c", "\x85", "<|endoftext|>", "<|startoftext|>", "<|",
         "日本", "!", "..", "ñ", "İ", "ΑΣ", "ſ", "é", "é", "ﬁ", "😀", "_", "the ", "×", "Å", "</w>", "½", "​", "ß", "\x00", "\r\n"]
odd = st.lists(st.sampled_from(PARTS), max_size=25).map("".join)
libraries = {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}


def library_ids(path, text):
    return libraries[path].encode(text or "", add_special_tokens=False).ids


def plain(ids):
    return np.frombuffer(ids, "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(odd)
def test_encoders_equal_the_library(text):
    for path in (WORD, BYTE):
        assert plain(encode.encoder(path)(text.encode())) == library_ids(path, text)
    own = bpe.tokenizer(WORD)
    ids = own.encode(text.encode())
    assert plain(ids) == library_ids(WORD, text)
    assert own.decode(ids).decode() == libraries[WORD].decode(plain(ids), skip_special_tokens=False)


def test_forced_boundaries_cut():
    own = bpe.tokenizer(WORD)
    letters = "".join(own.letters[b] for b in "xqzjvé".encode())
    assert len(own.cuts(letters)) > 1 and "".join(own.cuts(letters)) == letters


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=300), st.integers(1, 70_000))
def test_wavelet_matrix(ids, most):
    ids = np.array(ids, dtype="<u4") % np.uint32(most)
    m, docs, starts, shard = wavelet.from_file(wavelet.to_file(wavelet.WaveletMatrix.of(ids), [4, None], np.array([0, 1, len(ids)]), 77))
    assert (m.ids() == ids).all() and docs == [4, None] and starts.tolist() == [0, 1, len(ids)] and shard == 77
    for at in range(0, len(ids), 17):
        token = int(ids[at])
        before = int((ids[:at] == token).sum())
        assert m.access(at) == token and m.rank(token, at) == before and m.select(token, before) == at
    assert m.rank(1 << 30, len(ids)) == 0
    with pytest.raises(IndexError):
        m.select(1 << 30, 0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=150))
def test_sum_of_squares(lengths):
    bins, used = packing.SumOfSquares(64), Counter()
    slow = []  # gaps of open sequences
    for n in lengths:
        fits = {g for g in slow if g >= n}
        if fits:
            def after(g):
                c = Counter(slow)
                c[g] -= 1
                c[g - n] += 1
                return sum(v * v for k, v in c.items() if k), g
            g = min(fits, key=after)
            slow.remove(g)
            slow.append(g - n)
        else:
            g = 64
            slow.append(64 - n)
        s, at = bins.place(n)
        assert at == used[s] == 64 - g
        used[s] += n
    assert all(v <= 64 for v in used.values()) and len(used) == bins.opened


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 60))) for _ in range(150)]
    texts += [None, "", " ", "word " * 5000, "x" * 5000, texts[0], texts[0]]
    ids = [i * 3 % 101 if i % 10 else None for i in range(len(texts))]
    return list(zip(ids, texts)) + [(4, "same"), (4, "same")]


def frame(spark, rows):
    return spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "doc_id long, text string, offset int, bpe string").repartition(3)


def test_bpe_rows(spark, rows):
    got = Counter((r.doc_id, r.bpe.n_tokens, bytes(r.bpe.ids), r.bpe.decoded, r.bpe.ids_sha256) for r in bpe.encoded(frame(spark, rows), WORD).collect())
    want = Counter()
    for i, t in rows:
        ids = library_ids(WORD, t)
        b = np.array(ids, "<u4").tobytes()
        want[i, len(ids), b, libraries[WORD].decode(ids, skip_special_tokens=False), hashlib.sha256(b).hexdigest()] += 1
    assert got == want
    assert bpe.encoded(frame(spark, rows).limit(0), WORD).collect() == []


def test_packing_rows(spark, rows):
    stored = written_table(packing.pieces(frame(spark, rows), BYTE, 0, size=128, with_ids=True), "test-pieces")
    packed = packing.pack(stored, 128, task_pieces=100)
    got = packed.collect()
    want = Counter()
    for i, t in rows:
        ids = [*library_ids(BYTE, t), 0]
        first = len(ids) % 128 or 128
        cuts = [0, *range(first, len(ids) + 1, 128)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    total = sum(r.length for r in got)
    assert len(filled) <= 1.1 * total / 128 + 2
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in got:
        assert whole[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)
    assert packing.packed_documents(frame(spark, rows).limit(0), BYTE, 0).collect() == []


def test_wavelet_files(spark, rows, monkeypatch):
    monkeypatch.setattr(wavelet, "SHARD_TOKENS", 500)
    monkeypatch.setattr(wavelet, "TASK_BYTES", 8000)
    folder = f"file://{new_folder(spark, 'test-wavelet')}"
    shards = wavelet.write(frame(spark, rows), WORD, 1, folder)
    assert shards.count() > 6
    got = wavelet.read(spark, folder, shards).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at, want = 0, Counter()
    for i, t in order:
        ids = [*library_ids(WORD, t), 1]
        want[i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        at += len(ids)
    assert Counter(tuple(r) for r in got) == want
    assert wavelet.stored_tokens(frame(spark, rows).limit(0), WORD, 1).collect() == []


def test_encoder_remembers_more_fragments_than_a_memo_by_default():
    import public_tokenizers

    from tracewarden.llm.encode import Encoder
    from tracewarden.llm.words import MEMO_ENTRIES

    encode = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    encode.memo.update((b"%d" % i, b"") for i in range(MEMO_ENTRIES))
    first = encode(b"anew")
    assert encode.memo[b"anew"] == first and len(encode.memo) == MEMO_ENTRIES + 1


def test_planes_do_not_change_the_ids_given():
    from tracewarden.llm.wavelet import WaveletMatrix

    for ids in ([], [0], [0, 0], [1 << 16, 3, 0, 1 << 16], [5, 2, 7, 7, 0, 1]):
        given = np.array(ids, dtype=np.uint32)
        matrix = WaveletMatrix.of(given)
        assert given.tolist() == ids == matrix.ids().tolist() == [matrix.access(i) for i in range(len(ids))]
