"""Token counts against the sentencepiece library over whole texts."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from tracewarden.llm import counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
library = SentencePieceProcessor(model_file=PATH)
PARTS = ["a", "B", " ", "  ", "    ", "\n", "\t", "1", "23", "'s", "\xa0", "　", "\x85", "<s>", "</s>", "<unk>", "<0x0A>", "▁", "▁a",
         "日本", "!", "..", "ñ", "é", "ﬁ", "😀", "_", "the ", " of", "×", "½", "​", "ß", "\x00", "\r\n", "ing", "https://"]
odd = st.lists(st.sampled_from(PARTS), max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(odd, max_size=6), st.integers(1, 6))
def test_split_texts_count_as_whole_ones(texts, fragment):
    before, counts.FRAGMENT = counts.FRAGMENT, fragment
    try:
        own = counts.pieces(PATH)
        assert own.splits
        assert own.counts(iter(texts), len(texts)).tolist() == [len(library.encode(t)) for t in texts]
    finally:
        counts.FRAGMENT = before


def test_long_texts_are_split():
    text = "Some words, and more of them.\n日本語のテキスト  " * 3000
    parts = list(counts.pieces(PATH).fragments(text))
    assert len(parts) > 5 and max(len(p) for p, _ in parts) < counts.FRAGMENT + 100
    assert counts.pieces(PATH).counts(iter([text, "a" * 50_000]), 2).tolist() == [len(library.encode(text)), len(library.encode("a" * 50_000))]


def test_odd_rows(spark):
    rows = [(1, "a b", 1), (1, "a b", 1), (None, "x" * 9, 2), (2, None, 3), (3, "", 4), (4, "word " * 5000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens int").withColumnRenamed("tokens", "Tokens")
    found = counts.counted(docs, PATH)
    assert found.columns == ["doc_id", "text", "Tokens", "tokens_"]
    got = sorted(((r.doc_id, r.text, r.Tokens, *r.tokens_) for r in found.collect()), key=str)
    want = [(*r, len((r[1] or "").encode()), n := len(library.encode(r[1] or "")), n > 4096) for r in rows]
    assert got == sorted(want, key=str)
    assert counts.counted(docs.limit(0), PATH).collect() == []


@pytest.mark.parametrize("sf", ["0.001"])
def test_query_is_whole(spark, sf):
    from tracewarden.llm.queries import QUERIES

    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in QUERIES["op13_token_counts"](spark, f"/root/testdata/sf{sf}").collect())
    want = [(r.doc_id, len((r.text or "").encode()), n := len(library.encode(r.text or "")), n > 4096) for r in docs]
    assert got == sorted(want)
