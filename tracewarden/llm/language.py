"""Language identification as a mixture of languages.

A text is a bag of letter trigrams (lower case, words padded with a space), hashed to ``BUCKETS``. Each language has the bucket
frequencies of all its training texts. For a text, expectation-maximisation estimates in which proportions the
languages produced its trigrams; the set of languages grows one by one while the likelihood gains more than the penalty
for another language. The likelihood is concave in the proportions, so its slope at the present ones bounds what
a further language can gain: most texts are settled by that bound without any iteration.

The model is a table of languages x ``BUCKETS`` counts, summed by Spark over all training texts. It is the only thing that
reaches the driver, and its size doesn't depend on the number of documents; more than ``MAX_LANGUAGES`` learned values raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewarden.llm.words import free_name, per_document, texts

BUCKETS = 1 << 14
MAX_LANGUAGES = 1000
#: What a further language must gain: this much log-likelihood a trigram, and half a logarithm of their number (BIC).
GAIN = 0.02
ITERATIONS, PRECISION = 60, 1e-4
UNDETERMINED = "und"

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def trigrams(text: bytes | None) -> np.ndarray:
    """Buckets of the letter trigrams of a text whose middle is a letter; empty without letters."""
    points = np.frombuffer((text or b"").decode().lower().encode("utf-32-le"), dtype="<u4")
    c = np.zeros(len(points) + 2, dtype=np.uint64)
    c[1:-1] = np.where(_is_letter()[points], points, 0)
    mixed = (c[:-2] * np.uint64(0x9E3779B1) + c[1:-1]) * np.uint64(0x85EBCA77) + c[2:]
    mixed = mixed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 14)
    return mixed[c[1:-1] > 0].astype(np.int64)


class Model:
    """Bucket frequencies by language, smoothed by half a count."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.p = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)

    def mixture(self, text: bytes | None) -> list[tuple[str, float]]:
        """Languages of a text with their proportions, the largest first; empty if undetermined."""
        found = trigrams(text)
        if not len(found) or not self.languages:
            return []
        buckets, counts = np.unique(found, return_counts=True)
        p, n = self.p[:, buckets], len(found)
        penalty = GAIN * n + 0.5 * np.log(n)
        single = np.log(p) @ counts
        chosen = [int(single.argmax())]
        share, value = np.ones(1), float(single.max())
        while len(chosen) < len(self.languages):
            slope = (p / (share @ p[chosen])) @ counts
            slope[chosen] = 0
            best = None
            for m in np.flatnonzero(slope - n > penalty):
                trial, likelihood = _proportions(p[[*chosen, m]], counts, share)
                if likelihood > value + penalty and (best is None or likelihood > best[2]):
                    best = (int(m), trial, likelihood)
            if best is None:
                break
            chosen, share, value = [*chosen, best[0]], best[1], best[2]
        order = np.argsort(-share, kind="stable")
        return [(self.languages[chosen[i]], float(share[i])) for i in order]


def _proportions(p: np.ndarray, counts: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, float]:
    """EM for the proportions of the languages ``p``, from those found for all but the last."""
    n = counts.sum()
    share = np.append(0.9 * before, 0.1)
    last = -np.inf
    for _ in range(ITERATIONS):
        mix = share @ p
        likelihood = float(counts @ np.log(mix))
        if likelihood - last < PRECISION * n:
            break
        last = likelihood
        share = share * (p @ (counts / mix)) / n
    return share, likelihood


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Is crc32 of the id as text 2 modulo 4? Null ids aren't."""
    text = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(text.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame) -> Model:
    """The model of rows ``text, lang``; rows without a language or without letters teach nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(texts(batch), batch.column(1).to_pylist()):
                found = trigrams(text)
                if len(found):
                    if lang not in sums:
                        if len(sums) >= MAX_LANGUAGES:
                            raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
                        sums[lang] = np.zeros(BUCKETS, dtype=np.int64)
                    sums[lang] += np.bincount(found, minlength=BUCKETS)
        for lang, counts in sums.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some)), pa.array(some), pa.array(counts[some])], ["lang", "bucket", "n"])

    rows = docs.select("text", F.col("lang").cast("string").alias("lang")).filter(F.col("lang").isNotNull())
    found = rows.mapInArrow(run, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = found.toArrow()
    langs, which = np.unique(np.array(table.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    counts = np.zeros((len(langs), BUCKETS))
    counts[which, table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return Model(langs.tolist(), counts)


def identified(docs: DataFrame, model: Model, name: str = "language") -> DataFrame:
    """``docs`` with a struct ``language``: ``pred`` (the largest part), ``score`` (its proportion, 0 to 1), ``parts`` (all of the
    set, largest first).

    A text that is null, empty or without letters, or any text under a model that learned nothing, is ``und``
    with score 0 and no parts. Of equal proportions the language found first wins. Rows are all kept, repeated
    ones too. Only the text is read; a column of ``docs`` named as the result is replaced.
    """
    columns = [c for c in docs.columns if c != name]
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def make(batch: pa.RecordBatch) -> dict:
        found = [model.mixture(t) for t in texts(batch)]
        parts = [[{"lang": a, "share": b} for a, b in f] for f in found]
        return {name: pa.StructArray.from_arrays(
            [pa.array([f[0][0] if f else UNDETERMINED for f in found], pa.string()),
             pa.array([min(1.0, f[0][1]) if f else 0.0 for f in found], pa.float64()), pa.array(parts, kind)],
            ["pred", "score", "parts"])}

    return per_document(
        docs, columns, f"`{name}` struct<pred: string, score: double, parts: array<struct<lang: string, share: double>>>", make)


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (``doc_id, text, lang, ...``) in one determined language for ``least`` of the text, with their columns.

    The model learns from the labelled rows of ``docs`` that are not held out. If there are none, nothing can be
    determined and only texts without letters go.
    """
    model = learn(docs.filter(~held_out() & F.col("doc_id").isNotNull()))
    name = free_name(docs, "language")
    rows = identified(docs, model, name)
    if model.languages:
        rows = rows.filter((F.col(f"{name}.pred") != UNDETERMINED) & (F.col(f"{name}.score") >= least))
    else:
        rows = rows.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return rows.drop(name)
