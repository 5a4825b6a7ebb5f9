"""Quality rules with risk-controlled thresholds.

Five ratios of a text may each reject it above a cutoff. Labelled rows (quality 1: good) choose the cutoffs, per stratum: the
candidate cutoffs of a rule are fixed in advance and tested from the loosest to the strictest; a cutoff is certified while
the exact (Clopper-Pearson) binomial test rejects "more than ``risk / rules`` of the good texts are lost". The first failure ends the
sequence (fixed-sequence testing), and the level is split over strata and rules (Bonferroni), so with
probability ``1 - delta`` no stratum loses more than ``risk`` of its good texts to the learned rules. Among the certified cutoffs the one
with the best balance of bad texts caught and good texts lost is used, the loosest of equals. A rule without a certified cutoff that
catches something stays off.

Counting the labelled rows is one aggregate to strata x rules x cutoffs rows; nothing is collected.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewarden.llm.words import RollingHash, free_name, hashes_of, per_document, texts
from tracewarden.session import written_table

#: Share of good texts that a stratum may lose to the learned rules, and the probability of being wrong.
RISK, DELTA = 0.05, 0.05
#: Good texts that catching one bad text must not cost: the balance in choosing among certified cutoffs.
GOOD_WEIGHT = 10
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20
REPEAT_WINDOW = 5

#: Rule name: numerator, denominator; the candidate cutoffs, loosest first.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeat_words": ("n_repeat_words", "n_words"),
    "upper": ("n_upper", "word_chars"),
    "exclaim": ("n_exclaim", "word_chars"),
}
CUTOFFS = [round(0.5 * 0.85 ** k, 6) for k in range(24)]

METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim"]
SYMBOLS, UPPER = re.compile(rb"[#*$%&|<>]"), re.compile(rb"[A-Z]")


def measures(text: bytes | None) -> tuple[int, ...]:
    """``METRICS`` of a text; a null text has no words. Lines count if they have a word."""
    words = (text or b"").split()
    if not words:
        return (0,) * len(METRICS)
    chars = len(b"".join(words).decode())
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\r\x0b\x0c")]
    repeated = 0
    windows = RollingHash(hashes_of(words)).windows(REPEAT_WINDOW)
    if len(windows) > 1:
        _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
        twice = counts[which] > 1
        if twice.any():
            covered = np.zeros(len(words), dtype=bool)
            for k in range(REPEAT_WINDOW):
                covered[k:k + len(twice)] |= twice
            repeated = int(covered.sum())
    return (len(words), chars, len(SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated, len(lines),
            len(UPPER.findall(text)), text.count(b"!"))


def measured(docs: DataFrame, name: str = "quality", columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or only its ``columns``) with a struct column of ``METRICS``."""
    columns = columns or [c for c in docs.columns if c != name]

    def make(batch: pa.RecordBatch) -> dict:
        table = np.array([measures(t) for t in texts(batch)], dtype=np.int64).reshape(-1, len(METRICS))
        return {name: pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(len(METRICS))], METRICS)}

    return per_document(docs, columns, f"`{name}` struct<{', '.join(m + ': bigint' for m in METRICS)}>", make)


def base_failed(m: str) -> Column:
    """The fixed rule on the metrics column ``m``: too short, or too much of it repeated."""
    return (F.col(f"{m}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{m}.n_repeat_words") > MAX_REPEATED_PERCENT * F.col(f"{m}.n_words"))


def ratio(m: str, rule: str) -> Column:
    above, below = RULES[rule]
    return F.col(f"{m}.{above}") / F.greatest(F.col(f"{m}.{below}"), F.lit(1))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed in logs."""
    if k >= n:
        return 1.0
    log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
           for i in range(k + 1)]
    top = max(log)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in log))


def chosen_cutoff(lost: list[int], caught: list[int], good: int, risk: float, level: float) -> float | None:
    """The cutoff for one stratum and rule, from counts by cutoff (loosest first)."""
    best = None
    for k, cutoff in enumerate(CUTOFFS):
        # More losses than the risk can never be certified; don't sum a long tail for that.
        if lost[k] > risk * good or binomial_tail(lost[k], good, risk) > level:
            break
        value = caught[k] - GOOD_WEIGHT * lost[k]
        if value > 0 and (best is None or value > best[0]):
            best = (value, cutoff)
    return best and best[1]


def cutoffs(labelled: DataFrame, stratum: str = "stratum", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``stratum, rule, cutoff, n_good`` from rows ``stratum, good (0/1), quality (metrics)``.

    Only rows that pass the fixed rule count: the others are gone whatever the cutoffs. ``cutoff`` is null where the rule stays off.
    """
    rows = labelled.filter(~base_failed("quality"))
    ratios = F.array(*[F.struct(F.lit(r).alias("rule"), ratio("quality", r).alias("value")) for r in RULES])
    each = rows.select(stratum, "good", F.inline(ratios))
    counts = each.groupBy(stratum, "rule").agg(
        F.sum("good").alias("n_good"),
        *[F.sum(F.when(F.col("value") > c, F.col("good")).otherwise(0)).alias(f"lost{k}") for k, c in enumerate(CUTOFFS)],
        *[F.sum(F.when(F.col("value") > c, 1 - F.col("good")).otherwise(0)).alias(f"bad{k}") for k, c in enumerate(CUTOFFS)])
    counts = written_table(counts, "quality-counts")
    strata = max(1, counts.select(stratum).distinct().count())
    level, share = delta / (strata * len(RULES)), risk / len(RULES)
    m = len(CUTOFFS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [list(r.values()) for r in batch.to_pylist()]
            found = [chosen_cutoff(r[3:3 + m], r[3 + m:], r[2], share, level) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(found, pa.float64())],
                ["stratum", "rule", "n_good", "cutoff"])

    return counts.mapInArrow(run, "stratum string, rule string, n_good bigint, cutoff double")


def judged(docs: DataFrame, labels: DataFrame, stratum: Column | None = None, name: str = "quality") -> DataFrame:
    """``docs`` with a struct ``quality``: ``METRICS``, ``base_failed``, ``rejected_by`` (the learned rules that reject), ``kept``.

    ``docs`` has ``doc_id, text`` and, for the default stratum, ``lang``; ``labels`` has ``doc_id, quality``. A null stratum is a stratum of
    its own. Labels without a document, and null labels, teach nothing; repeated documents or labels count as often as they occur. Without labels
    only the fixed rule acts. Null and empty texts have no words and fail the fixed rule. Rows are all kept, repeated ones too;
    a column of ``docs`` named as the result is replaced.
    """
    docs = docs.select(*[c for c in docs.columns if c != name])
    stratum_name, limits = free_name(docs, "stratum"), free_name(docs, "cutoffs")
    layer = (F.col("lang") if stratum is None else stratum).cast("string")
    # Names that a join can match, the null stratum's unlike all others.
    layer = F.coalesce(F.concat(F.lit("="), layer), F.lit("null"))
    holdout = labels.filter(F.col("quality").isNotNull()).select("doc_id", (F.col("quality") == 1).cast("int").alias("good"))
    # Measured before the join, so that it moves numbers, not texts.
    numbers = measured(docs.select("doc_id", "text", layer.alias("stratum")), columns=["doc_id", "stratum"])
    table = cutoffs(numbers.join(holdout, "doc_id").select("stratum", "good", "quality"))
    # One row per stratum. It is stored, so Spark knows its size before it decides on a broadcast.
    table = written_table(table.filter(F.col("cutoff").isNotNull()).groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias(limits)), "quality-cutoffs")
    rows = measured(docs.withColumn(stratum_name, layer), name).join(
        table.withColumnRenamed("stratum", stratum_name), stratum_name, "left")
    by = F.array_compact(F.array(*[
        F.when(ratio(name, r) > F.col(limits)[r], F.lit(r)) for r in RULES]))
    failed = base_failed(name)
    return rows.withColumn(name, F.struct(
        *[F.col(f"{name}.{m}").alias(m) for m in METRICS], failed.alias("base_failed"), by.alias("rejected_by"),
        (~failed & (F.size(by) == 0)).alias("kept"))).drop(stratum_name, limits)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`judged` keeps, with the columns of ``docs``."""
    name = free_name(docs, "quality")
    return judged(docs, labels, name=name).filter(f"{name}.kept").select(*docs.columns)
