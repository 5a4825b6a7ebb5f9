"""Byte statistics of documents or files, after the published EMBER definitions.

Each row is summarised where it is, by small numpy helpers over Arrow batches, since exploding every
byte into a row and shuffling it would cost far more than the counting. Whole texts are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 2048
STEP = 1024
PRINTABLE = r"[\x20-\x7f]{5,}"


def _octets(value) -> np.ndarray:
    data = value.encode("utf-8") if isinstance(value, str) else bytes(value or b"")
    return np.frombuffer(data, dtype=np.uint8)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _byte_counts(values: pd.Series) -> pd.Series:
    return values.map(lambda v: np.bincount(_octets(v), minlength=256))


def _entropy_rows(octets: np.ndarray) -> np.ndarray:
    """256 counts, row-major: entropy bin (half bits of the high nibble), then high nibble."""
    out = np.zeros((16, 16), dtype=np.int64)
    if octets.size == 0:
        return out.ravel()
    nibbles = octets >> 4
    if nibbles.size < WINDOW:
        windows = nibbles[None, :]
    else:
        windows = np.lib.stride_tricks.sliding_window_view(nibbles, WINDOW)[::STEP]
    # One 16-slot count per window, a bounded number of windows at a time.
    for start in range(0, len(windows), 512):
        part = windows[start:start + 512]
        keys = part + (np.arange(len(part), dtype=np.int64) * 16)[:, None]
        counts = np.bincount(keys.ravel(), minlength=len(part) * 16).reshape(-1, 16)
        share = counts / WINDOW
        bits = -(share * np.log2(np.where(counts > 0, share, 1.0))).sum(axis=1)
        bins = np.minimum((bits * 2 * 2).astype(int), 15)
        np.add.at(out, bins, counts)
    return out.ravel()


@F.pandas_udf(T.ArrayType(T.LongType()))
def _entropy_counts(values: pd.Series) -> pd.Series:
    return values.map(lambda v: _entropy_rows(_octets(v)))


@F.pandas_udf(T.DoubleType())
def _text_entropy(values: pd.Series) -> pd.Series:
    def bits(text):
        counts = np.bincount(_octets(text))
        share = counts[counts > 0] / max(counts.sum(), 1)
        return float(-(share * np.log2(share)).sum()) if share.size else 0.0

    return values.map(bits)


def _with_shares(df: DataFrame, total: Column) -> DataFrame:
    share = F.transform("counts", lambda x: F.when(F.col("_total") > 0, x / F.col("_total")).otherwise(0.0))
    return df.withColumn("_total", total).withColumn("histogram", share).drop("_total", "_size")


def byte_histogram(df: DataFrame, key: str, content: str = "text") -> DataFrame:
    """``counts`` of the 256 byte values, and ``histogram``, their shares."""
    counted = df.select(key, F.octet_length(content).alias("_size"), _byte_counts(content).alias("counts"))
    return _with_shares(counted, F.col("_size"))


def byte_entropy_histogram(df: DataFrame, key: str, content: str = "text") -> DataFrame:
    """256 slots of (entropy bin, high nibble) over overlapping windows; a short input is one window."""
    counted = df.select(key, F.octet_length(content).alias("_size"), _entropy_counts(content).alias("counts"))
    windows = F.floor((F.col("_size") - WINDOW) / STEP) + 1
    return _with_shares(
        counted, F.when(F.col("_size") < WINDOW, F.col("_size")).otherwise(windows * WINDOW))


def string_features(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Runs of at least five printable characters, and markers in the whole text."""
    runs = df.select(key, F.col(text).alias("_text"),
                     F.regexp_extract_all(text, F.lit(PRINTABLE), F.lit(0)).alias("_runs"))
    joined = runs.select(key, "_text", F.size("_runs").alias("numstrings"),
                         F.array_join("_runs", "").alias("_all"))
    count = lambda p: F.regexp_count(F.col("_text"), F.lit(p))
    return joined.select(
        key, "numstrings",
        F.when(F.col("numstrings") > 0, F.length("_all") / F.col("numstrings")).otherwise(0.0).alias("avlength"),
        F.length("_all").alias("printables"),
        _text_entropy("_all").alias("entropy"),
        count(r"(?i)c:\\").alias("paths"),
        count("(?i)https?://").alias("urls"),
        count("HKEY_").alias("registry"),
        count("MZ").alias("MZ"),
    )
