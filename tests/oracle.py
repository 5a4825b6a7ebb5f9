"""Compare registered queries with their SQL in DuckDB, as multisets of rows.

Run as a script: ``python -m tests.oracle [sf] [name ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, (int, float)):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str, queries, oracles) -> str | None:
    """None if equal, else what differs."""
    df = queries[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracles:
        return None
    result = con.execute(oracles[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = rows_of(columns, result.fetchall())
    if got == want:
        return None
    missing, extra = list((want - got).items())[:2], list((got - want).items())[:2]
    return f"{sum(got.values())} rows, expected {sum(want.values())}; missing {missing}; extra {extra}"


def main(argv) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tracewarden.session import local_session

    sf_dir = f"{TESTDATA}/sf{argv[1] if len(argv) > 1 else '0.01'}"
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = argv[2:] or list(queries)
    spark, con, bad = local_session(), connect(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, queries, oracles)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        kind = "oracle" if name in oracles else "rows"
        print(f"\n{'FAIL' if problem else 'ok'} {name} [{kind}] {time.time() - start:.2f}s {problem or ''}", flush=True)
        bad += bool(problem)
    print(f"\n{len(names)} queries, {bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
