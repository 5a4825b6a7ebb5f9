"""Query registry: a Spark callable and, where SQL can express it, the oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracewarden.catalog.views import with_clause

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views=()):
    """Register a query. ``sql`` follows the views' WITH clause, so it may open with ``, x AS (...)``."""

    def register(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            text = sql.strip()
            ORACLES[name] = f"WITH {with_clause(views, 'duckdb')}\n{text}" if views else text
        return fn

    return register
