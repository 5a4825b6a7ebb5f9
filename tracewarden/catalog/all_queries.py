"""Import every query module, so that the registry is complete."""

from tracewarden.catalog import (  # noqa: F401
    feature_queries,
    graph_queries,
    log_queries,
    packet_queries,
    stream_queries,
)
from tracewarden.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
