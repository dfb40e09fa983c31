"""Registered queries, one module per operator family."""

from sparkmart.queries import basics, compare, edge_cases, intervals, loads, quality, sources, streams, warehouse  # noqa: F401
from sparkmart.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
