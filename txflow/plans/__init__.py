"""Registered queries and their oracle SQL."""

from txflow.plans import batch, stream_queries, tables, versions  # noqa: F401  (registers the queries)
from txflow.plans.oracle import SQL
from txflow.plans.registry import QUERIES

__all__ = ["QUERIES", "SQL"]
