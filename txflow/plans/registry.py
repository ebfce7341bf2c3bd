"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each builder reads whole driver tables (or data Spark derives from them) and
returns a lazy DataFrame; the matching DuckDB SQL is in ``txflow.plans.oracle``.
The builders live in ``batch``, ``tables`` and ``stream_queries``; importing
``txflow.plans`` registers all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txflow.operators import cleaning
from txflow.session import prepare
from txflow.sources import fixtures
from txflow.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


# --- shared inputs ----------------------------------------------------------

def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.dirty_transactions(table(spark, sf_dir, "orders"))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_intended(raw_transactions(spark, sf_dir))


def target_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live transactions table (merge target)."""
    return fixtures.versioned_transactions(table(spark, sf_dir, "orders"))


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.change_log(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
