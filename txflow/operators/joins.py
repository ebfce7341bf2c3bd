"""Dimension joins (JN1, JN2).

Which side is broadcast is left to Spark's size statistics in bytes
(``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution with run-time sizes):
no counting job, no limit in rows of unknown width. Beyond the threshold the join is a
sort-merge join, whose hot keys adaptive execution splits on the fact side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """``fact`` join ``dim`` on equal key columns (kept once; NULL keys never match)."""
    return fact.join(dim, on=on, how=how)


def join_on_text_key(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, name: str = "user",
                     how: str = "inner") -> DataFrame:
    """JN2: both keys cast to STRING under one name, then ``join_dimension``."""
    f = fact.withColumn(name, F.col(fact_key).cast("string"))
    d = dim.withColumn(name, F.col(dim_key).cast("string"))
    if dim_key != name:
        d = d.drop(dim_key)
    return join_dimension(f, d, name, how)
