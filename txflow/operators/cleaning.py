"""Raw transactions -> silver rows (CLN1-8, CLN19) and de-duplication (DED1).

Two modes:

* ``clean_literal`` reproduces the batch job step by step, traps included: the
  mixed-case whitelist keeps only rows whose category was filled with 'Unknown';
  a string fill of the timestamp has no effect, so missing times stay NULL; 'NULL'
  cities survive as 'Null'. One trap is not kept: ids are BIGINT, not INT, so that an id
  past 2^31 stays itself instead of becoming NULL and falling into one row.
* ``clean_intended`` (the default) does what those steps were meant to do.

Both are narrow (map-only) until the final de-duplication, which is one
hash-partitioned aggregate with a map-side partial step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txflow.functions import columns as C
from txflow.functions import values as V

SILVER_COLUMNS = ["id", "user_id", "amount", "category", "timestamp", "city"]


def dedupe_by_id(df: DataFrame, key: str = "id") -> DataFrame:
    """One row per ``key``; NULL keys collapse to one row (DED1).

    The survivor is fixed: the smallest row by (other columns in schema order), so
    reruns give the same answer. Planned as a group-by with a partial aggregate in
    every map task, so a key that holds a third of all rows is pre-combined before
    the shuffle instead of landing whole in one task.
    """
    others = [c for c in df.columns if c != key]
    best = F.min(F.struct(*[F.col(c) for c in others])).alias("_row")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_row.{c}").alias(c) for c in others]) \
        .select(*df.columns)


def clean_literal(raw: DataFrame) -> DataFrame:
    """The batch job's cleaning chain, as written (ANSI-safe conversions)."""
    df = raw.select(
        C.tolerant_cast("id", "bigint").alias("id"),
        C.tolerant_cast("user_id", "bigint").alias("user_id"),
        C.parse_decimal_comma("amount", "float").alias("amount"),
        C.parse_timestamp("timestamp").alias("timestamp"),
        C.city_as_written("city").alias("city"),
        C.category_as_written("category").alias("category"),
    )
    # replace(list, None) touches every string column
    for col in ("city", "category"):
        df = df.withColumn(col, C.null_if_in(C.null_if_in(col, V.SENTINELS_FIRST), V.SENTINELS))
    df = df.withColumn("category", C.null_if_in("category", V.CATEGORY_BLANKS))
    df = df.withColumn("city", C.recode("city", V.CITY_NAMES))
    df = df.fillna(V.UNKNOWN_LABEL, subset=["city", "category"])
    df = df.fillna(0, subset=["amount"])
    df = df.filter(F.col("category").isin(V.VALID_CATEGORIES))
    return dedupe_by_id(df.select(*SILVER_COLUMNS))


def intended_whitelist() -> list[str]:
    """The whitelist in the data's case; the blank entry cannot survive normalising."""
    return sorted({c.upper() for c in V.VALID_CATEGORIES if c.strip()})


def clean_intended(raw: DataFrame) -> DataFrame:
    """What the chain means: case-insensitive sentinels, whitelist in the same case as
    the data, DOUBLE amounts, missing times filled with the epoch."""
    df = raw.select(
        C.tolerant_cast("id", "bigint").alias("id"),
        C.tolerant_cast("user_id", "bigint").alias("user_id"),
        F.coalesce(C.parse_decimal_comma("amount", "double"), F.lit(0.0)).alias("amount"),
        C.intended_category("category").alias("category"),
        F.coalesce(C.parse_timestamp("timestamp"), F.lit(V.EPOCH_TEXT).cast("timestamp_ntz")).alias("timestamp"),
        C.intended_city("city").alias("city"),
    )
    df = df.filter(F.col("category").isin(intended_whitelist()))
    return dedupe_by_id(df)


def fill_defaults(df: DataFrame) -> DataFrame:
    """CLN7 alone: city/category -> 'Unknown', amount -> 0, timestamp -> epoch."""
    return df.select(
        *[F.col(c) for c in df.columns if c not in ("city", "category", "amount", "timestamp")],
        F.coalesce(F.col("city"), F.lit(V.UNKNOWN_LABEL)).alias("city"),
        F.coalesce(F.col("category"), F.lit(V.UNKNOWN_LABEL)).alias("category"),
        F.coalesce(F.col("amount"), F.lit(0.0)).alias("amount"),
        F.coalesce(F.col("timestamp"), F.lit(V.EPOCH_TEXT).cast("timestamp_ntz")).alias("timestamp"),
    ).select(*df.columns)


def whitelist_filter(df: DataFrame, col: str = "category", allowed: list[str] | None = None) -> DataFrame:
    """CLN8: keep rows whose ``col`` is in the list (literal compare)."""
    return df.filter(F.col(col).isin(allowed if allowed is not None else V.VALID_CATEGORIES))
