"""Read-time collapse of merge-style tables (DED2, AGG4).

* ``latest_version``: keep the newest row per key, newest = highest version, ties to
  the last inserted (highest sequence) -- a replacing table read with FINAL.
* ``summing_rows`` / ``collapse_summing``: project each message to a summing row
  (10-minute bucket, normalised category, amount in cents, count 1) and add rows up
  per key -- a summing table; readers must still sum, which ``collapse_summing`` does.

Both are group-bys with a map-side partial step: a key holding a third of all rows
is combined inside each map task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.functions import columns as C
from txflow.functions import values as V


def latest_version(df: DataFrame, keys: list[str | Column], version: str, seq: str | None = None) -> DataFrame:
    """Newest row per key. ``keys`` may be expressions (e.g. the day of a timestamp)."""
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    key_names = [f"_k{i}" for i in range(len(key_cols))]
    # a struct is never NULL, so a key whose versions are all NULL keeps a row
    order = F.struct(F.col(version), F.col(seq)) if seq else F.struct(F.col(version))
    row = F.struct(*[F.col(c) for c in df.columns])
    agg = (df.select(*[k.alias(n) for k, n in zip(key_cols, key_names)], row.alias("_row"), order.alias("_ord"))
           .groupBy(*key_names).agg(F.max_by("_row", "_ord").alias("_row")))
    return agg.select("_row.*")


def with_event_time(messages: DataFrame) -> DataFrame:
    """CLN14: event_time computed from the epoch-seconds ``timestamp`` column."""
    return messages.withColumn("event_time", C.to_wall_clock(C.epoch_to_timestamp("timestamp")))


def latest_per_day(messages: DataFrame, seq: str | None = "seq") -> DataFrame:
    """DED2: newest message per (day of event_time, id), version = timestamp."""
    df = with_event_time(messages)
    out = latest_version(df, [F.to_date("event_time"), "id"], "timestamp", seq)
    return out.drop(seq) if seq else out


def summing_rows(messages: DataFrame, now: Column | None = None) -> DataFrame:
    """Per-message projection of the summing view (STR2 bucket, CLN9, CLN15, CLN18). An absent
    field counts as the empty default of a column that can't be null: time 0 ("not set"), amount 0."""
    when = C.clock_fallback("timestamp", now)
    return messages.select(
        C.to_wall_clock(F.window(when, V.SUMMING_BUCKET).start).alias("timer"),
        C.category_multiif("category").alias("category"),
        C.money_half_even(F.coalesce("amount", F.lit(0.0))).cast("decimal(18,2)").alias("total_sum"),
        F.lit(1).cast("bigint").alias("tx_count"),
    )


def collapse_summing(rows: DataFrame) -> DataFrame:
    """Add summing rows per (timer, category)."""
    return rows.groupBy("timer", "category").agg(
        F.sum("total_sum").cast("decimal(18,2)").alias("total_sum"),
        F.sum("tx_count").alias("tx_count"))
