"""Gold reports (AGG1-3), top-k per group (WIN1), latest rows (SRT2).

All aggregates are sum / count / avg, which Spark computes as partial aggregates in
the map tasks and merges after the shuffle, so a hot group costs one row per task in
the shuffle. Money sums are rounded to cents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txflow.functions import columns as C
from txflow.operators.joins import join_dimension, join_on_text_key


def _money_aggs(amount: str = "amount", count_col: str = "id", total: str = "total_amount",
                count: str = "tx_count", avg: str = "avg_check"):
    return [C.money(F.sum(amount)).alias(total), F.count(count_col).alias(count),
            C.money(F.avg(amount)).alias(avg)]


def category_report(silver: DataFrame) -> DataFrame:
    """AGG1: per category turnover, transaction count (non-NULL ids), average check."""
    return silver.groupBy("category").agg(*_money_aggs()).orderBy(F.col("total_amount").desc())


def gender_category_report(silver: DataFrame, users: DataFrame) -> DataFrame:
    """JN1 + AGG2: join the users dimension on user_id, report per (gender, category)."""
    joined = join_dimension(silver, users.select("user_id", "gender"), "user_id")
    return joined.groupBy("gender", "category").agg(*_money_aggs()).orderBy(F.col("total_amount").desc())


def hourly_report(silver: DataFrame, segments: DataFrame) -> DataFrame:
    """JN2 + AGG3: join segments on the user id as text, report per hour of day."""
    joined = join_on_text_key(silver, segments.select("user"), "user_id", "user")
    return (joined.withColumn("hour_time", F.hour("timestamp"))
            .groupBy("hour_time")
            .agg(F.count("user").alias("tx_count"), C.money(F.sum("amount")).alias("total_sum"),
                 C.money(F.avg("amount")).alias("avg_value"))
            .orderBy(F.col("hour_time").asc()))


def top_k_per_group(df: DataFrame, group: str = "category", order: str = "amount", k: int = 3,
                    tie: str = "id", rank_col: str = "level") -> DataFrame:
    """WIN1: the k largest ``order`` values per group, ties broken by ``tie``.

    ``row_number() <= k`` lets Catalyst insert a WindowGroupLimit before the shuffle,
    so each map task forwards at most k rows per group: a hot group cannot flood
    one task.
    """
    w = Window.partitionBy(group).orderBy(F.col(order).desc_nulls_last(), F.col(tie).asc_nulls_first())
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def latest_n(df: DataFrame, time_col: str, n: int = 100, tie: str = "id") -> DataFrame:
    """SRT2: newest n rows (time desc, then key desc): TakeOrderedAndProject."""
    return df.orderBy(F.col(time_col).desc_nulls_last(), F.col(tie).desc_nulls_last()).limit(n)


def peek_ordered(df: DataFrame, n: int = 5, key: str = "id") -> DataFrame:
    """SRC8: first n rows of a table, in key order so the rows are fixed."""
    return df.orderBy(F.col(key).asc_nulls_last()).limit(n)


def describe(spark: SparkSession, table: str) -> DataFrame:
    """Column names and types of a catalog table."""
    return spark.sql(f"DESCRIBE TABLE {table}").select("col_name", "data_type")


def turnover_by_partition(fact: DataFrame, dimension: DataFrame, on: str) -> DataFrame:
    """Rows and turnover per ``on`` of a fact stored by ``on``, for the values that ``dimension`` has (JN1 over a partitioned
    table). The dimension's filter prunes the fact's folders at run time: join on the partition column itself."""
    return fact.join(dimension.select(on), on).groupBy(on).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("turnover"))


def profile(df: DataFrame) -> DataFrame:
    """Per column of ``df``: column, type, rows, nulls, least, greatest (as text), from one pass of partial aggregates
    (SRC9 with what the rows hold, beside the DDL)."""
    types = dict(df.dtypes)
    sums = df.agg(F.count(F.lit(1)).alias("rows"), *[f.alias(f"{name}_{i}") for i, c in enumerate(df.columns) for name, f in (
        ("nulls", F.count_if(F.col(c).isNull())), ("least", F.min(c).cast("string")), ("greatest", F.max(c).cast("string")))])
    told = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col("rows"),
                              *[F.col(f"{name}_{i}").alias(name) for name in ("nulls", "least", "greatest")])
                     for i, c in enumerate(df.columns)])
    return sums.select(F.explode(told).alias("x")).select("x.*")
