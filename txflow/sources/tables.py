"""Readers: parquet tables, CSV with declared or inferred schema, row generator."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.sources import schemas

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, with its declared schema when there is one (no inference
    pass). Column pruning and filter pushdown happen in the scan."""
    reader = spark.read
    if name in schemas.DRIVER_TABLES:
        reader = reader.schema(schemas.DRIVER_TABLES[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def parquet_scan(spark: SparkSession, path: str, columns: list[str] | None = None,
                 where=None) -> DataFrame:
    """Parquet scan with an explicit projection and an optional pushed-down filter (SRC3)."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def csv_declared(spark: SparkSession, path: str, ddl: str = schemas.RAW_TRANSACTIONS,
                 header: bool = True) -> DataFrame:
    """CSV with a declared schema; a malformed typed cell becomes NULL (SRC1).

    PERMISSIVE is the reader default; it is spelled out because the cleaning
    relies on it. No inference pass over the data.
    """
    return (spark.read.schema(ddl).option("header", header).option("mode", "PERMISSIVE")
            .csv(path))


def csv_inferred(spark: SparkSession, path: str, header: bool = True,
                 sampling_ratio: float = 1.0) -> DataFrame:
    """CSV with an inferred schema (SRC2). Costs an extra pass over the input;
    ``sampling_ratio`` < 1 bounds that pass on large inputs."""
    return (spark.read.option("header", header).option("inferSchema", True)
            .option("samplingRatio", sampling_ratio).csv(path))


def generate_users(spark: SparkSession, n: int, ts: _dt.datetime | None = None,
                   num_partitions: int | None = None) -> DataFrame:
    """n rows (i, 'user_' || i, ts) generated on the executors (SRC10).

    ``ts`` is a parameter (default: the query's current time), so tests are fixed.
    """
    ts_col = F.current_timestamp().cast("timestamp_ntz") if ts is None else F.lit(ts).cast("timestamp_ntz")
    return spark.range(0, n, 1, num_partitions).select(
        F.col("id"),
        F.concat(F.lit("user_"), F.col("id").cast("string")).alias("user"),
        ts_col.alias("ts"),
    )
