"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.session import work_dir

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def importable(spark: SparkSession) -> None:
    """Python workers find this package where the driver has it (on a cluster ship it with --py-files)."""
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays (``lower`` would also change É, İ, ...)."""
    return F.translate(c, UPPER, LOWER)


def text_of(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def saved(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """What runs within hands rows to Python workers ``size`` bytes, or one larger row, at a time. Spark's own measure is
    64 MB, which every running task holds twice: outside the heap of its executor and in the worker."""
    before = spark.conf.get(BATCH, None)
    spark.conf.set(BATCH, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH)
        else:
            spark.conf.set(BATCH, before)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def listed(spans: Column, kinds: tuple[str, ...]) -> Column:
    """Spans (start, kind, end) as one string: kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
