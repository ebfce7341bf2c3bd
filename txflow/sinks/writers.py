"""Batch sinks (SNK1, SNK5, SNK6)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from txflow.operators.windows import flatten_window


def overwrite_parquet(df: DataFrame, path: str) -> str:
    """SNK1: replace the directory's content (silver, gold)."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header, cell text kept exactly (Spark's writer trims blanks by default)."""
    (df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def append_parquet(df: DataFrame, path: str) -> str:
    """SNK6 on a path: append files."""
    df.write.mode("append").parquet(path)
    return path


def append_table(df: DataFrame, name: str, location: str | None = None) -> str:
    """SNK6: append to a catalog table (created from the frame when missing; at
    ``location`` when given, else in the warehouse)."""
    w = df.write.mode("append").format("parquet")
    if location:
        w = w.option("path", location)
    w.saveAsTable(name)
    return name


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """SNK5: JDBC append; a window struct is flattened first (JDBC has no struct)."""
    if "window" in df.columns:
        df = flatten_window(df)
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**(properties or {})) \
        .mode("append").save()


def save_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, location: str | None = None,
                  sort_cols: list[str] | None = None) -> str:
    """Catalog table bucketed (and sorted) by ``keys`` into ``buckets`` buckets: the
    Spark form of a bucket(n, key) layout. Later group-bys and joins on ``keys`` read
    the buckets as they are, with no shuffle.

    The rows are hash-partitioned on the keys into exactly ``buckets`` partitions
    first (the same hash that places a row in its bucket), so each write task holds
    one bucket and the table gets one file per bucket, not tasks x buckets files.
    Size ``buckets`` with the data (e.g. the session's shuffle width): it is also the
    number of read tasks. The layout is always the one asked for. A bucket can't be
    split: for a key that holds a large share of the rows write a plain table, whose
    readers pre-combine the key in every map task.
    """
    w = (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
         .bucketBy(buckets, *keys).sortBy(*(sort_cols or keys)))
    if location:
        w = w.option("path", location)
    w.saveAsTable(name)
    return name
