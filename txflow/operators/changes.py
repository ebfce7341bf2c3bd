"""Changing tables without a table format (CHG1-5, CHG9, CHG10).

Spark's built-in parquet tables refuse MERGE and UPDATE, so these are DataFrame
operators over a plain table or over an append-only change log with the columns
``<key>, <values...>, op, version, committed_at`` (op in insert / update / delete).
The result of each is a DataFrame; persisting it (to a new directory, then
swapping) is the caller's choice, see ``txflow.sinks``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.functions import values as V
from txflow.operators.collapse import latest_version
from txflow.session import work_dir


# Insert side of a merge: above so many source rows it is dealt into tasks of about so many of them
MERGE_WHOLE_ROWS = 1_000_000
MERGE_ROWS_A_TASK = 250_000
MERGE_MOST_TASKS = 100_000


class MergeCardinalityError(ValueError):
    """Two source rows match one target row: the merge is ambiguous and refused."""


def most_per_key(source: DataFrame, key: str) -> int:
    """The largest number of rows that share one non-NULL key."""
    return _most_and_all(source, key)[0]


def _most_and_all(source: DataFrame, key: str) -> tuple[int, int]:
    """The largest number of rows that share one non-NULL key, and the number of rows with any."""
    per_key = source.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    most, rows = per_key.agg(F.max("n"), F.sum("n")).first()
    return int(most or 0), int(rows or 0)


def merge_upsert(target: DataFrame, source: DataFrame, key: str = "id",
                 update: list[str] | None = None) -> DataFrame:
    """MERGE: matched on ``key`` -> set ``update`` columns from the source (others kept);
    not matched -> insert the source row. Every target row with a matching key is
    updated; a key that occurs twice in the source is refused. NULL keys never match.

    The source is written once to the shared folder: it feeds the check and two
    branches, and its size in bytes is then known, so Spark broadcasts it to the target
    scan when it is under the broadcast threshold and shuffles both sides otherwise
    (adaptive execution splits hot target keys). The insert side reads the target's key
    column only, one row per key after the map-side step.

    A task of the insert side holds several sorted or hashed copies of its keys at once,
    while keys alone shuffle to a few bytes a row: adaptive execution, which goes by
    shuffled bytes, joins too many of them into one task. For a large source, the number
    of tasks goes by its rows and is kept, never fewer than the session's.
    """
    update = update if update is not None else [c for c in source.columns if c != key and c in target.columns]
    spark = source.sparkSession
    path = work_dir(spark, "merge_source")
    source.write.parquet(path)
    source = spark.read.schema(source.schema).parquet(path)
    worst, rows = _most_and_all(source, key)
    if worst > 1:
        raise MergeCardinalityError(f"source has {worst} rows for one {key}")

    src = source.select(key, *[F.col(c).alias(f"_src_{c}") for c in update], F.lit(True).alias("_matched"))
    updated = target.join(src, key, "left").select(*[
        (F.when(F.col("_matched"), F.col(f"_src_{c}")).otherwise(F.col(c)) if c in update else F.col(c)).alias(c)
        for c in target.columns])
    if rows > MERGE_WHOLE_ROWS:
        tasks = min(-(-rows // MERGE_ROWS_A_TASK), MERGE_MOST_TASKS)
        source = source.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), key)
    # only keys that the source has, then one row per key: never more rows than the source
    matched = target.select(key).join(source.select(key), key, "left_semi").distinct()
    inserts = source.join(matched, key, "left_anti")
    return updated.unionByName(inserts.select(*target.columns))


def update_column(df: DataFrame, col: str, value: Column | object, where: Column | None = None) -> DataFrame:
    """UPDATE t SET col = value [WHERE where] (CHG2). Narrow: no shuffle."""
    v = value if isinstance(value, Column) else F.lit(value)
    new = v if where is None else F.when(where, v).otherwise(F.col(col))
    return df.withColumn(col, new.cast(df.schema[col].dataType))


def as_of_version(log: DataFrame, version: int, key: str = "id") -> DataFrame:
    """Table state as of ``version`` (CHG4, rollback): newest change per key up to that
    version; keys whose newest change is a delete are absent."""
    value_cols = [c for c in log.columns if c not in ("op", "version", "committed_at")]
    newest = latest_version(log.filter(F.col("version") <= version), [key], "version")
    return newest.filter(F.col("op") != "delete").select(*value_cols)


def version_history(log: DataFrame, n: int = V.RETAIN_LAST_VERSIONS) -> DataFrame:
    """Newest n versions: version, committed_at, operation, changed rows (CHG3).

    operation: append (inserts only), delete (deletes only), overwrite (otherwise).
    """
    per = log.groupBy("version").agg(
        F.max("committed_at").alias("committed_at"),
        F.count(F.lit(1)).alias("changed_rows"),
        F.sum(F.when(F.col("op") == "insert", 1).otherwise(0)).alias("_ins"),
        F.sum(F.when(F.col("op") == "delete", 1).otherwise(0)).alias("_del"))
    op = (F.when(F.col("_ins") == F.col("changed_rows"), F.lit("append"))
          .when(F.col("_del") == F.col("changed_rows"), F.lit("delete"))
          .otherwise(F.lit("overwrite")))
    return (per.select("version", "committed_at", op.alias("operation"), "changed_rows")
            .orderBy(F.col("committed_at").desc(), F.col("version").desc()).limit(n))


def retain_last_versions(log: DataFrame, n: int = V.RETAIN_LAST_VERSIONS, key: str = "id") -> DataFrame:
    """Expire old versions, keeping the newest n readable (CHG5).

    Versions older than the oldest kept one are folded into one baseline row per key
    (its state as of that version, labelled with it); deleted keys drop out. As-of
    reads of every kept version give the same answer before and after.

    The only values brought to the driver are the newest n (version, committed_at)
    pairs: n rows, however large the log.
    """
    kept = (log.groupBy("version").agg(F.max("committed_at").alias("committed_at"))
            .orderBy(F.col("version").desc()).limit(n).collect())
    if len(kept) < n:
        return log
    oldest = min(kept, key=lambda r: r["version"])
    cutoff, cutoff_at = oldest["version"], oldest["committed_at"]
    value_cols = [c for c in log.columns if c not in ("op", "version", "committed_at")]
    baseline = as_of_version(log, cutoff, key).select(
        *value_cols, F.lit("insert").alias("op"), F.lit(cutoff).cast("int").alias("version"),
        F.lit(cutoff_at).cast(log.schema["committed_at"].dataType).alias("committed_at"))
    return baseline.unionByName(log.filter(F.col("version") > cutoff).select(*baseline.columns))


def view_projection(spark: SparkSession, df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """CREATE OR REPLACE VIEW name AS SELECT columns (CHG9); returns the view."""
    df.select(*columns).createOrReplaceTempView(name)
    return spark.table(name)


def ensure_table(spark: SparkSession, name: str, ddl: str, location: str | None = None,
                 partitioned_by: list[str] | None = None) -> DataFrame:
    """CREATE TABLE IF NOT EXISTS name (ddl) USING parquet (CHG10). Idempotent."""
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{part}{loc}")
    return spark.table(name)


def insert_columns(df: DataFrame, name: str) -> None:
    """INSERT INTO name (the columns of ``df``): columns that it lacks take the DEFAULT of the table's DDL (CHG10, CLN14)."""
    spark = df.sparkSession
    view = f"_insert_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    try:
        columns = ", ".join(f"`{c}`" for c in df.columns)
        spark.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def ensure_view(spark: SparkSession, name: str, table: str, columns: list[str]) -> DataFrame:
    """CREATE OR REPLACE VIEW in the catalog (CHG9): it names its columns, so it reads the same when the table gets more of
    them, and it follows the table's rows wherever they are stored."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(f'`{c}`' for c in columns)} FROM {table}")
    return spark.table(name)


def replace_rows(df: DataFrame, name: str, location: str) -> None:
    """The catalog table ``name`` gets the rows of ``df``, which may be made from its present ones: they are written to a
    new location first and the table is pointed at it when they are there."""
    df.write.mode("errorifexists").parquet(location)
    df.sparkSession.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    df.sparkSession.catalog.refreshTable(name)
