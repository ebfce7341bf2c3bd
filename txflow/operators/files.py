"""Files behind a table: report, compaction, orphans, day archive, layout (CHG6-8, SNK8-9).

All of it is Spark work over file metadata: ``_metadata`` columns of the parquet
reader for "which file holds which rows", the ``binaryFile`` source (content column
never selected, so no file is read) for storage listings. Nothing walks a directory
on the driver.
"""

from __future__ import annotations

import datetime as _dt
import math
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.functions import values as V


def file_report(spark: SparkSession, path: str, partition_cols: list[str] | None = None) -> DataFrame:
    """Per data file: file_path, record_count, file_size_in_bytes (+ partition values)."""
    df = spark.read.parquet(path)
    parts = [F.col(c) for c in (partition_cols or [])]
    return (df.select(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("file_size_in_bytes"), *parts)
            .groupBy("file_path", "file_size_in_bytes", *(partition_cols or []))
            .agg(F.count(F.lit(1)).alias("record_count")))


def table_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """(number of files, total bytes) from the storage listing: no file is opened. Two numbers to the driver."""
    r = storage_listing(spark, path).agg(F.count("path").alias("files"), F.sum("length").alias("bytes")).first()
    return int(r["files"] or 0), int(r["bytes"] or 0)


def compact(spark: SparkSession, path: str, out_path: str, target_bytes: int = V.TARGET_FILE_BYTES,
            partition_cols: list[str] | None = None, cluster_cols: list[str] | None = None) -> str:
    """Rewrite a whole table into files of about ``target_bytes`` in a new directory (CHG7; to rewrite only a table's
    small files, see ``filesets.FileTable.compact``).

    Without keys: ceil(total / target) evenly filled partitions. With cluster columns: as many ranges of them, by
    Spark's sampled bounds. With partition columns: dealt by them and by row into as many tasks, each row of a
    partition to one of the tasks that its share of the bytes needs, so that no single task writes a hot one. The
    source stays untouched; swapping directories is the caller's step once the row counts agree.
    """
    df = spark.read.parquet(path)
    _, total = table_size(spark, path)
    n = max(1, math.ceil(total / target_bytes))
    if partition_cols:
        rows = df.count()
        per_file = max(1, math.ceil(rows / n))     # rows of a file of the target size
        sizes = df.groupBy(*partition_cols).agg(F.ceil(F.count(F.lit(1)) / per_file).cast("int").alias("_files"))
        sizes = sizes.select(*[F.col(c).alias(f"_p_{c}") for c in partition_cols], "_files")
        same = [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in partition_cols]
        dealt = (df.join(sizes, same).withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.col("_files")))
                 .repartition(n, *partition_cols, "_part").sortWithinPartitions(*partition_cols, *(cluster_cols or []))
                 .select(*df.columns))
        dealt.write.mode("overwrite").partitionBy(*partition_cols).parquet(out_path)
    elif cluster_cols:
        (df.repartitionByRange(n, *cluster_cols).sortWithinPartitions(*cluster_cols)
         .write.mode("overwrite").parquet(out_path))
    else:
        df.repartition(n).write.mode("overwrite").parquet(out_path)
    return out_path


def storage_listing(spark: SparkSession, path: str) -> DataFrame:
    """Every data file under ``path``: file_path (spelled as ``_metadata.file_path`` spells it, escapes
    included, so that it compares with what a table read reports), path, length, modificationTime
    (content unread)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(path)
            .select(F.col("_metadata.file_path").alias("file_path"), "path", "length", "modificationTime"))


def orphan_files(spark: SparkSession, path: str, live: DataFrame | None = None,
                 older_than: _dt.timedelta = _dt.timedelta(days=3), now: _dt.datetime | None = None) -> DataFrame:
    """Files in storage that no live version references, older than the age floor (CHG8).

    ``live`` has a ``file_path`` column as ``_metadata.file_path`` gives it; by default the files the
    table read uses (for a streaming file sink: the files in its commit log). Report only. A live file
    that the listing lacks shows that the two sides don't name files alike: refused, as every file
    could then pass for an orphan.
    """
    if live is None:
        live = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file_path"))
    live = live.select(F.col("file_path").alias("live_path")).distinct()
    now = now or _dt.datetime.now()
    floor = F.lit(now - older_than).cast("timestamp")
    listed = storage_listing(spark, path)
    missing = live.join(listed, live.live_path == listed.file_path, "left_anti").limit(1).collect()
    if missing:
        raise ValueError(f"live file {missing[0][0]} is not in the listing of {path}")
    return (listed.join(live, listed.file_path == live.live_path, "left_anti")
            .filter(F.col("modificationTime") < floor))


def archive_by_day(df: DataFrame, out_path: str, day: _dt.date, load: str, col: str = "archive_date") -> DataFrame:
    """Add rows under ``archive_date=YYYY-MM-DD/load=<load>`` (SNK8, re-aimed upload): loads of one day stay
    side by side, and a load that is repeated replaces itself only. Returns the load as read back, after its row
    count was checked against that of the rows which the writing pass observed: then the source may be removed."""
    spark = df.sparkSession
    written = Observation()
    (df.observe(written, F.count(F.lit(1)).alias("rows"))
     .withColumn(col, F.lit(day).cast("date")).withColumn("load", F.lit(load)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(col, "load").parquet(out_path))
    schema = T.StructType([*df.schema, T.StructField(col, T.DateType()), T.StructField("load", T.StringType())])
    back = spark.read.schema(schema).parquet(out_path).filter(
        (F.col(col) == F.lit(day).cast("date")) & (F.col("load") == load)).drop("load")
    if back.count() != written.get["rows"]:
        raise RuntimeError(f"load {load} of {day} is not whole in {out_path}")
    return back


class DamagedArchive(RuntimeError):
    """The archive's contents are not those that were read from the source."""


def _fingerprint(name: str, digest: str) -> list:
    """Count, bytes and an order-free hash of the names and digests of files."""
    return [F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
            F.coalesce(F.bit_xor(F.xxhash64(name, digest)), F.lit(0)).alias("hash")]


def archive_files(spark: SparkSession, source: str, out_path: str, day: _dt.date, load: str) -> DataFrame:
    """SNK8 byte by byte: every file under ``source`` with its content, as a row of name (path below ``source``), length,
    sha256 and content under ``archive_date=.../load=...``. A repeated load replaces itself.

    The source is read once: the pass that writes also observes count, bytes and a hash of all digests. The archive
    is then read back, its contents are hashed anew and compared with both (``check_archive``). Returns name,
    length and sha256 as computed from the archive. A file is at most 2 GB, the limit of a binary value; files without a
    byte have no row, as Spark's file sources pass over them.
    """
    root = source.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .filter(~F.col("path").rlike("/[_.][^/]*$")))      # no marks of commits and no checksums
    rows = files.select(F.regexp_extract("path", "^.*?" + re.escape(re.sub("^[a-z]+:/*", "/", root)) + "/(.*)$", 1).alias("name"),
                        "length", F.sha2("content", 256).alias("sha256"), "content")
    read = Observation()
    (rows.observe(read, *_fingerprint("name", "sha256"))
     .withColumn("archive_date", F.lit(day).cast("date")).withColumn("load", F.lit(load)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("archive_date", "load").parquet(out_path))
    return check_archive(spark, out_path, day, load, read.get)


def restored_files(spark: SparkSession, out_path: str, day: _dt.date, load: str) -> DataFrame:
    """name, length, sha256, content of the files of a load."""
    schema = "name string, length bigint, sha256 string, content binary, archive_date date, load string"
    return spark.read.schema(schema).parquet(out_path).filter(
        (F.col("archive_date") == F.lit(day).cast("date")) & (F.col("load") == load)).select("name", "length", "sha256", "content")


def check_archive(spark: SparkSession, out_path: str, day: _dt.date, load: str, read: dict | None = None) -> DataFrame:
    """name, length, sha256 of a load, both computed from the archived contents. Refused (DamagedArchive) if a file is
    not as its row says, or if all of them are not what ``read`` observed at the source: then nothing may be removed."""
    held = restored_files(spark, out_path, day, load)
    again = held.select("name", F.length("content").cast("bigint").alias("length"), F.sha2("content", 256).alias("sha256"),
                        (~F.col("sha256").eqNullSafe(F.sha2("content", 256))
                         | ~F.col("length").eqNullSafe(F.length("content").cast("bigint"))).alias("damaged"))
    found = again.agg(*_fingerprint("name", "sha256"), F.count_if("damaged").alias("damaged")).first().asDict()
    damaged = found.pop("damaged")
    if damaged or (read is not None and found != read):
        raise DamagedArchive(f"load {load} of {day}: {damaged} damaged files; {found} archived, {read} read")
    return again.select("name", "length", "sha256")


def archived_day(spark: SparkSession, out_path: str, day: _dt.date, col: str = "archive_date") -> DataFrame:
    """All loads of one day."""
    return spark.read.parquet(out_path).filter(F.col(col) == F.lit(day).cast("date")).drop("load")


def archive_complete(source: DataFrame, archived: DataFrame) -> bool:
    """True when the archive holds as many rows as the source: removal allowed."""
    return source.count() == archived.count()


def layout_columns(df: DataFrame, ts_col: str = "ts", user_col: str = "user",
                   buckets: int = V.USER_BUCKETS) -> DataFrame:
    """SNK9 derived partition columns: day of ts, bucket of user, yyyyMM month."""
    return (df.withColumn("dt", F.to_date(ts_col))
            .withColumn("user_bucket", F.pmod(F.hash(F.col(user_col)), F.lit(buckets)).cast("int"))
            .withColumn("month", F.date_format(ts_col, "yyyyMM")))


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], sort_cols: list[str] | None = None,
                      max_records_per_file: int | None = None) -> str:
    """Hash-distributed write: one rebalance on the partition columns (hot partitions
    split at run time), sorted inside each task, then ``partitionBy``."""
    out = df.hint("rebalance", *partition_cols).sortWithinPartitions(*(partition_cols + (sort_cols or [])))
    w = out.write.mode("overwrite").partitionBy(*partition_cols)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)
    return path


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per (month, day) of a laid-out table. Partition discovery reads a yyyyMM
    folder name back as a number, so month is cast to text again."""
    return (df.withColumn("month", F.col("month").cast("string"))
            .groupBy("month", "dt").agg(F.count(F.lit(1)).alias("rows")))


def bucket_profile(df: DataFrame, user_col: str = "user", buckets: int = V.USER_BUCKETS) -> DataFrame:
    """Per day of a table laid out by (day, user bucket): rows, users (distinct ones of each bucket, added up)
    and strays (rows whose bucket is not that of their user)."""
    own = F.pmod(F.hash(F.col(user_col)), F.lit(buckets))
    per_bucket = df.groupBy("dt", "user_bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(user_col).alias("users"),
        F.count_if(~F.col("user_bucket").eqNullSafe(own)).alias("strays"))
    return per_bucket.groupBy("dt").agg(*[F.sum(c).alias(c) for c in ("rows", "users", "strays")])
