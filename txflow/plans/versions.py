"""Queries over tables kept as versions of file sets (CHG1, CHG2, CHG5, CHG7)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from txflow.operators.filesets import FileTable
from txflow.plans.registry import change_log, register, target_table
from txflow.session import work_dir
from txflow.sources import fixtures
from txflow.sources.tables import table

NEWEST = _dt.timedelta(days=90)
VALUES = ["id", "user", "amount", "ts"]


def _by_month(df):
    return df.withColumn("month", F.date_format("ts", "yyyyMM"))


def _month_of(path):
    return F.regexp_extract(path, "/month=([^/]+)/", 1)


def _newest_quarter(spark, sf_dir):
    """The time 90 days before the last order: one scalar."""
    return table(spark, sf_dir, "orders").agg(F.max("o_orderdate")).first()[0] - NEWEST


def _with_kept_months(t: FileTable, old: int, new: int):
    """The rows of version ``new``; month_kept tells whether all files that version ``old`` has of the row's month are
    files of ``new`` too (null: ``old`` has none)."""
    still = t.files(new).select("file_path", F.lit(True).alias("still"))
    months = (t.files(old).join(still, "file_path", "left").groupBy(_month_of("path").alias("month"))
              .agg(F.bool_and(F.coalesce("still", F.lit(False))).alias("month_kept")))
    return t.read(new).select(*VALUES, "month").join(months, "month", "left")


@register("merge_files")
def merge_files(spark, sf_dir):
    """CHG1 by files: the live table is stored by month; the settlements of the newest quarter's orders are merged, and
    only files that hold one of these orders are rewritten. The new version, and which months' files it kept."""
    orders = table(spark, sf_dir, "orders")
    recent = orders.filter(F.col("o_orderdate") > F.lit(_newest_quarter(spark, sf_dir)))
    t = FileTable.create(_by_month(target_table(spark, sf_dir)), f"{work_dir(spark, 'merge_files')}/table", ["month"])
    source = _by_month(fixtures.settlements(recent, table(spark, sf_dir, "lineitem")))
    done = t.merge(source, "id", update=["amount", "ts", "month"])
    return _with_kept_months(t, done.version - 1, done.version)


@register("update_files")
def update_files(spark, sf_dir):
    """CHG2 by files: the amounts of the newest quarter are set to 0; older months keep their files."""
    t = FileTable.create(_by_month(target_table(spark, sf_dir)), f"{work_dir(spark, 'update_files')}/table", ["month"])
    done = t.update("amount", 0.0, F.col("ts") > F.lit(_newest_quarter(spark, sf_dir)).cast("timestamp_ntz"))
    return _with_kept_months(t, done.version - 1, done.version)


@register("compact_files")
def compact_files(spark, sf_dir):
    """CHG7 by files: finished orders are stored by month, the others arrive in one load for each priority; the small
    files of these loads are packed toward the size of the largest file. By month: rows and amount afterwards,
    whether the new files are as few as their bytes need, and whether every large file stayed."""
    orders = table(spark, sf_dir, "orders")
    root = work_dir(spark, "compact_files")
    live = _by_month(fixtures.versioned_transactions(orders.filter("o_orderstatus = 'F'")))
    t = FileTable.create(live, f"{root}/table", ["month"])
    late = orders.filter("o_orderstatus <> 'F' or o_orderstatus is null")
    for r in late.select("o_orderpriority").distinct().orderBy("o_orderpriority").collect():    # five priorities
        t.append(_by_month(fixtures.as_versioned(late.filter(F.col("o_orderpriority").eqNullSafe(r[0])))))
    before = t.latest()
    target = t.files(before).agg(F.max("length")).first()[0]
    done = t.compact(target, sort_by=["id"])
    old, new = (t.files(v).withColumn("month", _month_of("path")) for v in (before, done.version))
    small = F.col("length") < 0.75 * target
    sizes = old.groupBy("month").agg(F.ceil(F.sum(F.when(small, F.col("length"))) / target).alias("need"))
    made = new.join(old.select("file_path"), "file_path", "left_anti").groupBy("month").agg(F.count("*").alias("made"))
    lost = old.filter(~small).join(new.select("file_path"), "file_path", "left_anti").groupBy("month").agg(F.count("*").alias("lost"))
    rows = t.read(done.version).groupBy("month").agg(
        F.count("*").alias("rows"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("amount"))
    out = rows.join(sizes, "month", "left").join(made, "month", "left").join(lost, "month", "left")
    return out.select("month", "rows", F.col("amount").cast("double").alias("amount"),
                      (F.coalesce("made", F.lit(0)) <= F.coalesce("need", F.lit(0))).alias("few_files"),
                      F.col("lost").isNull().alias("large_kept"))


@register("expire_files")
def expire_files(spark, sf_dir):
    """CHG5 by files: the change log's versions 1 to 4, each merged into the table of the one before (deletes too); the
    newest two are kept. By version and month: rows and amount as the version reads, and whether a kept
    version needs all of its files (if not, some may go)."""
    log = change_log(spark, sf_dir)
    path = f"{work_dir(spark, 'expire_files')}/log"
    log.filter("version <= 4").write.partitionBy("version").parquet(path)
    log = _by_month(spark.read.schema(log.schema).parquet(path))
    t = FileTable.create(log.filter("version = 1").select(*VALUES, "month"), f"{work_dir(spark, 'expire_files')}/table", ["month"])
    for v in (2, 3, 4):
        t.merge(log.filter(F.col("version") == v).drop("version", "committed_at"), "id", ["amount", "ts", "month"],
                delete=F.col("op") == "delete")
    gone = t.expirable(keep=2).select("file_path", F.lit(True).alias("gone"))
    out = None
    for v in t.versions():
        files = (t.files(v).join(gone, "file_path", "left").groupBy(_month_of("path").alias("month"))
                 .agg(F.bool_and(F.col("gone").isNull()).alias("all_needed")))
        rows = t.read(v).groupBy("month").agg(F.count("*").alias("rows"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("amount"))
        part = rows.join(files, "month").select(F.lit(v).alias("version"), "month", "rows",
                                                F.col("amount").cast("double").alias("amount"), "all_needed")
        out = part if out is None else out.unionByName(part)
    return out


@register("rollback_files")
def rollback_files(spark, sf_dir):
    """CHG4 by files: every amount is set to 0 (a new set of files), then the table is rolled back to the version before:
    its rows, all in the files that they were in."""
    t = FileTable.create(_by_month(target_table(spark, sf_dir)), f"{work_dir(spark, 'rollback_files')}/table", ["month"])
    t.update("amount", 0.0)
    done = t.rollback(1)
    return _with_kept_months(t, 1, done.version)
