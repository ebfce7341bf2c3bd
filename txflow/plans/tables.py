"""Table-change and file queries (CHG1-7, CHG9, SNK1, SNK8-9, SRC8)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from txflow.functions import values as V
from txflow.operators import changes, cleaning, files, reports
from txflow.plans.registry import change_log, raw_transactions, register, silver, target_table
from txflow.session import work_dir
from txflow.sinks import writers
from txflow.sources import fixtures, schemas
from txflow.sources.tables import csv_declared, csv_inferred, parquet_scan, table


# --- changing tables (CHG1-5, CHG9, SRC8) ----------------------------------------


AS_OF_VERSION = 4


@register("merge_upsert")
def merge_upsert(spark, sf_dir):
    """MERGE settlements into the live table: amount and ts of matched orders are
    replaced, pending orders (not in the table) are inserted."""
    source = fixtures.settlements(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
    return changes.merge_upsert(target_table(spark, sf_dir), source, "id", update=["amount", "ts"])


@register("update_column")
def update_column(spark, sf_dir):
    return changes.update_column(target_table(spark, sf_dir), "amount", 0.0)


@register("as_of_bucketed")
def as_of_bucketed(spark, sf_dir):
    """CHG4 over the change log stored bucketed by id (one shuffle, at write): the
    as-of read groups by id inside each bucket, with no shuffle."""
    root = work_dir(spark, "log_bucketed")
    name = "txflow_log_" + root.rsplit("-", 1)[1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writers.save_bucketed(change_log(spark, sf_dir), name, ["id"], buckets, f"{root}/log", ["id", "version"])
    return _detached(spark, name, changes.as_of_version(spark.table(name), AS_OF_VERSION))


def _detached(spark, name, df):
    """``df``, whose table's catalog entry is dropped; the files of a table with a location stay."""
    df.schema   # resolved before the entry goes
    spark.sql(f"DROP TABLE {name}")
    return df


@register("version_history")
def version_history(spark, sf_dir):
    return changes.version_history(change_log(spark, sf_dir), V.RETAIN_LAST_VERSIONS)


@register("as_of_version")
def as_of_version(spark, sf_dir):
    return changes.as_of_version(change_log(spark, sf_dir), AS_OF_VERSION)


@register("retain_last_versions")
def retain_last_versions(spark, sf_dir):
    """CHG5 over the stored log, one folder per version: the newest versions, the baseline and the tail each
    read the files they need, and the log is computed once."""
    path = f"{work_dir(spark, 'log')}/log"
    log = change_log(spark, sf_dir)
    files.write_partitioned(log, path, ["version"])
    return changes.retain_last_versions(spark.read.schema(log.schema).parquet(path).select(*log.columns),
                                        V.RETAIN_LAST_VERSIONS)


@register("view_projection")
def view_projection(spark, sf_dir):
    return changes.view_projection(spark, target_table(spark, sf_dir), "transactions_old", ["user", "amount", "ts"])


@register("append_table")
def append_table_q(spark, sf_dir):
    """SNK6 + CHG10: the table is created when missing from the fixed DDL (a second
    create is a no-op), then two loads are appended to it: the live orders, later
    the pending ones. Read back, it holds every order once."""
    root = work_dir(spark, "append")
    name = "txflow_tx_" + root.rsplit("-", 1)[1]
    orders = table(spark, sf_dir, "orders")
    for _ in range(2):
        changes.ensure_table(spark, name, schemas.VERSIONED_TRANSACTIONS, location=f"{root}/table")
    writers.append_table(fixtures.versioned_transactions(orders), name)
    writers.append_table(fixtures.pending_transactions(orders), name)
    return _detached(spark, name, spark.table(name))


@register("describe_table")
def describe_table(spark, sf_dir):
    """SRC9: column names and types of the transactions table, stored from all orders."""
    root = work_dir(spark, "describe")
    name = "txflow_desc_" + root.rsplit("-", 1)[1]
    changes.ensure_table(spark, name, schemas.VERSIONED_TRANSACTIONS, location=f"{root}/table")
    writers.append_table(fixtures.versioned_transactions(table(spark, sf_dir, "orders")), name)
    return _detached(spark, name, reports.describe(spark, name))


@register("profile_table")
def profile_table(spark, sf_dir):
    """SRC9 with content: type, rows, nulls and range of every column of the raw transactions."""
    return reports.profile(raw_transactions(spark, sf_dir))


@register("peek_ordered")
def peek_ordered(spark, sf_dir):
    return reports.peek_ordered(target_table(spark, sf_dir), 5, "id")


# --- files and layout (SNK1, SNK8, SNK9, CHG6, CHG7) ---------------------------------



ARCHIVE_DAY = _dt.date(2024, 1, 31)


@register("silver_roundtrip")
def silver_roundtrip(spark, sf_dir):
    """SNK1 + SRC3: silver written as parquet (overwrite), read back with a projection."""
    path = writers.overwrite_parquet(silver(spark, sf_dir), f"{work_dir(spark, 'silver')}/data")
    return parquet_scan(spark, path, cleaning.SILVER_COLUMNS)


@register("compact")
def compact(spark, sf_dir):
    """CHG7: silver in small files, rewritten toward 128 MB files; the rows are the same."""
    root = work_dir(spark, "compact")
    silver(spark, sf_dir).repartition(16).write.parquet(f"{root}/small")
    files.compact(spark, f"{root}/small", f"{root}/compacted", cluster_cols=["id"])
    return spark.read.parquet(f"{root}/compacted")


@register("file_report")
def file_report(spark, sf_dir):
    """CHG6: the file report of the laid-out transactions table, added up per partition value (file names
    differ from run to run); ``empty_files`` counts files without rows or bytes."""
    root = work_dir(spark, "layout")
    laid = files.layout_columns(target_table(spark, sf_dir))
    files.write_partitioned(laid, f"{root}/table", ["month"])
    report = files.file_report(spark, f"{root}/table", ["month"])
    return report.groupBy(F.col("month").cast("string").alias("month")).agg(
        F.sum("record_count").alias("record_count"),
        F.count_if((F.col("record_count") == 0) | (F.col("file_size_in_bytes") <= 0)).alias("empty_files"))


@register("orphan_files")
def orphan_files_q(spark, sf_dir):
    """CHG8: live orders by priority (one has a blank in its name, so the folder too); the pending orders land in
    the same folders without being referenced. Rows behind the files reported as orphans, by priority."""
    root = work_dir(spark, "orphans")
    orders = table(spark, sf_dir, "orders")
    shown = orders.select("o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias("priority"))
    shown.filter("o_orderstatus <> 'P'").write.partitionBy("priority").parquet(f"{root}/table")
    live = files.file_report(spark, f"{root}/table").select("file_path")
    live.write.parquet(f"{root}/live")
    shown.filter("o_orderstatus = 'P'").write.mode("append").partitionBy("priority").parquet(f"{root}/table")
    later = _dt.datetime.now() + _dt.timedelta(days=10)
    strays = files.orphan_files(spark, f"{root}/table", spark.read.parquet(f"{root}/live"), now=later)
    behind = files.file_report(spark, f"{root}/table", ["priority"]).join(strays.select("file_path"), "file_path", "left_semi")
    return behind.groupBy("priority").agg(F.sum("record_count").alias("orphan_rows"))


@register("partition_profile")
def partition_profile(spark, sf_dir):
    """SNK9: transactions written by (month) with day and user bucket columns, read back
    and profiled per (month, day)."""
    root = work_dir(spark, "layout")
    laid = files.layout_columns(target_table(spark, sf_dir))
    files.write_partitioned(laid, f"{root}/table", ["month"], ["dt", "user_bucket"])
    return files.partition_profile(spark.read.parquet(f"{root}/table"))


@register("day_bucket_layout")
def day_bucket_layout(spark, sf_dir):
    """SNK9: events written by (day, bucket of the user), one folder each, read back and profiled per day.
    ``users`` adds up the distinct users of each bucket, so it is right only if no user is in two buckets;
    ``strays`` counts rows in a folder that is not their user's."""
    root = work_dir(spark, "layout")
    laid = files.layout_columns(table(spark, sf_dir, "events"), "ts", "user_id")
    files.write_partitioned(laid.drop("month"), f"{root}/table", ["dt", "user_bucket"])
    return files.bucket_profile(spark.read.parquet(f"{root}/table"), "user_id")


@register("archive_by_day")
def archive_by_day(spark, sf_dir):
    """SNK8 re-aimed: the day's silver, stored once, copied under archive_date=2024-01-31 in two loads, the second one
    repeated; both are read back whole."""
    root = work_dir(spark, "archive")
    rows = parquet_scan(spark, writers.overwrite_parquet(silver(spark, sf_dir), f"{root}/silver"))
    for load, part in (("even", F.col("id") % 2 == 0), ("odd", F.col("id") % 2 == 1), ("odd", F.col("id") % 2 == 1)):
        files.archive_by_day(rows.filter(part), f"{root}/archive", ARCHIVE_DAY, load)
    return files.archived_day(spark, f"{root}/archive", ARCHIVE_DAY)


@register("archive_files")
def archive_files(spark, sf_dir):
    """SNK8 byte by byte: the orders as text files, one a month, archived with their contents; length and digest of
    every file as the archive holds it."""
    root = work_dir(spark, "archive_files")
    fixtures.order_lines(table(spark, sf_dir, "orders")).write.partitionBy("month").text(f"{root}/raw")
    held = files.archive_files(spark, f"{root}/raw", f"{root}/archive", ARCHIVE_DAY, "orders")
    return held.select(F.regexp_extract("name", "month=([0-9]+)/", 1).alias("month"), "length", "sha256")


@register("csv_declared")
def csv_declared_q(spark, sf_dir):
    """SRC1: the raw transactions as CSV, read back with the declared DDL schema; an
    empty cell comes back as NULL, as with the reader's defaults."""
    path = writers.write_csv(raw_transactions(spark, sf_dir), f"{work_dir(spark, 'csv')}/raw")
    return csv_declared(spark, path)


@register("csv_inferred")
def csv_inferred_q(spark, sf_dir):
    """SRC2: the same CSV with an inferred schema (one extra pass decides the types)."""
    path = writers.write_csv(raw_transactions(spark, sf_dir), f"{work_dir(spark, 'csv')}/raw")
    return csv_inferred(spark, path)


# --- layouts, defaults and views of stored tables (JN1, CHG9, CHG10, CLN14) ---------------------------


def month_dimension(orders):
    """month, quarter of every month that has orders."""
    return orders.select(F.date_format("o_orderdate", "yyyyMM").alias("month"), F.quarter("o_orderdate").alias("quarter")).distinct()


@register("join_pruned")
def join_pruned(spark, sf_dir):
    """JN1 over a partitioned fact: the live table is stored by month, the months of fourth quarters are joined to it; only
    their folders are read. Rows and turnover per month."""
    root = work_dir(spark, "join_pruned")
    files.write_partitioned(target_table(spark, sf_dir).withColumn("month", F.date_format("ts", "yyyyMM")), f"{root}/fact", ["month"])
    writers.overwrite_parquet(month_dimension(table(spark, sf_dir, "orders")), f"{root}/months")
    fact = spark.read.schema(f"{schemas.VERSIONED_TRANSACTIONS}, month STRING").parquet(f"{root}/fact")
    report = reports.turnover_by_partition(fact, spark.read.parquet(f"{root}/months").filter("quarter = 4"), "month")
    return report.withColumn("turnover", F.col("turnover").cast("double"))


@register("insert_defaults")
def insert_defaults(spark, sf_dir):
    """CHG10 + CLN14: the table's DDL has a default for each field; order messages arrive whole, event messages without
    amount and category, which become 0 and empty when they are stored."""
    root = work_dir(spark, "defaults")
    name = "txflow_defaults_" + root.rsplit("-", 1)[1]
    changes.ensure_table(spark, name, schemas.MESSAGE_WITH_DEFAULTS, location=f"{root}/table")
    changes.insert_columns(fixtures.messages_from_orders(table(spark, sf_dir, "orders")), name)
    changes.insert_columns(fixtures.messages_from_events(table(spark, sf_dir, "events")).select("id", "user", "timestamp"), name)
    return _detached(spark, name, spark.table(name))


@register("persistent_view")
def persistent_view(spark, sf_dir):
    """CHG9 in the catalog: the view over the stored table is read before and after every amount is set to 0 and the table
    got a column more."""
    root = work_dir(spark, "view")
    name = "txflow_viewed_" + root.rsplit("-", 1)[1]
    changes.ensure_table(spark, name, schemas.VERSIONED_TRANSACTIONS, location=f"{root}/first")
    writers.append_table(target_table(spark, sf_dir), name)
    view = changes.ensure_view(spark, f"{name}_old", name, ["user", "amount", "ts"])
    before = parquet_scan(spark, writers.overwrite_parquet(view, f"{root}/before"))
    changes.replace_rows(changes.update_column(spark.table(name), "amount", 0.0), name, f"{root}/second")
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS (city STRING)")
    after = parquet_scan(spark, writers.overwrite_parquet(spark.table(f"{name}_old"), f"{root}/after"))
    spark.sql(f"DROP VIEW {name}_old")
    spark.sql(f"DROP TABLE {name}")
    return before.select(F.lit("before").alias("phase"), "*").unionByName(after.select(F.lit("after").alias("phase"), "*"))
