"""File report, compaction, orphans, archive, layout, sinks, readers."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from txflow.operators import files
from txflow.session import local_path
from txflow.sinks import writers
from txflow.sources import schemas
from txflow.sources.tables import csv_declared, csv_inferred, generate_users
from tests.conftest import needs_database


def data(spark, n=1000):
    return spark.range(n).select(F.col("id").cast("int").alias("id"), (F.col("id") % 7).cast("string").alias("user"),
                                 (F.col("id") * 1.5).alias("amount"),
                                 F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"))


def test_file_report_and_compact(spark, tmp):
    data(spark).repartition(12).write.parquet(f"{tmp}/small")
    rep = files.file_report(spark, f"{tmp}/small").collect()
    assert len(rep) == 12 and sum(r.record_count for r in rep) == 1000
    files.compact(spark, f"{tmp}/small", f"{tmp}/big", cluster_cols=["id"])
    n_files, _ = files.table_size(spark, f"{tmp}/big")
    assert n_files == 1
    assert spark.read.parquet(f"{tmp}/big").count() == 1000


def test_compact_partitioned(spark, tmp):
    files.layout_columns(data(spark)).write.partitionBy("user_bucket").parquet(f"{tmp}/p")
    files.compact(spark, f"{tmp}/p", f"{tmp}/pc", partition_cols=["user_bucket"])
    assert spark.read.parquet(f"{tmp}/pc").count() == 1000


def test_orphan_files(spark, tmp):
    data(spark).write.parquet(f"{tmp}/t")
    live = files.file_report(spark, f"{tmp}/t").select("file_path")
    stray = os.path.join(local_path(f"{tmp}/t"), "part-99999-stray.parquet")
    data(spark, 3).coalesce(1).write.parquet(f"{tmp}/stray")
    src = [f for f in os.listdir(local_path(f"{tmp}/stray")) if f.endswith(".parquet")][0]
    os.link(os.path.join(local_path(f"{tmp}/stray"), src), stray)
    old = time.time() - 10 * 86400
    os.utime(stray, (old, old))
    orphans = files.orphan_files(spark, f"{tmp}/t", live=live).collect()
    assert [os.path.basename(r.path) for r in orphans] == ["part-99999-stray.parquet"]
    # young files are never reported
    assert files.orphan_files(spark, f"{tmp}/t", live=live, older_than=dt.timedelta(days=30)).count() == 0


def test_no_live_file_is_an_orphan_whatever_its_folder_is_called(spark, tmp):
    names = ["a b", "x:y", "50%", "é", "plain", "a=b", "q?#"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, kind string")
    df.write.partitionBy("kind").parquet(f"{tmp}/odd names")
    later = dt.datetime.now() + dt.timedelta(days=30)
    assert files.orphan_files(spark, f"{tmp}/odd names", now=later).count() == 0
    live = files.file_report(spark, f"{tmp}/odd names", ["kind"])
    found = files.orphan_files(spark, f"{tmp}/odd names", live=live.filter("kind <> 'a b'"), now=later).collect()
    assert len(found) == 1 and "a b" in found[0].path
    with pytest.raises(ValueError):
        files.orphan_files(spark, f"{tmp}/odd names", live=spark.createDataFrame([("file:/elsewhere",)], "file_path string"))


def test_archive_by_day(spark, tmp):
    src = data(spark)
    day = dt.date(2024, 1, 31)
    back = files.archive_by_day(src, f"{tmp}/a", day, "one")
    assert files.archive_complete(src, back)
    assert os.path.isdir(os.path.join(local_path(f"{tmp}/a"), "archive_date=2024-01-31"))
    files.archive_by_day(src.limit(2), f"{tmp}/a", day, "two")
    files.archive_by_day(src.limit(2), f"{tmp}/a", day, "two")   # repeated: replaces itself
    files.archive_by_day(src, f"{tmp}/a", dt.date(2024, 2, 1), "one")
    assert files.archived_day(spark, f"{tmp}/a", day).count() == src.count() + 2


def test_layout_and_partition_pruning(spark, tmp):
    laid = files.layout_columns(data(spark))
    files.write_partitioned(laid, f"{tmp}/l", ["month", "user_bucket"], ["id"], max_records_per_file=100)
    df = spark.read.parquet(f"{tmp}/l").filter(F.col("user_bucket") == 3)
    assert "PartitionFilters: [isnotnull(user_bucket" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == laid.filter(F.col("user_bucket") == 3).count()


def test_csv_readers_and_sinks(spark, tmp):
    p = f"{local_path(tmp)}/raw.csv"
    with open(p, "w") as f:
        f.write("id,user_id,amount,category,timestamp,city\n1,2,\"3,5\",food,2024-01-01 10:00:00,la\nx,3,4,a,b,c\n")
    declared = csv_declared(spark, p).collect()
    assert declared[0].amount == "3,5" and declared[1].id is None      # malformed typed cell -> NULL
    inferred = csv_inferred(spark, p)
    assert dict(inferred.dtypes)["id"] == "string"                      # an extra pass decided the types
    out = writers.overwrite_parquet(spark.createDataFrame(declared, schemas.RAW_TRANSACTIONS), f"{tmp}/silver")
    writers.append_parquet(spark.read.parquet(out), f"{tmp}/silver2")
    writers.append_parquet(spark.read.parquet(out), f"{tmp}/silver2")
    assert spark.read.parquet(f"{tmp}/silver2").count() == 4


def test_generate_users(spark):
    df = generate_users(spark, 100_000, dt.datetime(2024, 1, 1))
    assert df.count() == 100_000
    r = df.filter("id = 42").first()
    assert r.user == "user_42"


@needs_database
def test_jdbc_append_flattens_window(spark):
    url = "jdbc:derby:memory:txflow_ja;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(t0, t0, "a", 1.0, 1)], "s timestamp, e timestamp, category string, total_sum double, "
                               "tx_count bigint").select(
        F.struct(F.col("s").alias("start"), F.col("e").alias("end")).alias("window"), "category", "total_sum",
        "tx_count")
    writers.jdbc_append(df, url, "WFLAT", props)
    back = spark.read.format("jdbc").option("url", url).option("dbtable", "WFLAT").options(**props).load()
    assert set(back.columns) == {"category", "total_sum", "tx_count", "window_start", "window_end"}


def test_append_table(spark, tmp):
    spark.sql("DROP TABLE IF EXISTS tx_append_t")
    df = data(spark, 10)
    writers.append_table(df, "tx_append_t", f"{tmp}/wh/tx_append_t")
    writers.append_table(df, "tx_append_t", f"{tmp}/wh/tx_append_t")
    assert spark.table("tx_append_t").count() == 20
    spark.sql("DROP TABLE tx_append_t")


def test_scale_settings_size_partitions_to_the_input():
    from txflow.session import MB, scale_settings
    big = scale_settings(100 * 1024 ** 4, cores=8000)          # 100 TB on 1000 x 8 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 96_000   # capped at 100k, whole waves
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 * MB
    mid = scale_settings(1024 ** 4, cores=800)                 # 1 TB: 4096 splits -> 4800 (6 waves)
    assert int(mid["spark.sql.shuffle.partitions"]) == 4800
    small = scale_settings(10 * MB, cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16    # at least two tasks per core
