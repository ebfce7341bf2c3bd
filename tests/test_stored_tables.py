"""Pruned joins over stored tables, column defaults, views in the catalog, byte-exact archives."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from txflow.operators import changes, files, reports
from txflow.plans import QUERIES
from txflow.session import local_path
from txflow.sources import schemas

DAY = dt.date(2024, 1, 31)


def scanned_files(df):
    """Files that the scans of an executed query opened."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    found, todo = {}, [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found[node.relation().location().rootPaths().head().toString()] = node.metrics().apply("numFiles").value()
        if hasattr(node, "plan") and node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_a_filtered_dimension_prunes_the_fact_at_run_time(spark, tmp):
    fact = spark.range(1000).select("id", (F.col("id") % 40).cast("int").alias("day"), F.lit(1.5).alias("amount"))
    files.write_partitioned(fact, f"{tmp}/fact", ["day"])
    days = spark.range(40).select(F.col("id").cast("int").alias("day"), (F.col("id") % 10).alias("kind"))
    days.write.parquet(f"{tmp}/days")
    out = reports.turnover_by_partition(spark.read.parquet(f"{tmp}/fact"), spark.read.parquet(f"{tmp}/days").filter("kind = 3"), "day")
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r)[:2] for r in out.collect()) == [(3, 25), (13, 25), (23, 25), (33, 25)]
    opened = scanned_files(out)
    everything = files.table_size(spark, f"{tmp}/fact")[0]
    assert everything >= 40 and opened[f"file:{local_path(tmp)}/fact"] <= everything // 10


def test_absent_fields_take_the_defaults_of_the_ddl(spark, tmp):
    changes.ensure_table(spark, "tx_defaults_t", schemas.MESSAGE_WITH_DEFAULTS, location=f"{tmp}/t")
    changes.insert_columns(spark.sql("select 5L id, 'food' category"), "tx_defaults_t")
    changes.insert_columns(spark.sql("select 'u' user, cast(null as double) amount"), "tx_defaults_t")
    got = sorted((tuple(r) for r in spark.table("tx_defaults_t").select("id", "user", "amount", "timestamp", "category").collect()), key=repr)
    assert got == [(0, "u", None, 0, ""), (5, "", 0.0, 0, "food")]    # a NULL that is given stays
    spark.sql("DROP TABLE tx_defaults_t")


def test_a_view_outlives_update_and_new_column(spark, tmp):
    changes.ensure_table(spark, "tx_viewed_t", schemas.VERSIONED_TRANSACTIONS, location=f"{tmp}/one")
    changes.insert_columns(spark.sql("select 1L id, 'a' user, 2.5D amount"), "tx_viewed_t")
    view = changes.ensure_view(spark, "tx_view_t", "tx_viewed_t", ["user", "amount"])
    assert [tuple(r) for r in view.collect()] == [("a", 2.5)]
    changes.ensure_view(spark, "tx_view_t", "tx_viewed_t", ["user", "amount"])      # a second time is no error
    changes.replace_rows(changes.update_column(spark.table("tx_viewed_t"), "amount", 0.0), "tx_viewed_t", f"{tmp}/two")
    spark.sql("ALTER TABLE tx_viewed_t ADD COLUMNS (city STRING)")
    assert [tuple(r) for r in spark.table("tx_view_t").collect()] == [("a", 0.0)]
    assert "tx_view_t" in [t.name for t in spark.catalog.listTables()] and not spark.catalog._jcatalog.getTable("tx_view_t").isTemporary()
    spark.sql("DROP VIEW tx_view_t")
    spark.sql("DROP TABLE tx_viewed_t")


def raw_files(tmp):
    root = os.path.join(local_path(tmp), "raw")
    os.makedirs(f"{root}/a b", exist_ok=True)
    for name, content in (("x.bin", bytes(range(256)) * 10), ("a b/y é.txt", b"line\n"), ("empty", b"")):
        with open(f"{root}/{name}", "wb") as f:
            f.write(content)
    return root


def test_archive_holds_every_byte(spark, tmp):
    import hashlib
    root = raw_files(tmp)
    got = {r.name: (r.length, r.sha256) for r in files.archive_files(spark, root, f"{tmp}/arch", DAY, "one").collect()}
    want = {n: open(f"{root}/{n}", "rb").read() for n in ("x.bin", "a b/y é.txt")}     # Spark passes over the empty file
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in want.items()}
    back = files.restored_files(spark, f"{tmp}/arch", DAY, "one").collect()
    assert {r.name: bytes(r.content) for r in back} == want
    files.archive_files(spark, root, f"{tmp}/arch", DAY, "two")
    files.archive_files(spark, root, f"{tmp}/arch", DAY, "two")          # repeated: replaces itself
    assert files.restored_files(spark, f"{tmp}/arch", DAY, "two").count() == 2
    assert files.restored_files(spark, f"{tmp}/arch", DAY, "one").count() == 2


def test_a_damaged_or_short_archive_is_refused(spark, tmp):
    root = raw_files(tmp)
    files.archive_files(spark, root, f"{tmp}/arch", DAY, "one")
    held = files.restored_files(spark, f"{tmp}/arch", DAY, "one")

    def stored(df, path):
        (df.withColumn("archive_date", F.lit(DAY)).withColumn("load", F.lit("one"))
         .write.partitionBy("archive_date", "load").parquet(path))
        return path

    broken = stored(held.withColumn("content", F.when(F.col("name") == "x.bin", F.lit(b"?")).otherwise(F.col("content"))), f"{tmp}/broken")
    with pytest.raises(files.DamagedArchive):
        files.check_archive(spark, broken, DAY, "one")
    read = held.agg(*files._fingerprint("name", "sha256")).first().asDict()
    files.check_archive(spark, f"{tmp}/arch", DAY, "one", read)
    short = stored(held.filter("name = 'x.bin'"), f"{tmp}/short")
    with pytest.raises(files.DamagedArchive):
        files.check_archive(spark, short, DAY, "one", read)


def test_archive_by_day_counts_in_the_writing_pass(spark, tmp, monkeypatch):
    """The source is computed once: an accumulator sees each of its rows a single time."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(100).repartition(3).mapInArrow(counted, "id long")
    assert files.archive_by_day(df, f"{tmp}/a", DAY, "one").count() == 100
    assert seen.value == 100
    files.archive_by_day(df.limit(0), f"{tmp}/a", DAY, "none")


def test_compact_leaves_the_session_as_it_was(spark, tmp):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    calls = []
    spark.range(5000).withColumn("p", F.col("id") % 2).repartition(8).write.parquet(f"{tmp}/s")
    real = type(spark.conf).set
    try:
        type(spark.conf).set = lambda self, k, v: calls.append(k) or real(self, k, v)
        files.compact(spark, f"{tmp}/s", f"{tmp}/o", 20_000, partition_cols=["p"])
    finally:
        type(spark.conf).set = real
    assert not calls and spark.conf.get(key) == before
    out = spark.read.parquet(f"{tmp}/o")
    assert out.count() == 5000 and out.select("id").distinct().count() == 5000
    assert files.table_size(spark, f"{tmp}/o")[0] <= 2 * files.table_size(spark, f"{tmp}/s")[1] // 20_000 + 2


def test_queries_read_their_tables(spark):
    assert QUERIES["join_pruned"](spark, SF001).count() > 0
