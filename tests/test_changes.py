"""MERGE, UPDATE, as-of, history, retention, view, ensure table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from txflow.operators import changes
from txflow.sources import fixtures, schemas
from txflow.sources.tables import table
from tests.conftest import SF001

TS = dt.datetime(2026, 5, 1, 10, 0)


def target(spark):
    rows = [(1, "a", 10.0, TS), (1, "a2", 11.0, TS), (2, "b", 20.0, TS), (None, "n", 5.0, TS)]
    return spark.createDataFrame(rows, schemas.VERSIONED_TRANSACTIONS)


def test_merge_updates_every_match_and_inserts_new(spark):
    src = spark.createDataFrame([(1, "x", 777.0, TS), (3, "y", 300.0, TS), (None, "z", 1.0, TS)],
                                schemas.VERSIONED_TRANSACTIONS)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for limit in ("10MB", "-1"):  # broadcast plan and shuffle plan agree
        for k in keys:
            spark.conf.set(k, limit)
        try:
            out = changes.merge_upsert(target(spark), src, "id", ["amount", "ts"])
            got = sorted(((r.id, r.user, r.amount) for r in out.collect()), key=repr)
        finally:
            for k in keys:
                spark.conf.unset(k)
        assert got == sorted([(1, "a", 777.0), (1, "a2", 777.0), (2, "b", 20.0), (None, "n", 5.0),
                              (3, "y", 300.0), (None, "z", 1.0)], key=repr)


def test_merge_refuses_duplicate_source_keys(spark):
    src = spark.createDataFrame([(1, "x", 1.0, TS), (1, "y", 2.0, TS)], schemas.VERSIONED_TRANSACTIONS)
    with pytest.raises(changes.MergeCardinalityError):
        changes.merge_upsert(target(spark), src, "id", ["amount"])


def test_merge_broadcast_plan_does_not_shuffle_target(spark):
    src = spark.createDataFrame([(1, "x", 1.0, TS)], schemas.VERSIONED_TRANSACTIONS)
    out = changes.merge_upsert(target(spark), src, "id", ["amount"])
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_merge_of_large_source_deals_inserts_by_rows(spark):
    """Shuffled on two partitions by the session: no task of the insert side gets more rows than it is meant to."""
    n = 1_200_000
    frame = lambda a, b, amount: spark.range(a, b).select("id", F.lit("u").alias("user"), F.lit(amount).alias("amount"),
                                                           F.lit(TS).cast("timestamp_ntz").alias("ts"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = changes.merge_upsert(frame(0, n // 2, 1.0), frame(0, n, 2.0), "id", ["amount"])
        inserted = out.withColumn("task", F.spark_partition_id()).filter(F.col("id") >= n // 2).groupBy("task").count().collect()
        total = out.agg(F.count("*"), F.count_distinct("id"), F.sum("amount")).first()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(r["count"] for r in inserted) == n - n // 2
    assert max(r["count"] for r in inserted) <= 250_000
    assert tuple(total) == (n, n, 2.0 * n)


def test_update_column(spark):
    out = changes.update_column(target(spark), "amount", 0, F.col("id") == 1)
    assert sorted((r.amount for r in out.collect())) == [0.0, 0.0, 5.0, 20.0]


def log_rows(spark):
    def r(i, amount, op, v):
        return (i, "u", amount, TS, op, v, TS + dt.timedelta(hours=v))
    rows = [r(1, 1.0, "insert", 1), r(2, 2.0, "insert", 1), r(3, 3.0, "insert", 1),
            r(1, 10.0, "update", 2), r(2, 0.0, "delete", 3), r(3, 30.0, "update", 4),
            r(2, 22.0, "update", 5), r(1, 0.0, "delete", 6), r(4, 4.0, "insert", 7)]
    return spark.createDataFrame(rows, schemas.CHANGE_LOG)


def state(df):
    return sorted((r.id, r.amount) for r in df.collect())


def test_as_of_versions(spark):
    log = log_rows(spark)
    assert state(changes.as_of_version(log, 1)) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    assert state(changes.as_of_version(log, 3)) == [(1, 10.0), (3, 3.0)]
    assert state(changes.as_of_version(log, 7)) == [(2, 22.0), (3, 30.0), (4, 4.0)]


def test_retain_keeps_as_of_results_of_kept_versions(spark):
    log = log_rows(spark)
    kept = changes.retain_last_versions(log, 5)
    assert sorted({r.version for r in kept.collect()}) == [3, 4, 5, 6, 7]
    for v in range(3, 8):
        assert state(changes.as_of_version(kept, v)) == state(changes.as_of_version(log, v))
    assert kept.count() < log.count()


def test_history_newest_five(spark):
    hist = changes.version_history(log_rows(spark), 5).collect()
    assert [r.version for r in hist] == [7, 6, 5, 4, 3]
    assert {r.version: r.operation for r in hist} == {7: "append", 6: "delete", 5: "overwrite",
                                                     4: "overwrite", 3: "delete"}


def test_change_log_fixture_unique_per_version(spark):
    log = fixtures.change_log(table(spark, SF001, "orders"), table(spark, SF001, "lineitem"))
    assert log.groupBy("id", "version").count().filter("count > 1").count() == 0


def test_view_and_ensure_table(spark, tmp):
    v = changes.view_projection(spark, target(spark), "transactions_old_t", ["user", "amount", "ts"])
    assert v.columns == ["user", "amount", "ts"]
    t1 = changes.ensure_table(spark, "tx_ensure_t", schemas.VERSIONED_TRANSACTIONS, location=f"{tmp}/t")
    t2 = changes.ensure_table(spark, "tx_ensure_t", schemas.VERSIONED_TRANSACTIONS, location=f"{tmp}/t")
    assert t1.columns == t2.columns == ["id", "user", "amount", "ts"]
    desc = {r.col_name: r.data_type for r in spark.sql("DESCRIBE tx_ensure_t").collect()}
    assert desc["amount"] == "double" and desc["ts"] == "timestamp_ntz"


def test_as_of_over_bucketed_log_needs_no_shuffle(spark, tmp):
    """A change log saved bucketed by id: the as-of read groups inside the buckets
    (no Exchange in the final plan) and equals the read of the unbucketed log."""
    from txflow.sinks import writers
    log = fixtures.change_log(table(spark, SF001, "orders"), table(spark, SF001, "lineitem"))
    writers.save_bucketed(log, "tx_log_bucketed_t", ["id"], 4, f"{tmp}/log", ["id", "version"])
    stored = spark.table("tx_log_bucketed_t")
    assert stored.inputFiles() and len(stored.inputFiles()) <= 4          # one file per bucket
    got = changes.as_of_version(stored, 4)
    got.collect()
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    want = changes.as_of_version(log, 4)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_as_of_over_a_plain_log_combines_a_hot_key_before_the_shuffle(spark, tmp):
    """A third of the log on one id, stored plain: the as-of read shuffles with a partial
    aggregate and is exact."""
    n = 3000
    log = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("int").alias("id"),
        F.lit("u").alias("user"), F.col("id").cast("double").alias("amount"),
        F.lit(TS).cast("timestamp_ntz").alias("ts"), F.lit("update").alias("op"),
        (F.col("id") % 9 + 1).cast("int").alias("version"),
        F.lit(TS).cast("timestamp_ntz").alias("committed_at"))
    log.write.parquet(f"{tmp}/log")
    got = changes.as_of_version(spark.read.parquet(f"{tmp}/log"), 9)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "partial_max_by" in plan
    ids = {7 if i % 3 == 0 else i for i in range(n)}
    assert got.count() == changes.as_of_version(log, 9).count() == len(ids)


def test_merge_into_bucketed_target_shuffles_only_the_source(spark, tmp):
    """Target stored bucketed by id, source too large to broadcast: the target is
    read bucket by bucket on both merge branches; only the source is shuffled."""
    from txflow.sinks import writers
    orders = table(spark, SF001, "orders")
    writers.save_bucketed(fixtures.versioned_transactions(orders), "tx_target_b", ["id"], 8, f"{tmp}/target")
    source = fixtures.settlements(orders, table(spark, SF001, "lineitem"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = changes.merge_upsert(spark.table("tx_target_b"), source, "id", ["amount", "ts"])
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        scans = [l for l in plan.splitlines() if "FileScan" in l and "tx_target_b" in l]
        assert scans and all("Bucketed: true" in l for l in scans)
        final = plan.split("== Initial Plan ==")[0]
        assert final.count("Exchange hashpartitioning") <= 3   # the source, for each join at most
        want = changes.merge_upsert(fixtures.versioned_transactions(orders), source, "id", ["amount", "ts"])
        assert out.count() == want.count() and out.exceptAll(want).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
