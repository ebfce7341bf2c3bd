"""Versions as sets of files: which files a merge, an update, a compaction and an expiry touch."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from txflow.operators import changes
from txflow.operators.filesets import FileTable
from txflow.session import local_path
from txflow.sources import schemas

T0 = dt.datetime(2024, 1, 1)


def rows(spark, n=1000, months=10):
    """Ids in order of their months: a narrow range of ids lies in few files."""
    return spark.range(n).select(
        "id", (F.col("id") % 7).cast("string").alias("user"), (F.col("id") * 1.5).alias("amount"),
        F.lit(T0).cast("timestamp_ntz").alias("ts"), (F.col("id") * months / n).cast("int").alias("month"))


def state(df):
    return sorted(((r.id, r.user, r.amount, r.month) for r in df.collect()), key=repr)


def names(table, version):
    return {r.file_path for r in table.files(version).collect()}


def test_merge_rewrites_only_the_files_that_hold_matched_keys(spark, tmp):
    t = FileTable.create(rows(spark), f"{tmp}/t", ["month"])
    assert len(names(t, 1)) == 10
    source = spark.createDataFrame([(305, "x", -1.0, T0, 3), (309, "x", -2.0, T0, 3), (5000, "new", 1.0, T0, 42), (None, "n", 2.0, T0, 3)],
                                   f"{schemas.VERSIONED_TRANSACTIONS}, month int")
    plain = changes.merge_upsert(t.read().select("id", "user", "amount", "ts", "month"), source, "id", ["amount"])
    want = state(plain)
    done = t.merge(source, "id", ["amount"])
    assert (done.version, done.kept, done.removed) == (2, 9, 1)
    old, new = names(t, 1), names(t, 2)
    assert all("month=3/" in p for p in old - new) and len(old & new) == 9
    assert state(t.read()) == want
    assert state(t.read(1)) == state(rows(spark))           # the old version reads as before
    times = {p: os.stat(local_path(p)).st_mtime_ns for p in old}
    t.merge(source.filter("id = 305"), "id", ["amount"])
    assert times == {p: os.stat(local_path(p)).st_mtime_ns for p in old}


def test_the_scan_for_matched_keys_is_pruned(spark, tmp):
    t = FileTable.create(rows(spark), f"{tmp}/t", ["month"])
    scan = t.read().filter(F.col("id").between(300, 310)).select("id", F.col("_metadata.file_path").alias("file_path"))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,300), LessThanOrEqual(id,310)]" in plan
    assert "ReadSchema: struct<id:bigint>" in plan


def test_merge_deletes_refuses_and_changes_nothing(spark, tmp):
    t = FileTable.create(rows(spark, 100, 4), f"{tmp}/t", ["month"])
    source = spark.createDataFrame([(1, "x", None, None, 0), (500, "x", None, None, 0), (99, "y", 7.0, T0, 3)],
                                   f"{schemas.VERSIONED_TRANSACTIONS}, month int")
    done = t.merge(source, "id", ["amount"], delete=F.col("amount").isNull())
    assert (done.kept, done.removed) == (2, 2)
    got = {r.id: r.amount for r in t.read().collect()}
    assert 1 not in got and 500 not in got and got[99] == 7.0 and len(got) == 99
    with pytest.raises(changes.MergeCardinalityError):
        t.merge(source.unionByName(source), "id", ["amount"])
    assert t.latest() == 2
    none = t.merge(source.filter("false"), "id", ["amount"])
    assert (none.version, none.kept, none.removed, none.added) == (3, 4, 0, 0)


def test_update_rewrites_only_files_with_a_selected_row(spark, tmp):
    t = FileTable.create(rows(spark), f"{tmp}/t", ["month"])
    done = t.update("amount", 0, F.col("id").between(250, 349))
    assert (done.kept, done.removed) == (8, 2)
    assert state(t.read()) == state(changes.update_column(rows(spark), "amount", 0, F.col("id").between(250, 349)))
    assert t.update("amount", 0, F.col("id") < 0).removed == 0
    assert t.update("amount", 1).kept == 0


def test_compaction_packs_small_files_and_leaves_large_ones(spark, tmp):
    big = rows(spark, 60_000, 3)
    t = FileTable.create(big, f"{tmp}/t", ["month"])
    for i in range(6):
        t.append(rows(spark, 300, 3).withColumn("id", F.col("id") + 100_000 * (i + 1)))
    before = t.files(t.latest()).collect()
    small = sorted(r.length for r in before)[:18]
    target = small[-1] * 3
    assert sum(r.length >= 0.75 * target for r in before) == 3
    want = state(t.read())
    done = t.compact(target, sort_by=["id"])
    after = t.files(done.version).collect()
    assert {r.file_path for r in before if r.length >= 0.75 * target} <= {r.file_path for r in after}
    for month in range(3):
        total = sum(r.length for r in before if f"month={month}/" in r.path and r.length < 0.75 * target)
        new = [r for r in after if f"month={month}/" in r.path and r.file_path not in {x.file_path for x in before}]
        assert 0 < len(new) <= -(-total // target)
    assert state(t.read()) == want
    again = t.compact(target)
    assert again.added <= done.added
    assert t.compact(1).removed == 0


def test_expiry_reports_only_files_that_no_kept_version_needs(spark, tmp):
    t = FileTable.create(rows(spark, 100, 5), f"{tmp}/t", ["month"])
    for low in (0, 20, 0):
        t.update("amount", low, F.col("id").between(low, low + 5))
    first = names(t, 1)
    found = {r.file_path: (r.added, r.last) for r in t.expirable(1).collect()}
    assert set(found) == (first | names(t, 2) | names(t, 3)) - names(t, 4)
    assert sorted(found.values()) == [(1, 1), (1, 2), (2, 3)]
    assert {r.file_path for r in t.expirable(2).collect()} == first - names(t, 3) - names(t, 4)
    assert t.expirable(4).count() == 0
    back = t.rollback(1)
    assert back.version == 5 and state(t.read()) == state(rows(spark, 100, 5)) and names(t, 5) == first
    assert not {r.file_path for r in t.expirable(1).collect()} & first


def test_a_write_that_is_cut_off_is_no_version(spark, tmp):
    t = FileTable.create(rows(spark, 100, 2), f"{tmp}/t", ["month"])
    t._write(rows(spark, 10, 1))                                              # files, but no list
    stray = t.files(1).limit(1)
    stray.write.parquet(f"{tmp}/t/files/version=2")
    os.rename(local_path(f"{tmp}/t/files/version=2/_SUCCESS"), local_path(f"{tmp}/t/files/version=2/_lost"))
    assert t.versions() == [1] and t.read().count() == 100
    later = dt.datetime.now() + dt.timedelta(days=10)
    left = {r.file_path for r in t.orphans(now=later).collect()}
    assert len(left) == 1 and not left & names(t, 1) and t.orphans().count() == 0
    t.append(rows(spark, 5, 1))
    assert t.versions() == [1, 2] and t.read().count() == 105


def test_unpartitioned_table_and_odd_names(spark, tmp):
    t = FileTable.create(rows(spark, 50, 1).drop("month"), f"{tmp}/a b")
    assert t.update("amount", 3, F.col("id") == 7).removed >= 1
    assert {r.id: r.amount for r in t.read().collect()}[7] == 3
    odd = rows(spark, 40, 4).withColumn("kind", F.element_at(F.array(*map(F.lit, ["a b", "x:y", "50%", "q?[1]"])), F.col("month") + 1))
    p = FileTable.create(odd, f"{tmp}/odd", ["kind"])
    assert p.update("amount", 1, F.col("kind") == "50%").kept == 3
    assert p.read().filter("amount = 1").count() == 10
