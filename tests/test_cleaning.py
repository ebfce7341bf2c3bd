"""Cleaning traps on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from txflow.functions import columns as C
from txflow.operators import cleaning
from txflow.sources import schemas

RAW = [
    (1, 10, "12,5", " retail ", "2024-01-01 10:30:00", "la"),
    (2, 11, "bad", "N/A", "not a time", " sf"),
    (3, 12, None, "tech\t", None, "NULL"),
    (4, 13, "7.25", None, "2024-01-02 11:00:00", "nyc"),
    (5, 14, "3", "null", "2024-01-03 12:00:00", "unknown\t"),
    (6, 15, "4", "", "2024-01-03 12:00:00", "Boston"),
    (7, 16, "5", "unknown", "2024-01-03 12:00:00", "new york"),
]


def raw(spark, rows=RAW):
    return spark.createDataFrame(rows, schemas.RAW_TRANSACTIONS)


def test_literal_whitelist_keeps_only_filled_categories(spark):
    out = {r.id: r for r in cleaning.clean_literal(raw(spark)).collect()}
    # upper-cased categories never meet the mixed-case whitelist; only fills pass
    assert sorted(out) == [4, 5, 6]
    assert {r.category for r in out.values()} == {"Unknown"}


def test_literal_timestamp_fill_has_no_effect_and_null_city_survives(spark):
    rows = [(3, 12, "1", None, None, "NULL"), (8, 1, "1", None, "x", "la")]
    out = {r.id: r for r in cleaning.clean_literal(raw(spark, rows)).collect()}
    assert out[3].timestamp is None           # string fill ignored on a timestamp
    assert out[3].city == "Null"             # initcap runs before the sentinel list
    assert out[8].city == "Los Angeles"


def test_intended_cleaning(spark):
    out = {r.id: r for r in cleaning.clean_intended(raw(spark)).collect()}
    assert out[1].amount == 12.5 and out[1].category == "RETAIL" and out[1].city == "Los Angeles"
    assert out[2].amount == 0.0 and out[2].category == "UNKNOWN" and out[2].city == "San Francisco"
    assert out[2].timestamp == dt.datetime(1970, 1, 1)
    assert out[3].category == "TECH" and out[3].city == "Unknown"
    assert out[4].category == "UNKNOWN" and out[4].city == "New York"
    assert out[5].category == "UNKNOWN" and out[5].city == "Unknown"
    assert out[6].category == "UNKNOWN" and out[6].city == "Boston"
    assert out[7].city == "New York"


def test_ansi_stays_on_and_casts_do_not_fail(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("1,5",), ("x",), (None,), (" 2 ",)], "s string")
    got = [r.v for r in df.select(C.parse_decimal_comma("s").alias("v")).collect()]
    assert got == [1.5, None, None, 2.0]
    got = [r.v for r in df.select(C.parse_amount_or_zero("s").alias("v")).collect()]
    assert got == [1.5, 0.0, 0.0, 2.0]


def test_dedupe_conflicting_duplicates_and_null_ids(spark):
    rows = [(1, 2, "b"), (1, 1, "z"), (None, 5, "x"), (None, 4, "y"), (2, 1, "a")]
    df = spark.createDataFrame(rows, "id int, user_id int, city string")
    out = cleaning.dedupe_by_id(df)
    got = sorted(out.collect(), key=lambda r: (r.id is not None, r.id))
    assert [tuple(r) for r in got] == [(None, 4, "y"), (1, 1, "z"), (2, 1, "a")]
    # fixed survivor: the same answer on every run and partitioning
    again = cleaning.dedupe_by_id(df.repartition(3))
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, got), key=repr)


def test_dedupe_is_a_partial_aggregate(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("id"), F.col("id").alias("v"))
    plan = cleaning.dedupe_by_id(df)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan or "partial" in plan


def test_category_multiif(spark):
    df = spark.createDataFrame([(" n/a ",), ("null",), ("",), (None,), ("fo od",)], "c string")
    got = [r.v for r in df.select(C.category_multiif("c").alias("v")).collect()]
    assert got == ["UNKNOWN", "UNKNOWN", "UNKNOWN", "UNKNOWN", "FOOD"]


def test_pick_is_reproducible_and_spread(spark):
    df = spark.range(3000).select(C.pick("id", ["a", "b", "c"], salt=1).alias("p"))
    counts = {r.p: r["count"] for r in df.groupBy("p").count().collect()}
    assert set(counts) == {"a", "b", "c"} and min(counts.values()) == 1000


def test_summing_rounds_half_even_and_reports_half_up(spark):
    """The summing view rounds a float amount to cents with ties to even (that
    engine's float rounding); the batch reports round half up, as Spark does."""
    from txflow.operators import collapse
    df = spark.createDataFrame([(0.125, 1), (0.375, 1), (2.5, 1)], "amount DOUBLE, timestamp BIGINT")
    df = df.withColumn("category", F.lit("x"))
    got = [r.total_sum for r in collapse.summing_rows(df).collect()]
    assert [float(x) for x in got] == [0.12, 0.38, 2.5]
    assert [r.m for r in df.select(C.money("amount").alias("m")).collect()] == [0.13, 0.38, 2.5]


def test_shared_root_refuses_local_temp_on_a_cluster():
    from txflow import session

    class Ctx:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, k, default=None):
            return default

    class FakeSpark:
        sparkContext = Ctx()
        conf = Conf()

    import pytest
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(FakeSpark())


def test_ids_past_int_stay_apart(spark):
    for clean, category in ((cleaning.clean_intended, "Food"), (cleaning.clean_literal, None)):
        rows = [(str(i), str(i), "1,5", category, None, None) for i in (3_000_000_000, 3_000_000_001, 2**31, 2**62)]
        raw = spark.createDataFrame(rows, "id string, user_id string, amount string, category string, timestamp string, city string")
        assert sorted(r.id for r in clean(raw).collect()) == [2**31, 3_000_000_000, 3_000_000_001, 2**62]
