"""Joins broadcast by size, reports, plan shapes."""

from pyspark.sql import functions as F

from txflow.operators import joins, reports
from txflow.sources import fixtures
from txflow.sources.tables import table
from tests.conftest import SF001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


USERS = [(i, f"user{i}", "F" if i % 2 == 0 else "M", 18 + i) for i in range(1, 5)]


def silver_rows(spark):
    rows = [(1, 1, 10.0, "FOOD"), (2, 2, 20.0, "FOOD"), (3, 3, 5.0, "TECH"), (4, 9, 7.0, "TECH"),
            (5, None, 1.0, "TECH")]
    return spark.createDataFrame(rows, "id int, user_id int, amount double, category string")


def test_small_dimension_is_broadcast(spark, tmp):
    spark.createDataFrame(USERS, "user_id INT, name STRING, gender STRING, age INT").write.parquet(f"{tmp}/users")
    users = spark.read.parquet(f"{tmp}/users")   # its size in bytes is known
    rep = reports.gender_category_report(silver_rows(spark), users)
    assert "BroadcastHashJoin" in plan(rep)
    got = {(r.gender, r.category): (r.total_amount, r.tx_count) for r in rep.collect()}
    # user 9 and the NULL user never match
    assert got == {("M", "FOOD"): (10.0, 1), ("F", "FOOD"): (20.0, 1), ("M", "TECH"): (5.0, 1)}


def test_dimension_over_the_limit_is_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        users = spark.createDataFrame(USERS, "user_id INT, name STRING, gender STRING, age INT")
        joined = joins.join_dimension(silver_rows(spark), users, "user_id")
        p = plan(joined)
        assert "BroadcastHashJoin" not in p or "SortMergeJoin" in p
        assert joined.count() == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_segment_join_on_text_key(spark):
    seg = spark.createDataFrame([(str(i), f"segment{i}") for i in (1, 5, 6)], "user STRING, segment STRING")
    rows = [(1, 1, 10.0, "F", __import__("datetime").datetime(2024, 1, 1, 5, 0))]
    df = spark.createDataFrame(rows, "id int, user_id int, amount double, category string, timestamp timestamp_ntz")
    rep = reports.hourly_report(df, seg).collect()
    assert [(r.hour_time, r.tx_count, r.total_sum) for r in rep] == [(5, 1, 10.0)]


def test_top_k_uses_group_limit_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 4).alias("category"), F.col("id").alias("id"),
                                  (F.col("id") * 7 % 101).cast("double").alias("amount"))
    top = reports.top_k_per_group(df, "category", "amount", 3)
    assert "WindowGroupLimit" in plan(top)
    assert top.count() == 12


def test_latest_n_is_take_ordered(spark):
    df = spark.range(50).withColumn("t", F.col("id"))
    assert "TakeOrderedAndProject" in plan(reports.latest_n(df, "t", 5))


def test_scan_pushes_filter_and_prunes(spark):
    from __spark_entry__ import queries
    df = queries()["parquet_scan"](spark, SF001)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,50.0)]" in text
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in text


def test_derived_dimensions(spark):
    cust = table(spark, SF001, "customer")
    users = fixtures.users_dimension(cust)
    assert users.count() == cust.count()
    seg = fixtures.segments_dimension(cust)
    assert {r.segment for r in seg.select("segment").distinct().collect()} <= {"VIP", "Standart", "Premium"}


def test_declared_driver_schemas_match_the_files(spark):
    """table() reads with a declared schema (no inference pass); it must be the
    schema the files carry."""
    from txflow.sources import schemas
    from txflow.sources.tables import table
    from tests.conftest import SF01
    for name in schemas.DRIVER_TABLES:
        inferred = spark.read.parquet(f"{SF01}/{name}.parquet").schema
        assert table(spark, SF01, name).schema == inferred, name
