"""One key holds a third of all rows: no operator may funnel it into one task."""

import pytest
from pyspark.sql import functions as F

from txflow.operators import cleaning, collapse, joins, reports

N = 90_000


@pytest.fixture()
def skewed(spark):
    # a third of the rows share user_id 7 (and category 'HOT', and a NULL id)
    hot = F.col("id") % 3 == 0
    return spark.range(N).select(
        F.when(hot, F.lit(None)).otherwise(F.col("id")).cast("int").alias("id"),
        F.when(hot, F.lit(7)).otherwise(F.col("id") % 10_000).cast("int").alias("user_id"),
        (F.col("id") % 977).cast("double").alias("amount"),
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 50).cast("string"))).alias("category"),
        F.col("id").alias("seq"),
    )


def final_plan(df):
    """The adaptive plan after the DataFrame's own execution (isFinalPlan=true)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_splits_hot_key_when_not_broadcast(spark, skewed):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        dim = spark.range(10_000).select(F.col("id").cast("int").alias("user_id"),
                                         F.lit("F").alias("gender"))
        joined = joins.join_dimension(skewed, dim, "user_id")
        plan = final_plan(joined)
        assert "SortMergeJoin" in plan and "skew=true" in plan
        assert joined.count() == N
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_aggregates_combine_before_shuffle(spark, skewed):
    rep = reports.category_report(skewed)
    plan = final_plan(rep)
    assert "partial_sum" in plan
    hot = rep.filter("category = 'HOT'").first()
    assert hot.tx_count == 0  # all HOT rows have a NULL id: count(id) skips them


def test_dedupe_and_latest_combine_before_shuffle(spark, skewed):
    d = cleaning.dedupe_by_id(skewed.drop("seq"))
    assert "partial_min" in final_plan(d)
    assert d.count() == N - N // 3 + 1          # all NULL ids collapse to one row
    latest = collapse.latest_version(skewed, ["user_id"], "amount", "seq")
    assert "partial_max_by" in final_plan(latest)
    assert latest.count() == 10_000


def test_top_k_limits_hot_group_before_shuffle(spark, skewed):
    top = reports.top_k_per_group(skewed.fillna(-1, ["id"]), "category", "amount", 3)
    assert "WindowGroupLimit" in final_plan(top)
    assert top.filter("category = 'HOT'").count() == 3


def test_merge_shuffle_path_combines_hot_target_key(spark, skewed):
    """A third of the target shares id 0: the insert branch's anti join sees that key
    pre-combined (partial aggregate before its shuffle), and every target row with
    the key is updated."""
    from txflow.operators import changes
    target = skewed.select(F.coalesce("id", F.lit(0)).alias("id"), "amount")
    source = spark.range(0, 200_000, 1000).select(F.col("id").cast("int").alias("id"),
                                                  F.lit(-1.0).alias("amount"))
    out = changes.merge_upsert(target, source, "id", ["amount"])
    plan = final_plan(out)
    # the distinct of the target keys: a partial HashAggregate feeds the anti join
    assert "LeftAnti" in plan and plan.count("HashAggregate") >= 2
    assert out.filter("id = 0 AND amount = -1.0").count() == N // 3
    target_ids = {0} | {i for i in range(N) if i % 3}
    inserts = [i for i in range(0, 200_000, 1000) if i not in target_ids]
    assert out.count() == N + len(inserts)
    assert out.filter("amount = -1.0").count() == N // 3 + (200 - len(inserts) - 1) + len(inserts)
