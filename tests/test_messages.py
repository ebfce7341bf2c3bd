"""Message decode, loose typing, quarantine, envelope round trip."""

import pytest
from pyspark.sql import functions as F

from txflow.sources import messages, schemas


def env(spark, values):
    rows = [(b"k", None if v is None else v.encode(), "t", 0, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, schemas.ENVELOPE)


def test_strict_schema_loses_float_amounts_loose_keeps_them(spark):
    e = env(spark, ['{"id": 1, "user": "u", "amount": 12.5, "timestamp": 1, "category": "a"}',
                    '{"id": "2", "user": "u", "amount": 12.0, "timestamp": 2, "category": "b"}',
                    '{"id": 3, "user": "u", "timestamp": 3}'])
    strict = messages.decode(e, "id INT, user STRING, amount INT, timestamp LONG, category STRING").collect()
    assert [r.amount for r in strict] == [None, None, None]      # trap 4
    loose = messages.typed(messages.decode(e)).collect()
    assert [(r.id, r.amount) for r in loose] == [(1, 12.5), (2, 12.0), (3, None)]


def test_quarantine_splits_broken_and_null_values(spark):
    e = env(spark, ['{"id": 1, "amount": 1}', '{broken', None, '{"id": 4', '', '  '])
    flagged = messages.decode_with_quarantine(e)
    good, bad = messages.split_quarantine(flagged)
    assert [r.id for r in good.collect()] == ["1"]
    assert sorted(r.offset for r in bad.collect()) == [1, 2, 3, 4, 5]
    messages.check_broken(100, 100)
    messages.check_broken(3, 100, most=0.03)
    with pytest.raises(messages.TooManyBrokenMessages):
        messages.check_broken(4, 100, most=0.03)


def test_envelope_round_trip(spark):
    df = spark.createDataFrame([(1, "u1", 2.5, 100, "food")], schemas.TYPED_MESSAGE)
    e = messages.to_envelope(df, "user", "id")
    assert e.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
    back = messages.typed(messages.decode(e)).collect()[0]
    assert (back.id, back.user, back.amount, back.timestamp, back.category) == (1, "u1", 2.5, 100, "food")


def test_enrich_fills_empty_category_only(spark):
    df = spark.createDataFrame([(1, "5,5", ""), (2, None, "x")], "id int, amount string, category string")
    out = {r.id: r for r in messages.enrich(df).collect()}
    assert out[1].amount == 5.5 and out[1].category in ("electro", "food", "auto", "beauty")
    assert out[2].amount == 0.0 and out[2].category == "x"
    assert out[1]["class"] in ("standart", "premium", "vip") and out[1].type in ("transfer", "refund", "purchase")


def test_published_files_are_topic_partitions(spark, tmp):
    """publish(partitions=n): one file per topic partition, every row in the
    file of the partition its key hashed to."""
    from txflow.sources import fixtures
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 613).cast("string").alias("user"),
                                  F.lit(1.0).alias("amount"), F.col("id").alias("timestamp"),
                                  F.lit("food").alias("category"))
    env = messages.to_envelope(df, "user", "id", partitions=8)
    fixtures.publish(env, f"{tmp}/topic", partitions=8)
    back = spark.read.parquet(f"{tmp}/topic")
    per_file = back.groupBy(F.input_file_name().alias("f")).agg(F.countDistinct("partition").alias("p"))
    assert per_file.filter("p != 1").count() == 0
    assert per_file.count() == back.select("partition").distinct().count() == 8
    assert back.count() == 5000
