import math
import random

import pytest
from pyspark.sql import functions as F

from txflow.llm import topk
from txflow.llm.topk import top_k

INF, NAN = float("inf"), float("nan")
ROWS = [(50, [0.5, -0.25, 1.0]), (100, [0.5, -0.25, 1.0]), (1, [0.5, 0.5, 0.5]), (2, [0.5, 0.5, 0.5]), (3, [-1.0, 0.0, 0.001]),
        (4, None), (150, None), (5, [1.0, None, 0.0]), (200, [NAN, 0.0, 0.0]), (6, [INF, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]),
        (7, []), (8, [2.0]), (9, [-0.001, -0.001, -0.001]), (2, [0.5, 0.5, 0.5]), (50, [0.5, -0.25, 1.0]), (0, [9e6, -9e6, 9e6])]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                 "vec_id long, embedding array<double>, score int, rank string")


def brute(rows, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in sorted({q: a for q, a in sorted(ok, reverse=True) if q % 50 == 0}.items()):
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("lists, blocks", [(1, 2048), (2, 4), (3, 2)])
def test_brute_force_over_odd_vectors(spark, monkeypatch, lists, blocks):
    monkeypatch.setattr(topk, "VECTORS_IN_BLOCK", blocks)
    monkeypatch.setattr(topk, "QUERIES_IN_BLOCK", 2)
    df = frame(spark, ROWS)
    got = top_k(df, df.filter("vec_id % 50 = 0"), lists=lists).collect()
    assert sorted(tuple(r) for r in got) == brute(ROWS)


def test_few_and_no_rows(spark):
    df = frame(spark, ROWS[:3])
    assert sorted(tuple(r) for r in top_k(df, df.filter("vec_id % 50 = 0")).collect()) == brute(ROWS[:3])
    for rows in ([], [(50, [1.0])], [(50, None)]):
        df = frame(spark, rows)
        assert top_k(df, df.filter("vec_id % 50 = 0")).count() == 0


def test_a_cluster_of_equal_scores(spark):
    rows = [(i, [0.25, 0.75]) for i in range(400)]
    df = frame(spark, rows).withColumn("embedding", F.col("embedding"))
    assert sorted(tuple(r) for r in top_k(df, df.filter("vec_id % 50 = 0")).collect()) == brute(rows)


def test_large_components_are_exact(spark):
    """Scores from 2^53 on, sums that pass 64 bits only half way, and an error where a score does not fit."""
    rows = [(50, [1.0, 0.0]), (1, [300000.0, 0.0]), (2, [400000.0, 0.0]), (3, [399999.99, 5.0])]
    df = frame(spark, rows)
    got = sorted(tuple(r) for r in top_k(df, df.filter("vec_id % 50 = 0")).collect())
    assert got == brute(rows) and got[0] == (50, 1, 2, 26214400000)
    big = float(1 << 22)
    rows = [(50, [big, big, big, 1.0]), (1, [big, -big, big, 2.0]), (2, [big, -big, big, 1.5]), (3, [3 * big, -3 * big, 1.0, 0.0]), (4, [7.0] * 4)]
    df = frame(spark, rows)
    assert sorted(tuple(r) for r in top_k(df, df.filter("vec_id % 50 = 0")).collect()) == brute(rows)
    huge = float(1 << 29)
    rows = [(50, [huge, huge, 0.0]), (1, [huge, -huge, 1.0]), (2, [0.0, 0.0, huge]), (3, [1.0, 1.0, 1.0])]
    df = frame(spark, rows)
    assert sorted(tuple(r) for r in top_k(df, df.filter("vec_id % 50 = 0"), lists=1).collect()) == brute(rows)
    for rows in ([(50, [huge]), (1, [huge])], [(50, [1e300]), (1, [1.0])]):
        df = frame(spark, rows)
        with pytest.raises(Exception):
            top_k(df, df.filter("vec_id % 50 = 0")).collect()


def test_few_pairs_are_resolved(spark, monkeypatch):
    """Clusters of near vectors: all but a small share of the pairs stay unresolved, and blocks that can't reach a cutoff
    send nothing."""
    rnd = random.Random(5)
    centres = [[rnd.gauss(0, 1) for _ in range(32)] for _ in range(50)]
    rows = [(i, [c + rnd.gauss(0, 0.05) for c in centres[i % 50]]) for i in range(1500)]
    rows += [(2000 + i, [rnd.gauss(0, 0.01) for _ in range(32)]) for i in range(500)]
    df = frame(spark, rows)
    queries = df.filter("vec_id % 50 = 0 and vec_id < 1500")
    monkeypatch.setattr(topk, "VECTORS_IN_BLOCK", 300)
    monkeypatch.setattr(topk, "QUERIES_IN_BLOCK", 7)
    got = sorted(tuple(r) for r in top_k(df, queries).collect())
    asked = {i for i, _ in rows if i % 50 == 0 and i < 1500}
    assert got == [r for r in brute(rows) if r[0] in asked]
    ready = topk._prepared(df, queries, "vec_id", "embedding", 2)
    v, q, n, m, dims = ready
    sent = topk.survivors(v, q, n, m, topk.cutoffs(v, q, n, m, dims, 5)).select(F.array_distinct(F.flatten("sent")).alias("p"))
    resolved = sent.agg(F.sum(F.size("p"))).first()[0]
    assert 5 * len(asked) <= resolved < 0.05 * len(asked) * len(rows)


def test_copies_of_queries_are_not_broadcast(spark, monkeypatch):
    """A copy of the queries for each few blocks of vectors, that no join collects at the driver, however small Spark
    takes the lists to be."""
    monkeypatch.setattr(topk, "VECTORS_IN_BLOCK", 40)
    monkeypatch.setattr(topk, "QUERIES_IN_BLOCK", 3)
    monkeypatch.setattr(topk, "shuffle_width", lambda spark: 1)
    rnd = random.Random(8)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(1000)]
    df = frame(spark, rows)
    queries = df.filter("vec_id % 50 = 0")
    v, q, n, m, dims = topk._prepared(df, queries, "vec_id", "embedding", 2)
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) > 1 << 20 and n == 25
    met = topk._met(q, v, n)
    met.count()
    assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()
    assert met.count() < n * m + q.filter("list >= 0").count() * n / 4
    assert sorted(tuple(r) for r in top_k(df, queries).collect()) == brute(rows)
