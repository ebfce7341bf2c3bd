"""Streams: late rows, restart, replay-safe sinks, JDBC, silver + alerts, quarantine."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from txflow.operators import windows
from txflow.sources import messages, schemas
from txflow.streaming import streams
from tests.conftest import needs_database

T0 = dt.datetime(2024, 1, 1, 10, 0)


def msg_rows(spark, rows):
    """rows: (id, minute offset from 10:00, category, amount) -> typed messages."""
    data = [(i, "u", a, int((T0 + dt.timedelta(minutes=m)).replace(tzinfo=dt.timezone.utc).timestamp()), c)
            for i, m, c, a in rows]
    return spark.createDataFrame(data, schemas.TYPED_MESSAGE)


def write_file(spark, path, rows):
    env = messages.to_envelope(msg_rows(spark, rows), "user", "id")
    env.coalesce(1).write.mode("append").parquet(path)
    time.sleep(1.1)  # file source orders by modification time


def run_windows(spark, inp, out, chk, window="10 minutes", slide="10 minutes", **kw):
    ev = streams.decoded(streams.envelope_stream(spark, inp, max_files_per_trigger=1))
    q = streams.start_window_stats(ev, streams.multi_sink(streams.parquet_batch_sink(out)), chk,
                                   window=window, slide=slide, **kw)
    streams.await_all([q])


def windows_out(spark, out):
    return sorted((r.window_start.strftime("%H:%M"), r.category, r.tx_count)
                  for r in spark.read.parquet(out).collect())


def test_late_rows_dropped_only_when_their_window_closed(spark, tmp):
    """Spark filters late rows with the watermark of the previous micro-batch and
    evicts state with the current one, so late rows are dropped once a batch has
    run with the advanced watermark."""
    inp = f"{tmp}/in"
    write_file(spark, inp, [(1, 0, "a", 1.0), (2, 40, "a", 1.0)])           # watermark -> 10:25
    write_file(spark, inp, [(7, 41, "a", 1.0)])                             # runs with 10:25, -> 10:26
    write_file(spark, inp, [(3, 5, "a", 1.0), (4, 15, "a", 1.0), (5, 21, "a", 1.0), (6, 90, "a", 1.0)])
    run_windows(spark, inp, f"{tmp}/out", f"{tmp}/chk")
    got = windows_out(spark, f"{tmp}/out")
    # 10:05 and 10:15 are late (windows ended 10:10 / 10:20 <= 10:26); 10:21 is kept
    # (window ends 10:30); 11:30 stays open (watermark 11:15)
    assert got == [("10:00", "a", 1), ("10:20", "a", 1), ("10:40", "a", 2)]


def test_restart_from_checkpoint_emits_each_window_once(spark, tmp):
    inp, out, chk = f"{tmp}/in", f"{tmp}/out", f"{tmp}/chk"
    write_file(spark, inp, [(1, 0, "a", 1.0), (2, 30, "a", 1.0)])
    run_windows(spark, inp, out, chk, state_partitions=3, state_store="rocksdb")
    first = windows_out(spark, out)
    assert first == [("10:00", "a", 1)]
    write_file(spark, inp, [(3, 35, "a", 2.0), (4, 80, "b", 1.0)])
    run_windows(spark, inp, out, chk)
    second = windows_out(spark, out)
    run_windows(spark, inp, out, chk)
    assert windows_out(spark, out) == second                  # nothing new, nothing twice
    assert second == [("10:00", "a", 1), ("10:30", "a", 2)]  # 11:20 window still open


def test_sliding_windows_each_row_in_ten(spark, tmp):
    df = msg_rows(spark, [(1, 0, "a", 1.0)]).withColumn("event_time", F.timestamp_seconds("timestamp"))
    out = windows.sliding_window_stats(df).collect()
    assert len(out) == 10
    pre = windows.sliding_window_stats_preagg(df).collect()
    assert sorted(r.window.start for r in pre) == sorted(r.window.start for r in out)


def window_batch(spark):
    df = spark.createDataFrame([(T0, T0 + dt.timedelta(minutes=10), "a", 1.0, 1)],
                               "s timestamp, e timestamp, category string, total_sum double, tx_count bigint")
    return df.select(F.struct(F.col("s").alias("start"), F.col("e").alias("end")).alias("window"),
                     "category", "total_sum", "tx_count")


def test_multi_sink_parquet_replay_is_idempotent_and_skips_empty(spark, tmp):
    batch = window_batch(spark)
    sink = streams.multi_sink(streams.parquet_batch_sink(f"{tmp}/pq"))
    sink(batch, 0)
    sink(batch, 0)   # replay of the same batch
    sink(batch, 1)
    sink(batch.limit(0), 2)
    pq = spark.read.parquet(f"{tmp}/pq")
    assert pq.count() == 2 and sorted(r.batch_id for r in pq.collect()) == [0, 1]
    assert "window_start" in pq.columns and "window" not in pq.columns


@needs_database
def test_multi_sink_replay_is_idempotent_and_skips_empty(spark, tmp):
    batch = window_batch(spark)
    url = "jdbc:derby:memory:txflow_ms;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    sink = streams.multi_sink(streams.parquet_batch_sink(f"{tmp}/pq"), streams.jdbc_batch_sink(url, "WSTATS", props))
    sink(batch, 0)
    sink(batch, 0)   # replay of the same batch
    sink(batch, 1)
    sink(batch.limit(0), 2)
    pq = spark.read.parquet(f"{tmp}/pq")
    assert pq.count() == 2 and sorted(r.batch_id for r in pq.collect()) == [0, 1]
    assert "window_start" in pq.columns and "window" not in pq.columns
    jd = spark.read.format("jdbc").option("url", url).option("dbtable", "WSTATS").options(**props).load()
    assert jd.count() == 2



@needs_database
def test_jdbc_batch_is_all_or_nothing(spark, tmp):
    """A batch spread over several partitions, one row refused by the table: nothing
    of the batch is left behind, so the replay check (batch present -> skip) is exact."""
    url = "jdbc:derby:memory:txflow_atomic;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    ddl = ('CREATE TABLE WATOM ("category" VARCHAR(20), "total_sum" DOUBLE, "tx_count" BIGINT, '
           '"window_start" TIMESTAMP, "window_end" TIMESTAMP, "batch_id" BIGINT, CHECK ("tx_count" < 100))')
    (spark.read.format("jdbc").option("url", url).options(**props).option("sessionInitStatement", ddl)
     .option("query", "SELECT 1 AS one FROM SYSIBM.SYSDUMMY1").load().collect())
    rows = [(T0, T0 + dt.timedelta(minutes=10), f"c{i}", 1.0, 500 if i == 7 else 1) for i in range(8)]
    df = spark.createDataFrame(rows, "s timestamp, e timestamp, category string, total_sum double, tx_count bigint")
    batch = df.select(F.struct(F.col("s").alias("start"), F.col("e").alias("end")).alias("window"),
                      "category", "total_sum", "tx_count").repartition(4)
    sink = streams.multi_sink(streams.jdbc_batch_sink(url, "WATOM", props))
    with pytest.raises(Exception):
        sink(batch, 0)
    jd = spark.read.format("jdbc").option("url", url).option("dbtable", "WATOM").options(**props).load()
    assert jd.count() == 0
    sink(batch.filter("tx_count < 100"), 0)   # the replay writes the whole (fixed) batch once
    assert jd.count() == 7

def test_silver_and_alerts_two_queries(spark, tmp):
    rows = [(1, 0, "food", 20000.0), (2, 1, "auto", 5.0), (3, 2, "food", -1.0)]
    write_file(spark, f"{tmp}/in", rows)
    streams.run_silver_and_alerts(spark, f"{tmp}/in", f"{tmp}/silver", f"{tmp}/alerts", f"{tmp}/chk")
    silver = spark.read.parquet(f"{tmp}/silver")
    assert sorted(r.id for r in silver.collect()) == [1, 2]          # amount > 0
    assert {r.category for r in silver.collect()} == {"food", "auto"}  # partition column
    alerts = spark.read.parquet(f"{tmp}/alerts").collect()
    assert [(r.user, r.amount, r.category) for r in alerts] == [("u", 20000.0, "food")]


def test_quarantine_sink(spark, tmp):
    rows = [(b"k", b'{"id": 1, "amount": "2,5"}', "t", 0, 0, None), (b"k", b"{oops", "t", 0, 1, None),
            (b"k", None, "t", 0, 2, None)]
    env = spark.createDataFrame(rows, schemas.ENVELOPE)
    sink = streams.quarantine_sink(streams.parquet_batch_sink(f"{tmp}/good"), f"{tmp}/bad")
    sink(env, 7)
    assert [(r.id, r.amount) for r in spark.read.parquet(f"{tmp}/good").collect()] == [(1, 2.5)]
    assert sorted(r.offset for r in spark.read.parquet(f"{tmp}/bad").collect()) == [1, 2]
    strict = streams.quarantine_sink(streams.parquet_batch_sink(f"{tmp}/good2"), f"{tmp}/bad2", most=0.5)
    with pytest.raises(messages.TooManyBrokenMessages):
        strict(env, 8)
    assert spark.read.parquet(f"{tmp}/bad2").count() == 2   # parked all the same


def test_views_fold_to_same_answer(spark, tmp):
    msgs = msg_rows(spark, [(1, 0, "a", 1.0), (1, 3, "a", 2.0), (2, 15, " n/a", 4.0)]) \
        .withColumn("seq", F.col("id") * 10 + F.col("timestamp") % 7)
    summing = streams.summing_view_sink(f"{tmp}/s")
    latest = streams.latest_view_sink(f"{tmp}/l")
    for i, part in enumerate([msgs.filter("id = 1"), msgs.filter("id = 2")]):
        summing(part, i)
        latest(part.withColumn("event_time", F.timestamp_seconds("timestamp")), i)
    before_s = sorted(map(tuple, streams.read_summing_view(spark, f"{tmp}/s").collect()))
    before_l = sorted(map(tuple, streams.read_latest_view(spark, f"{tmp}/l").collect()))
    def views():
        return (sorted(map(tuple, streams.read_summing_view(spark, f"{tmp}/s").collect())),
                sorted(map(tuple, streams.read_latest_view(spark, f"{tmp}/l").collect())))

    for _ in range(2):   # folding again changes nothing
        assert streams.fold_view(spark, f"{tmp}/s", "summing") == 1 == streams.fold_view(spark, f"{tmp}/l", "latest")
        assert views() == (before_s, before_l)
    summing(part, 1)   # the last folded batch is replayed
    latest(part.withColumn("event_time", F.timestamp_seconds("timestamp")), 1)
    assert views() == (before_s, before_l)
    assert {r.category for r in streams.read_summing_view(spark, f"{tmp}/s").collect()} == {"A", "UNKNOWN"}
    summing(part, 2)   # a new batch adds to the baseline
    n = sum(r.tx_count for r in streams.read_summing_view(spark, f"{tmp}/s").collect())
    assert n == 3 + part.count()
    streams.fold_view(spark, f"{tmp}/s", "summing")
    assert sum(r.tx_count for r in streams.read_summing_view(spark, f"{tmp}/s").collect()) == n


def test_state_width_follows_cores_not_a_huge_batch_width(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "96000")
    try:
        assert streams.default_state_width(spark) == 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert streams.default_state_width(spark) == min(int(before), 2 * spark.sparkContext.defaultParallelism)


def test_window_stream_combines_a_hot_category_before_the_state_shuffle(spark, tmp):
    """A third of the rows in one category: the streaming aggregate runs a partial sum
    in every map task before the exchange that feeds the state store, so the hot
    category reaches the state as one row per task and window."""
    rows = [(i, i % 30, "HOT" if i % 3 == 0 else f"c{i % 7}", 1.0) for i in range(300)]
    write_file(spark, f"{tmp}/in", rows)
    ev = streams.decoded(streams.envelope_stream(spark, f"{tmp}/in"))
    q = streams.start_window_stats(ev, streams.multi_sink(streams.parquet_batch_sink(f"{tmp}/out")),
                                   f"{tmp}/chk")
    streams.await_all([q])
    plan = q._jsq.explainInternal(False)
    lines = plan.splitlines()
    exchange = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l)
    restore = next(i for i, l in enumerate(lines) if "StateStoreRestore" in l)
    partial = next(i for i, l in enumerate(lines) if "partial_sum" in l)
    assert restore < exchange < partial     # state (top) <- exchange <- partial aggregate (below)
    got = spark.read.parquet(f"{tmp}/out")
    assert got.filter("category = 'HOT'").agg(F.sum("tx_count")).first()[0] > 0


def test_state_width_under_dynamic_allocation():
    """Dynamic allocation: the bound is maxExecutors x cores, not the (possibly tiny)
    parallelism at start; unbounded -> the session width."""

    class Conf(dict):
        def get(self, k, default=None):
            return dict.get(self, k, default)

    class Ctx:
        def __init__(self, conf):
            self._conf, self.defaultParallelism = Conf(conf), 2

        def getConf(self):
            return self._conf

    class Spark:
        def __init__(self, conf):
            self.sparkContext = Ctx(conf)
            self.conf = Conf({"spark.sql.shuffle.partitions": "96000"})

    dyn = {"spark.dynamicAllocation.enabled": "true", "spark.dynamicAllocation.maxExecutors": "1000",
           "spark.executor.cores": "8"}
    assert streams.default_state_width(Spark(dyn)) == 16_000
    unbounded = {"spark.dynamicAllocation.enabled": "true"}
    assert streams.default_state_width(Spark(unbounded)) == 96_000
    assert streams.default_state_width(Spark({})) == 4          # static: 2 x defaultParallelism


def test_a_fold_that_was_cut_off_is_passed_over_and_written_anew(spark, tmp):
    """Half a baseline (no _SUCCESS) at N: the view reads as before, a retry replaces it; the same above an older whole one."""
    import os
    sink = streams.summing_view_sink(f"{tmp}/v")
    rows = [(1, 0, "a", 1.0), (2, 3, "a", 2.0), (3, 15, "b", 4.0)]
    for i, r in enumerate(rows):
        sink(msg_rows(spark, [r]), i)

    def view():
        return sorted(map(tuple, streams.read_summing_view(spark, f"{tmp}/v").collect()))

    def cut_off(n, part):
        at = os.path.join(streams_path(tmp), f"v/_baseline/through={n}")
        os.makedirs(f"{at}/_temporary", exist_ok=True)
        if part:
            spark.read.parquet(f"{tmp}/v").drop("batch_id").limit(1).write.mode("append").parquet(at)
            os.rename(f"{at}/_SUCCESS", f"{at}/_lost")

    want = view()
    cut_off(0, False)
    assert view() == want
    cut_off(2, True)
    assert view() == want
    assert streams.fold_view(spark, f"{tmp}/v", "summing") == 2 and view() == want
    sink(msg_rows(spark, [(4, 16, "b", 8.0)]), 3)
    after = view()
    assert after != want
    cut_off(3, True)
    assert view() == after
    assert streams.fold_view(spark, f"{tmp}/v", "summing") == 3 and view() == after
    sink(msg_rows(spark, [(4, 16, "b", 8.0)]), 3)      # the folded batch replayed
    assert view() == after


def streams_path(tmp):
    from txflow.session import local_path
    return local_path(tmp)


def test_late_rows_go_to_their_own_sink_and_replays_repeat_it(spark, tmp):
    sink = streams.late_split_sink(streams.parquet_batch_sink(f"{tmp}/on"), streams.parquet_batch_sink(f"{tmp}/late"), f"{tmp}/clock")

    def batch(*minutes):
        rows = [(m, None if m is None else T0 + dt.timedelta(minutes=m)) for m in minutes]
        return spark.createDataFrame(rows, "id int, event_time timestamp")

    sink(batch(0, 40, None), 0)          # nothing is late before a time is known
    sink(batch(14, 15, 20, 29, 60), 1)   # watermark 25: windows that end by 20 are closed
    sink(batch(14, 41, 39), 2)           # watermark 45: by 40
    sink(batch(14, 15, 20, 29, 60), 1)   # replayed: the watermark it had
    on = sorted((r.batch_id, r.id or -1) for r in spark.read.parquet(f"{tmp}/on").collect())
    late = sorted((r.batch_id, r.id, r.watermark) for r in spark.read.parquet(f"{tmp}/late").collect())
    assert on == [(0, -1), (0, -1), (0, 40), (1, 20), (1, 29), (1, 60), (2, 41)]
    w1, w2 = T0 + dt.timedelta(minutes=25), T0 + dt.timedelta(minutes=45)
    assert late == [(1, 14, w1), (1, 15, w1), (2, 14, w2), (2, 39, w2)]


def test_quarantine_observes_what_it_parks(spark, tmp):
    """Counts come from the pass that parks; the batch is decoded once and its metrics equal the written rows."""
    rows = [(b"k", b'{"id": 1, "amount": "2,5"}', "t", 0, 0, None), (b"k", b"{oops", "t", 0, 1, None), (b"k", None, "t", 0, 2, None)]
    env = spark.createDataFrame(rows, schemas.ENVELOPE)
    sink = streams.quarantine_sink(streams.parquet_batch_sink(f"{tmp}/good"), f"{tmp}/bad", metrics_path=f"{tmp}/m")
    sink(env, 7)
    sink(env.filter("offset = 0"), 8)
    sink(env, 7)    # replayed
    found = {r.batch_id: (r.rows, r.broken) for r in spark.read.parquet(f"{tmp}/m").collect()}
    assert found == {7: (3, 2), 8: (1, 0)}
    assert spark.read.parquet(f"{tmp}/bad").count() == 2 and spark.read.parquet(f"{tmp}/good").count() == 2


def test_observed_metrics_add_up_over_batches(spark, tmp):
    for i in range(3):
        write_file(spark, f"{tmp}/in", [(i, i, "food", 5.0 * i)])
    seen = streams.decoded(streams.envelope_stream(spark, f"{tmp}/in", 1)).observe(
        "m", F.count(F.lit(1)).alias("rows"), F.count_if(F.col("amount") > 4).alias("large"))
    got = streams.drain_observed(spark, lambda: streams.start_view(seen, streams.parquet_batch_sink(f"{tmp}/out"), f"{tmp}/chk"))
    assert (got.total("m", "rows"), got.total("m", "large")) == (3, 2) and len(got.batches["m"]) >= 3
    assert got.total("other", "rows") == 0


def test_batches_are_capped_by_bytes(spark, tmp):
    for i in range(3):
        write_file(spark, f"{tmp}/in", [(i, i, "food", 1.0)])
    stream = streams.decoded(streams.envelope_stream(spark, f"{tmp}/in", max_bytes_per_trigger=1))
    streams.await_all([streams.start_view(stream, streams.parquet_batch_sink(f"{tmp}/out"), f"{tmp}/chk")])
    assert spark.read.parquet(f"{tmp}/out").select("batch_id").distinct().count() == 3


def test_held_windows_are_those_the_watermark_has_not_passed(spark, tmp):
    write_file(spark, f"{tmp}/in", [(1, 0, "a", 1.0), (2, 40, "a", 2.0)])
    ev = streams.decoded(streams.envelope_stream(spark, f"{tmp}/in"))
    streams.await_all([streams.start_window_stats(ev, streams.multi_sink(streams.parquet_batch_sink(f"{tmp}/w")), f"{tmp}/chk")])
    emitted, held = spark.read.parquet(f"{tmp}/w"), streams.held_windows(spark, f"{tmp}/chk")
    assert emitted.count() == 10 and held.count() == 10
    assert {(r.category, r.total_sum, r.tx_count) for r in held.collect()} == {("a", 2.0, 1)}
    assert emitted.agg(F.max("window_end")).first()[0] < held.agg(F.min("window_start")).first()[0]
