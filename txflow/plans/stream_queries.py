"""Message and stream queries (SRC5-7, SNK2-4, SNK7, STR1, STR3-7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from txflow.functions import columns as C
from txflow.functions import values as V
from txflow.plans.registry import register
from txflow.session import work_dir
from txflow.sources import fixtures, messages
from txflow.sources.tables import table
from txflow.streaming import streams


# --- messages and streams (SRC5-7, SNK2-4, SNK7, STR1, STR3-7) ---------------------



def topic_partitions(spark) -> int:
    """The stand-in topic has one partition per core of the consumer (counted as
    for the state width; with no executor limit, the cores present now)."""
    return streams.cluster_cores(spark) or spark.sparkContext.defaultParallelism


def _publish(spark, env_of, path):
    """Publish messages to the stand-in topic: envelope + one file per partition."""
    n = topic_partitions(spark)
    return fixtures.publish(env_of(n), path, partitions=n)


def _event_envelope(spark, sf_dir, partitions: int = 3):
    msgs = fixtures.messages_from_events(table(spark, sf_dir, "events"))
    return messages.to_envelope(msgs, key="user", offset="id", event_time=None, partitions=partitions)


@register("json_encode")
def json_encode(spark, sf_dir):
    """SNK7 + SRC6 round trip: rows -> keyed JSON envelope -> decoded typed rows."""
    env = _event_envelope(spark, sf_dir)
    dec = messages.typed(messages.decode(env, keep=["key", "offset"]))
    return dec.select(F.col("key").cast("string").alias("key"), "offset", "id", "user", "amount",
                      "timestamp", "category")


@register("json_quarantine")
def json_quarantine(spark, sf_dir):
    """SRC7: 'error' events arrive with a damaged payload; they are quarantined with
    their offset and key, every other message decodes."""
    msgs = fixtures.messages_from_events(table(spark, sf_dir, "events"))
    env = messages.to_envelope(msgs, "user", "id", carry=["category"])
    env = fixtures.truncate_payloads(env, F.col("category") == "error").drop("category")
    flagged = messages.decode_with_quarantine(env, keep=["key", "offset"])
    _, bad = messages.split_quarantine(flagged)
    return bad.select("offset", F.col("key").cast("string").alias("key"))


@register("stream_quarantine")
def stream_quarantine(spark, sf_dir):
    """SRC7 as a stream: damaged and empty payloads are parked, the good rows are kept; both are returned."""
    root = work_dir(spark, "quarantine")
    msgs = fixtures.messages_from_events(table(spark, sf_dir, "events"))
    env = messages.to_envelope(msgs, "user", "id", carry=["category"])
    env = fixtures.truncate_payloads(env, F.col("category") == "error")
    env = env.withColumn("value", F.when(F.col("offset") % 10 == 0, F.lit(" ").cast("binary")).otherwise(F.col("value")))
    fixtures.publish(env.drop("category"), f"{root}/input")
    sink = streams.quarantine_sink(streams.parquet_batch_sink(f"{root}/good"), f"{root}/bad")
    streams.await_all([streams.start_view(streams.envelope_stream(spark, f"{root}/input"), sink, f"{root}/chk")])
    good = spark.read.parquet(f"{root}/good").select(F.col("id").alias("offset"), "amount", F.lit(False).alias("bad"))
    bad = spark.read.parquet(f"{root}/bad").select("offset", F.lit(None).cast("double").alias("amount"), F.lit(True).alias("bad"))
    return good.unionByName(bad)


def _silver_and_alerts(spark, sf_dir):
    root = work_dir(spark, "silver_alerts")
    msgs = fixtures.messages_from_orders(table(spark, sf_dir, "orders"))
    _publish(spark, lambda n: messages.to_envelope(msgs, "user", "id", partitions=n), f"{root}/input")
    streams.run_silver_and_alerts(spark, f"{root}/input", f"{root}/silver", f"{root}/alerts", f"{root}/chk",
                                  V.ALERT_THRESHOLD)
    return root


@register("stream_to_silver")
def stream_to_silver(spark, sf_dir):
    """SNK2 + SNK4: stream of order messages, some with a negative amount or none, in several batches ->
    amount > 0 -> two sinks of one decoded batch: silver by category, and alerts. Both are returned."""
    root = work_dir(spark, "silver_with_alerts")
    msgs = fixtures.messages_from_orders(table(spark, sf_dir, "orders"))
    k = F.col("id")
    msgs = msgs.withColumn("amount", F.when(k % 9 == 0, -F.col("amount")).when(k % 10 != 0, F.col("amount")))
    _publish(spark, lambda n: messages.to_envelope(msgs, "user", "id", partitions=n), f"{root}/input")
    streams.run_silver_with_alerts(spark, f"{root}/input", f"{root}/silver", f"{root}/alerts", f"{root}/chk",
                                   V.ALERT_THRESHOLD, max(1, topic_partitions(spark) // 2))
    silver = spark.read.parquet(f"{root}/silver").select(
        F.lit("silver").alias("sink"), "id", "user", "amount", "timestamp", F.col("category").cast("string").alias("category"))
    alerts = spark.read.parquet(f"{root}/alerts").select(
        F.lit("alerts").alias("sink"), F.lit(None).cast("bigint").alias("id"), "user", "amount",
        F.lit(None).cast("bigint").alias("timestamp"), "category")
    return silver.unionByName(alerts)


@register("stream_alerts")
def stream_alerts(spark, sf_dir):
    """The alert query beside the silver one: amount > 10,000."""
    root = _silver_and_alerts(spark, sf_dir)
    return spark.read.parquet(f"{root}/alerts")


@register("sliding_window_stream")
def sliding_window_stream(spark, sf_dir):
    """STR1 as a stream drained by available-now: windows are emitted once the
    watermark (max event time - 15 min) passes their end; delivered through the
    multi-sink batch function."""
    root = work_dir(spark, "sliding")
    _publish(spark, lambda n: _event_envelope(spark, sf_dir, n), f"{root}/input")
    ev = streams.decoded(streams.envelope_stream(spark, f"{root}/input"))
    q = streams.start_window_stats(ev, streams.multi_sink(streams.parquet_batch_sink(f"{root}/windows")),
                                   f"{root}/chk")
    streams.await_all([q])
    out = spark.read.parquet(f"{root}/windows").drop("batch_id")
    return out.select("window_start", "window_end", "category", C.money("total_sum").alias("total_sum"),
                      "tx_count")


def _windows_over_publishes(spark, sf_dir, name, newer_first: bool):
    """Publish the events in two parts split at the middle of their time range, and
    run the window stream to completion after each, restarting from one checkpoint."""
    root = work_dir(spark, name)
    msgs = fixtures.messages_from_events(table(spark, sf_dir, "events"))
    # the middle of the event-time range (whole epoch seconds): one scalar
    cut = msgs.agg(((F.min("timestamp") + F.max("timestamp")) / 2).cast("bigint")).first()[0]
    older, newer = F.col("timestamp") < cut, F.col("timestamp") >= cut
    sink = streams.multi_sink(streams.parquet_batch_sink(f"{root}/windows"))
    for part in ((newer, older) if newer_first else (older, newer)):
        _publish(spark, lambda n: messages.to_envelope(msgs.filter(part), "user", "id", partitions=n),
                 f"{root}/input")
        ev = streams.decoded(streams.envelope_stream(spark, f"{root}/input"))
        streams.await_all([streams.start_window_stats(ev, sink, f"{root}/chk")])
    out = spark.read.parquet(f"{root}/windows").drop("batch_id")
    return out.select("window_start", "window_end", "category", C.money("total_sum").alias("total_sum"),
                      "tx_count")


@register("stream_restart")
def stream_restart(spark, sf_dir):
    """STR5: older events published first, newer ones after. The window stream runs
    to completion after each part, the second time restarting from the first run's
    checkpoint: consumed files are not read again, open windows keep their state,
    nothing is emitted twice. Both runs together give the same windows as one run
    over everything."""
    return _windows_over_publishes(spark, sf_dir, "restart", newer_first=False)


@register("stream_late_rows")
def stream_late_rows(spark, sf_dir):
    """STR3: newer events published and drained first, the older half after them,
    late. A late row adds to a window only while that window is still open (its end
    after the watermark of the earlier batches); for the rest it is dropped."""
    return _windows_over_publishes(spark, sf_dir, "late_rows", newer_first=True)


@register("incremental_summing")
def incremental_summing(spark, sf_dir):
    """STR7: the summing view kept up per micro-batch, read back with the collapse. The topic comes
    in two parts and at a capped rate, so there are several batches; between the parts the view is
    folded to a baseline, and the last folded batch arrives a second time."""
    root = work_dir(spark, "summing_view")
    msgs = fixtures.untidy_messages(table(spark, sf_dir, "events"))
    now = F.lit(fixtures.FIXED_NOW).cast("timestamp")
    sink = streams.summing_view_sink(f"{root}/view", now)
    for part in (F.col("id") % 2 == 0, F.col("id") % 2 == 1):
        _publish(spark, lambda n: messages.to_envelope(msgs.filter(part), "user", "id", partitions=n), f"{root}/input")
        files_per_batch = max(1, topic_partitions(spark) // 2)
        ev = streams.decoded(streams.envelope_stream(spark, f"{root}/input", files_per_batch)).drop("event_time")
        streams.await_all([streams.start_view(ev, sink, f"{root}/chk")])
        last = streams.fold_view(spark, f"{root}/view", "summing")
        sink(msgs.filter(part), last)   # a replay of a folded batch, whatever its rows, changes nothing
    return streams.read_summing_view(spark, f"{root}/view")


@register("incremental_latest")
def incremental_latest(spark, sf_dir):
    """STR7: the latest-version view kept up per micro-batch, collapsed at read."""
    root = work_dir(spark, "latest_view")
    msgs = fixtures.account_messages(table(spark, sf_dir, "events"))
    _publish(spark, lambda n: messages.to_envelope(msgs, "user", "seq", partitions=n), f"{root}/input")
    ev = streams.decoded(streams.envelope_stream(spark, f"{root}/input"), extra="seq BIGINT").drop("event_time")
    q = streams.start_view(ev, streams.latest_view_sink(f"{root}/view"), f"{root}/chk")
    streams.await_all([q])
    return streams.read_latest_view(spark, f"{root}/view")


# --- one decode for several schemas, observed metrics, state and late rows (SRC6, SRC7, STR1, STR3) --------


@register("variant_decode")
def variant_decode(spark, sf_dir):
    """SRC6: the event messages as three producers spell them, through one VARIANT decode."""
    env = fixtures.ragged_messages(table(spark, sf_dir, "events"))
    return messages.decode_any(env, ["offset"]).select(
        "offset", "id", "user", "amount", "timestamp", "category", F.size("extra").alias("extra_fields"), "broken")


@register("variant_unknown")
def variant_unknown(spark, sf_dir):
    """SRC6: the fields that these messages have beside the known ones, counted by name and type."""
    env = fixtures.ragged_messages(table(spark, sf_dir, "events"))
    return messages.unknown_fields(messages.decode_any(env))


@register("stream_metrics")
def stream_metrics(spark, sf_dir):
    """SRC7 + SNK3 metrics: order messages, some damaged, parked or written batch by batch; rows, broken ones and large
    amounts as the writing pass observed them, beside the rows that both sinks hold."""
    root = work_dir(spark, "metrics")
    msgs = fixtures.messages_from_orders(table(spark, sf_dir, "orders"))

    def envelope(n):
        env = messages.to_envelope(msgs, "user", "id", partitions=n, carry=["category"])
        return fixtures.truncate_payloads(env, F.col("category").startswith("2")).drop("category")

    _publish(spark, envelope, f"{root}/input")
    seen = messages.decode_with_quarantine(
        streams.envelope_stream(spark, f"{root}/input", max(1, topic_partitions(spark) // 2)), keep=["offset"])
    seen = seen.observe("messages", F.count(F.lit(1)).alias("rows"), F.count_if("_bad").alias("broken"),
                        F.count_if(~F.col("_bad") & (C.parse_decimal_comma("amount") > V.ALERT_THRESHOLD)).alias("large"))
    write_good, write_bad = streams.parquet_batch_sink(f"{root}/good"), streams.parquet_batch_sink(f"{root}/bad")

    def park(batch, batch_id):
        good, bad = messages.split_quarantine(batch)
        write_good(good, batch_id)
        write_bad(bad, batch_id)

    found = streams.drain_observed(spark, lambda: streams.start_view(seen, streams.multi_sink(park), f"{root}/chk"))
    totals = [found.total("messages", m) for m in ("rows", "broken", "large")]
    written = spark.read.parquet(f"{root}/good").agg(F.count("*").alias("good_written")).join(
        spark.read.parquet(f"{root}/bad").agg(F.count("*").alias("bad_written")), F.lit(True))    # one row each
    return written.select(*[F.lit(x).cast("bigint").alias(n) for x, n in zip(totals, ("rows", "broken", "large"))], "*")


@register("stream_held_windows")
def stream_held_windows(spark, sf_dir):
    """STR1 + STR5: the windows that the stream has emitted and those that its state still holds are all windows."""
    root = work_dir(spark, "held")
    _publish(spark, lambda n: _event_envelope(spark, sf_dir, n), f"{root}/input")
    ev = streams.decoded(streams.envelope_stream(spark, f"{root}/input"))
    sink = streams.multi_sink(streams.parquet_batch_sink(f"{root}/windows"))
    streams.await_all([streams.start_window_stats(ev, sink, f"{root}/chk")])
    emitted = spark.read.parquet(f"{root}/windows").drop("batch_id").withColumn("held", F.lit(False))
    held = streams.held_windows(spark, f"{root}/chk").withColumn("held", F.lit(True))
    columns = ["window_start", "window_end", "category", C.money("total_sum").alias("total_sum"), "tx_count", "held"]
    return emitted.select(*columns).unionByName(held.select(*columns))


@register("stream_late_split")
def stream_late_split(spark, sf_dir):
    """STR3: the newer half of the events arrives first, the older half late, over two runs of one checkpoint; rows whose
    window had closed go to a sink of their own. Every row is in one of the two."""
    root = work_dir(spark, "late")
    msgs = fixtures.messages_from_events(table(spark, sf_dir, "events"))
    cut = msgs.agg(((F.min("timestamp") + F.max("timestamp")) / 2).cast("bigint")).first()[0]
    sink = streams.late_split_sink(streams.parquet_batch_sink(f"{root}/on_time"), streams.parquet_batch_sink(f"{root}/late"), f"{root}/clock")
    for part in (F.col("timestamp") >= cut, F.col("timestamp") < cut):
        _publish(spark, lambda n: messages.to_envelope(msgs.filter(part), "user", "id", partitions=n), f"{root}/input")
        ev = streams.decoded(streams.envelope_stream(spark, f"{root}/input"))
        streams.await_all([streams.start_view(ev, sink, f"{root}/chk")])
    columns = ["id", "amount", C.to_wall_clock(F.col("event_time")).alias("event_time")]
    on_time = spark.read.parquet(f"{root}/on_time").select(*columns, F.lit(None).cast("timestamp_ntz").alias("watermark"))
    late = spark.read.parquet(f"{root}/late").select(*columns, C.to_wall_clock(F.col("watermark")).alias("watermark"))
    return on_time.unionByName(late)
