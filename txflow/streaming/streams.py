"""Structured Streaming wrappers (SRC5, SNK2-4, STR1, STR3-7).

Sources: ``kafka_stream`` when the Kafka connector is on the classpath (it is not
in this image, so that path is untested here); ``envelope_stream`` reads the same
envelope columns from parquet files, one or more files per trigger.

Every query is checkpointed; sinks are idempotent per ``batch_id`` so a replayed
micro-batch (after a lost executor or a driver restart) overwrites, never
duplicates. Shuffle width of stateful queries is fixed by the first checkpoint,
so it can be given explicitly before the first start.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from txflow.functions import columns as C
from txflow.functions import values as V
from txflow.operators import collapse, windows
from txflow.session import folders, written_whole
from txflow.sources import messages, schemas

STATE_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
STATE_STORES = {
    "hdfs": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def cluster_cores(spark: SparkSession) -> int | None:
    """Cores the job can use; None when unbounded.

    With dynamic allocation a stream often starts before executors scale up, when
    ``defaultParallelism`` is tiny, and the width chosen then is fixed by the
    checkpoint for good; so the bound is maxExecutors x executor cores instead.
    """
    sc = spark.sparkContext
    conf = sc.getConf()
    if conf.get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        most = conf.get("spark.dynamicAllocation.maxExecutors", None)
        if most is None or int(most) >= 2 ** 31 - 1:
            return None
        return int(most) * int(conf.get("spark.executor.cores", "1"))
    return sc.defaultParallelism


def default_state_width(spark: SparkSession) -> int:
    """min(session shuffle width, 2 x cores): the width of a new stream's state."""
    session_width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cores = cluster_cores(spark)
    return max(1, session_width if cores is None else min(session_width, 2 * cores))


# --- sources ------------------------------------------------------------------

def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 max_offsets_per_trigger: int | None = None,
                 fail_on_data_loss: bool = False, min_partitions: int | None = None) -> DataFrame:
    """Subscribe to one topic from ``starting``, at most ``max_offsets_per_trigger``
    offsets per micro-batch if given (SRC5; a job that wants the cap of the fixed values passes it). Needs the spark-sql-kafka connector.

    Spark reads one task per topic partition; ``min_partitions`` lets the source
    split large offset ranges into more tasks, so a hot topic partition (keyed
    messages of one busy key) is not decoded by one task alone.
    """
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions:
        r = r.option("minPartitions", min_partitions)
    return r.load()


def envelope_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                    max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Envelope rows from parquet files in ``path``; files are taken oldest first, at most so many files or (about) so
    many bytes in a batch."""
    r = spark.readStream.schema(schemas.ENVELOPE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return r.parquet(path)


def decoded(env: DataFrame, extra: str = "") -> DataFrame:
    """Envelope -> typed message columns + event_time (TIMESTAMP, for watermarks)."""
    ddl = schemas.LOOSE_MESSAGE + (f", {extra}" if extra else "")
    typed = messages.typed(messages.decode(env, ddl))
    return typed.withColumn("event_time", C.epoch_to_timestamp("timestamp"))


# --- sinks and queries ---------------------------------------------------------

def _stream_writer(df: DataFrame, checkpoint: str, available_now: bool, name: str | None):
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if name:
        w = w.queryName(name)
    return w.trigger(availableNow=True) if available_now else w


def start_silver(clean: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                 partition_by: str = "category") -> StreamingQuery:
    """SNK2: append to parquet partitioned by category. The file sink's own log
    makes the output exactly-once across restarts."""
    w = _stream_writer(clean, checkpoint, available_now, None)
    return w.format("parquet").partitionBy(partition_by).option("path", path).start()


def start_alerts(clean: DataFrame, path: str, checkpoint: str, threshold: float = V.ALERT_THRESHOLD,
                 available_now: bool = True) -> StreamingQuery:
    """SNK3: rows with amount > threshold, columns user / amount / category. Parquet
    instead of the console, and checkpointed, so alerts survive a restart."""
    alerts = messages.big_amounts(clean, threshold).select("user", "amount", "category")
    return _stream_writer(alerts, checkpoint, available_now, None).format("parquet").option("path", path).start()


def positive_amounts(decoded_stream: DataFrame) -> DataFrame:
    """The stream job's cleaning: amount as double, amount > 0 (NULL drops)."""
    return decoded_stream.filter(F.col("amount") > 0)


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait for every query (STR6); re-raise the first failure."""
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


def run_silver_and_alerts(spark: SparkSession, env_path: str, silver_path: str, alerts_path: str,
                          checkpoint_root: str, threshold: float = V.ALERT_THRESHOLD,
                          max_files_per_trigger: int | None = None) -> None:
    """Two queries over one cleaned stream, run to completion, both awaited."""
    clean = positive_amounts(decoded(envelope_stream(spark, env_path, max_files_per_trigger))).drop("event_time")
    q1 = start_silver(clean, silver_path, f"{checkpoint_root}/silver")
    q2 = start_alerts(clean, alerts_path, f"{checkpoint_root}/alerts", threshold)
    await_all([q1, q2])


def run_silver_with_alerts(spark: SparkSession, env_path: str, silver_path: str, alerts_path: str, checkpoint: str,
                           threshold: float = V.ALERT_THRESHOLD, max_files_per_trigger: int | None = None) -> None:
    """SNK2 and SNK3 from one read and one decode of the topic: each cleaned micro-batch goes to
    the silver sink (by category) and its large amounts to the alert sink."""
    clean = positive_amounts(decoded(envelope_stream(spark, env_path, max_files_per_trigger))).drop("event_time")
    alert_sink = parquet_batch_sink(alerts_path)

    def alerts(batch: DataFrame, batch_id: int) -> None:
        alert_sink(messages.big_amounts(batch, threshold).select("user", "amount", "category"), batch_id)

    both = multi_sink(parquet_batch_sink(silver_path, partition_by=["category"]), alerts)
    await_all([_stream_writer(clean, checkpoint, True, None).foreachBatch(both).start()])


# --- foreachBatch: several sinks per micro-batch -------------------------------

BatchSink = Callable[[DataFrame, int], None]


def parquet_batch_sink(path: str, partition_col: str = "batch_id", partition_by: list[str] | None = None) -> BatchSink:
    """Writes each micro-batch to ``path/batch_id=N``, replacing that folder only:
    a replayed batch overwrites its own earlier output (dynamic partition overwrite).
    Batch ids are those of one checkpoint: a new checkpoint starts at 0, so it needs a
    new ``path``. ``partition_by`` adds folders below the batch's; the rows are then
    dealt by them first (a hot one is split at run time), so that not every task
    writes a small file into every folder."""
    def sink(df: DataFrame, batch_id: int) -> None:
        dealt = df.hint("rebalance", *partition_by) if partition_by else df
        (dealt.withColumn(partition_col, F.lit(batch_id).cast("bigint")).write
         .option("partitionOverwriteMode", "dynamic").mode("overwrite")
         .partitionBy(partition_col, *(partition_by or [])).parquet(path))
    return sink


def jdbc_batch_sink(url: str, table: str, properties: dict[str, str] | None = None) -> BatchSink:
    """JDBC append with a ``batch_id`` column; a batch already present is skipped on
    replay (checked with one pushed-down count; Spark creates the column quoted, so
    it is quoted in the check too). Struct columns must be flattened first (JDBC has
    no struct type).

    Spark's JDBC writer commits once per partition, so a write cut off half way
    would leave part of a batch that the replay check then skips. The batch is
    therefore written by one writer, in one transaction: all of it or none. The
    rows are a micro-batch's closed windows (windows x categories under the rate
    cap), not raw events, so one writer is enough and the database is the limit.
    """
    props = {**(properties or {}), "numPartitions": "1"}

    def sink(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        try:
            seen = (spark.read.format("jdbc").option("url", url).options(**props)
                    .option("query", f'SELECT COUNT(*) AS n FROM {table} WHERE "batch_id" = {int(batch_id)}')
                    .load().first()[0])
        except Exception:  # table does not exist yet: first batch creates it
            seen = 0
        if seen:
            return
        (df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.format("jdbc")
         .option("url", url).option("dbtable", table).options(**props).mode("append").save())
    return sink


def multi_sink(*sinks: BatchSink, flatten: bool = True) -> Callable[[DataFrame, int], None]:
    """SNK4: one micro-batch to several sinks. Empty batches are skipped; the batch is
    computed once (persisted) and flattened before any sink sees it."""
    def run(batch: DataFrame, batch_id: int) -> None:
        # persisted before the emptiness check, so the micro-batch plan (state
        # store reads included) runs once for the check and every sink
        out = windows.flatten_window(batch) if flatten and "window" in batch.columns else batch
        out = out.persist()
        try:
            if out.isEmpty():
                return
            for s in sinks:
                s(out, batch_id)
        finally:
            out.unpersist()
    return run


def start_window_stats(events: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                       available_now: bool = True, watermark: str = V.WATERMARK_DELAY,
                       window: str = V.SLIDING_WINDOW, slide: str = V.SLIDING_SLIDE,
                       state_partitions: int | None = None, state_store: str | None = None) -> StreamingQuery:
    """STR1 + STR3 + SNK4: watermark, sliding window per category, append mode, every
    emitted window delivered through ``sink`` (e.g. ``multi_sink``).

    ``state_partitions`` sets the state store width for a *new* checkpoint (later
    restarts keep the width recorded in the checkpoint). Default: the session's
    shuffle width, but at most two tasks per core: a batch cluster sized for 100 TB
    scans may run tens of thousands of shuffle partitions, and every micro-batch
    would then start that many state tasks forever, while the state itself is only
    windows x categories. Under dynamic allocation the cores are maxExecutors x
    executor cores; with no executor limit the session width stays, so give
    ``state_partitions`` explicitly there. ``state_store="rocksdb"`` keeps window state in
    RocksDB (off-heap, incremental checkpoints) instead of executor heap maps, for
    large state. Partial aggregation happens before the state shuffle, so a hot
    category costs one row per task and window, not all its rows.
    """
    spark = events.sparkSession
    stats = windows.sliding_window_stats(events, "event_time", "category", "amount", "id",
                                         window, slide, watermark)
    # the query takes a copy of the session conf when it starts, so the old value is
    # restored right after
    settings = {"spark.sql.shuffle.partitions": str(state_partitions or default_state_width(spark))}
    if state_store:
        settings[STATE_STORE_KEY] = STATE_STORES[state_store]
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return _stream_writer(stats, checkpoint, available_now, None).foreachBatch(sink).start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- continuous views (STR7) -----------------------------------------------------

def summing_view_sink(path: str, now=None) -> BatchSink:
    """Per batch: project to summing rows and pre-add them per (timer, category);
    partials stored under batch_id=N (replay-safe). Readers add partials up."""
    write = parquet_batch_sink(path)

    def sink(df: DataFrame, batch_id: int) -> None:
        write(collapse.collapse_summing(collapse.summing_rows(df, now)), batch_id)
    return sink


def latest_view_sink(path: str) -> BatchSink:
    """Per batch: keep the newest row per (day, id) of the batch; readers collapse
    again across batches."""
    write = parquet_batch_sink(path)

    def sink(df: DataFrame, batch_id: int) -> None:
        keep = collapse.latest_version(collapse.with_event_time(df), [F.to_date("event_time"), "id"],
                                       "timestamp", "seq")
        write(keep, batch_id)
    return sink


def start_view(stream: DataFrame, sink: BatchSink, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    return _stream_writer(stream, checkpoint, available_now, None).foreachBatch(sink).start()


def _collapse_view(rows: DataFrame, kind: str) -> DataFrame:
    if kind == "summing":
        return collapse.collapse_summing(rows)
    if kind == "latest":
        return collapse.latest_version(rows, [F.to_date("event_time"), "id"], "timestamp", "seq")
    raise ValueError(kind)


BASELINE = "_baseline"   # beside the batches; a reader of the batches passes over names with an underscore


def _baseline(spark: SparkSession, path: str) -> int | None:
    """The last batch of the newest baseline that is written whole: one that a fold left half done doesn't count."""
    at = f"{path}/{BASELINE}"
    found = [int(n.removeprefix("through=")) for n in folders(spark, at) if n.startswith("through=")]
    return max((n for n in found if written_whole(spark, f"{at}/through={n}")), default=None)


def _view_rows(spark: SparkSession, path: str) -> tuple[DataFrame, int | None]:
    """(rows of the newest baseline and of the batches after it, the last batch of that baseline)."""
    through = _baseline(spark, path)
    if through is None:
        return spark.read.parquet(path).drop("batch_id"), None
    base = spark.read.parquet(f"{path}/{BASELINE}/through={through}")
    batches = spark.read.schema(T.StructType([*base.schema, T.StructField("batch_id", T.LongType())])).parquet(path)
    return base.unionByName(batches.filter(F.col("batch_id") > through).drop("batch_id")), through


def read_summing_view(spark: SparkSession, path: str) -> DataFrame:
    return _collapse_view(_view_rows(spark, path)[0], "summing")


def read_latest_view(spark: SparkSession, path: str) -> DataFrame:
    return _collapse_view(_view_rows(spark, path)[0], "latest").drop("seq")


def quarantine_sink(good: BatchSink, bad_path: str, most: float | None = None, ddl: str = schemas.LOOSE_MESSAGE,
                    metrics_path: str | None = None) -> BatchSink:
    """SRC7 for streams: decode each raw envelope batch, park broken messages under
    ``bad_path/batch_id=N`` before anything else, refuse the batch when more than the share
    ``most`` of it is broken (no limit by default), and hand the good rows (typed) to ``good``.
    The batch is decoded once (persisted); how many of its rows are broken is observed in the pass that parks them.
    ``metrics_path`` gets one row a batch: rows, broken."""
    write_bad = parquet_batch_sink(bad_path)

    def sink(env: DataFrame, batch_id: int) -> None:
        flagged = messages.decode_with_quarantine(env, ddl, keep=["key", "partition", "offset"]).persist()
        try:
            counts = Observation()
            seen = flagged.observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if("_bad").alias("broken"))
            _, bad = messages.split_quarantine(seen)
            write_bad(bad.select("key", "partition", "offset", messages.CORRUPT_COLUMN), batch_id)
            found = counts.get
            if metrics_path:
                row = env.sparkSession.createDataFrame([(found["rows"], found["broken"])], "rows long, broken long")
                parquet_batch_sink(metrics_path)(row, batch_id)
            messages.check_broken(found["broken"], found["rows"], most)
            good(messages.typed(messages.split_quarantine(flagged)[0]), batch_id)
        finally:
            flagged.unpersist()
    return sink


class ObservedMetrics(StreamingQueryListener):
    """Adds up what ``df.observe(name, ...)`` of streams reports, batch by batch, from the pass that writes: for
    each name the metrics of every batch, and their sums."""

    def __init__(self) -> None:
        self.batches: dict[str, dict[int, dict[str, int]]] = {}
        self._ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        self._ended.clear()

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            # a batch that ran anew after a restart counts once
            self.batches.setdefault(name, {})[event.progress.batchId] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    def total(self, name: str, metric: str) -> int:
        return sum(m[metric] or 0 for m in self.batches.get(name, {}).values())

    def drain(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Wait until ``query`` has ended and its events have arrived."""
        await_all([query])
        if not self._ended.wait(seconds):
            raise TimeoutError("the query's end was not reported")


def drain_observed(spark: SparkSession, start: Callable[[], StreamingQuery]) -> ObservedMetrics:
    """Run a stream to its end and return the metrics that its passes observed."""
    metrics = ObservedMetrics()
    spark.streams.addListener(metrics)
    try:
        metrics.drain(start())
    finally:
        spark.streams.removeListener(metrics)
    return metrics


# --- windows that are still held, and rows that come too late (STR1, STR3) ----------

def held_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows of a window stream that its state still holds, because the watermark has not passed their end:
    window_start, window_end, category, total_sum, tx_count, read from the state store of the last batch."""
    state = spark.read.format("statestore").load(checkpoint)
    value = state.schema["value"].dataType.names
    return state.select(C.to_wall_clock(F.col("key.window.start")).alias("window_start"),
                        C.to_wall_clock(F.col("key.window.end")).alias("window_end"), F.col("key.category").alias("category"),
                        F.col("value").getField(value[0]).alias("total_sum"), F.col("value").getField(value[1]).alias("tx_count"))


def late_split_sink(on_time: BatchSink, late: BatchSink, clock_path: str, window: str = V.SLIDING_WINDOW,
                    delay: str = V.WATERMARK_DELAY, time_col: str = "event_time") -> BatchSink:
    """STR3 with a record of late rows: a row whose tumbling ``window`` had closed before its batch goes to ``late``, with
    the ``watermark`` that closed it; all others go to ``on_time``.

    The watermark of a batch is the largest event time of all earlier batches less ``delay``; a window is closed
    when it ends at or before it, as in the window aggregation; a row without a time is never late. Each batch keeps the
    largest time so far under ``clock_path/batch_id=N`` and reads that of the batch before it, so a batch that is replayed
    sees the watermark it saw before and writes the same rows.
    """
    write_clock = parquet_batch_sink(clock_path)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            newest = Observation()
            seen = batch.observe(newest, F.max(F.unix_micros(time_col)).alias("newest"))
            before = [int(n.removeprefix("batch_id=")) for n in folders(spark, clock_path) if n.startswith("batch_id=")]
            before = max((n for n in before if n < batch_id), default=None)
            earlier = None
            if before is not None:
                earlier = spark.read.schema("newest long").parquet(f"{clock_path}/batch_id={before}").first()["newest"]
            mark = F.timestamp_micros(F.lit(earlier).cast("long")) - F.expr(f"INTERVAL {delay}")
            size = F.expr(f"unix_micros(timestamp_seconds(0) + INTERVAL {window})")
            micros = F.unix_micros(time_col)
            closed = F.coalesce(F.timestamp_micros(micros - F.pmod(micros, size) + size) <= mark, F.lit(False))
            on_time(seen.filter(~closed), batch_id)
            late(batch.filter(closed).withColumn("watermark", mark), batch_id)
            told = [x for x in (earlier, newest.get["newest"]) if x is not None]
            if told:
                write_clock(spark.createDataFrame([(max(told),)], "newest long"), batch_id)
        finally:
            batch.unpersist()
    return sink


def fold_view(spark: SparkSession, path: str, kind: str) -> int:
    """Background merge of a continuous view: everything up to the newest batch N becomes one
    baseline, ``path/_baseline/through=N``. Readers take the newest baseline and the batches after
    it, so a replay of batch N or an earlier one changes nothing, and new batches land as before.
    Returns N. ``kind`` is 'summing' or 'latest'. A view folded twice at the same N stays as it is; a fold that was cut
    off is passed over by readers and written anew by the next one."""
    rows, through = _view_rows(spark, path)
    last = spark.read.parquet(path).agg(F.max("batch_id")).first()[0]
    if through is not None and last <= through:
        return through
    _collapse_view(rows, kind).write.mode("overwrite").parquet(f"{path}/{BASELINE}/through={int(last)}")
    return int(last)
