"""Time-window statistics (STR1, STR2, SNK5 flattening).

``sliding_window_stats`` is Spark's own window grouping and works for a batch or a
streaming DataFrame (with a watermark). For batch input over long periods,
``sliding_window_stats_preagg`` gives the same answer cheaper: it first
aggregates per slide-sized bucket (one hash update per row instead of one per
window the row falls in) and only then fans each bucket out to the windows that
contain it. The fan-out works on partial sums, whose number is bounded by
buckets x categories, not by rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txflow.functions import columns as C
from txflow.functions import values as V


def _seconds(duration: str) -> int:
    n, unit = duration.split()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * scale


def sliding_window_stats(df: DataFrame, time_col: str = "event_time", group: str = "category",
                         amount: str = "amount", id_col: str = "id", window: str = V.SLIDING_WINDOW,
                         slide: str = V.SLIDING_SLIDE, watermark: str | None = None) -> DataFrame:
    """Per (window, group): sum(amount) AS total_sum, count(id) AS tx_count.

    With ``watermark`` (streams): state for a window is dropped once the watermark
    passes its end; in append mode each window is emitted once, then.
    """
    if watermark:
        df = df.withWatermark(time_col, watermark)
    return df.groupBy(F.window(time_col, window, slide).alias("window"), F.col(group).alias("category")).agg(
        F.sum(amount).alias("total_sum"), F.count(id_col).alias("tx_count"))


def tumbling_window_stats(df: DataFrame, time_col: str = "event_time", group: str = "category",
                          amount: str = "amount", id_col: str = "id", window: str = V.SUMMING_BUCKET,
                          watermark: str | None = None) -> DataFrame:
    """STR2: non-overlapping windows (start = time truncated to the window size)."""
    if watermark:
        df = df.withWatermark(time_col, watermark)
    return df.groupBy(F.window(time_col, window).alias("window"), F.col(group).alias("category")).agg(
        F.sum(amount).alias("total_sum"), F.count(id_col).alias("tx_count"))


def sliding_window_stats_preagg(df: DataFrame, time_col: str = "event_time", group: str = "category",
                                amount: str = "amount", id_col: str = "id", window: str = V.SLIDING_WINDOW,
                                slide: str = V.SLIDING_SLIDE) -> DataFrame:
    """Batch form of ``sliding_window_stats`` with a per-bucket pre-aggregate.

    Requires the window length to be a multiple of the slide (true for 10 min / 1 min).
    """
    w, s = _seconds(window), _seconds(slide)
    if w % s:
        raise ValueError("window must be a multiple of slide")
    n = w // s
    buckets = df.groupBy(F.window(time_col, slide).start.alias("_b"), F.col(group).alias("category")).agg(
        F.sum(amount).alias("_sum"), F.count(id_col).alias("_cnt"))
    offsets = F.explode(F.array(*[F.lit(k) for k in range(n)])).alias("_k")
    fanned = buckets.select("*", offsets).withColumn(
        "window_start", F.col("_b") - F.make_dt_interval(secs=F.col("_k") * F.lit(s)))
    out = fanned.groupBy("window_start", "category").agg(
        F.sum("_sum").alias("total_sum"), F.sum("_cnt").alias("tx_count"))
    return out.select(
        F.struct(F.col("window_start").alias("start"),
                 (F.col("window_start") + F.make_dt_interval(secs=F.lit(w))).alias("end")).alias("window"),
        "category", "total_sum", "tx_count")


def flatten_window(df: DataFrame, wall_clock: bool = True) -> DataFrame:
    """SNK5: window struct -> window_start / window_end columns (JDBC cannot take a struct)."""
    start, end = F.col("window.start"), F.col("window.end")
    if wall_clock:
        start, end = C.to_wall_clock(start), C.to_wall_clock(end)
    return df.select(*[c for c in df.columns if c != "window"],
                     start.alias("window_start"), end.alias("window_end"))


def money_window_output(df: DataFrame) -> DataFrame:
    """Flattened windows with sums rounded to cents (report form)."""
    return flatten_window(df).withColumn("total_sum", C.money("total_sum"))
