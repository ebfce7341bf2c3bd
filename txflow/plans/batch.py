"""Batch queries: cleaning, reports, scalar steps, collapse, windows, sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from txflow.functions import columns as C
from txflow.functions import values as V
from txflow.operators import cleaning, collapse, reports, windows
from txflow.plans.registry import raw_transactions, register, silver
from txflow.sources import fixtures, messages
from txflow.sources.tables import generate_users, parquet_scan, table


# --- batch: clean -> silver -> gold ------------------------------------------

@register("category_report")
def category_report(spark, sf_dir):
    """Turnover, count and average check per category from dirty input (flagship)."""
    return reports.category_report(silver(spark, sf_dir))


@register("clean_intended")
def clean_intended(spark, sf_dir):
    return silver(spark, sf_dir)


@register("clean_literal")
def clean_literal(spark, sf_dir):
    return cleaning.clean_literal(raw_transactions(spark, sf_dir))


@register("dedupe_by_id")
def dedupe_by_id(spark, sf_dir):
    return cleaning.dedupe_by_id(raw_transactions(spark, sf_dir))


@register("join_gender_category")
def join_gender_category(spark, sf_dir):
    users = fixtures.users_dimension(table(spark, sf_dir, "customer"))
    return reports.gender_category_report(silver(spark, sf_dir), users)


@register("join_segment_hourly")
def join_segment_hourly(spark, sf_dir):
    segments = fixtures.segments_dimension(table(spark, sf_dir, "customer"))
    return reports.hourly_report(silver(spark, sf_dir), segments)


@register("top3_per_category")
def top3_per_category(spark, sf_dir):
    return reports.top_k_per_group(silver(spark, sf_dir), "category", "amount", 3)


# --- scalar functions, one step at a time (CLN1-CLN18) -------------------------




@register("parse_amount")
def parse_amount(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    return raw.select("id", F.col("amount").alias("amount_text"),
                      C.parse_decimal_comma("amount").alias("amount"),
                      C.parse_amount_or_zero("amount").alias("amount_or_zero"))


@register("cast_tolerant")
def cast_tolerant(spark, sf_dir):
    """Straight casts as the table load does them: the decimal comma is lost (trap 8)."""
    raw = raw_transactions(spark, sf_dir)
    return raw.select(C.tolerant_cast("id", "bigint").alias("id"),
                      C.tolerant_cast("user_id", "string").alias("user"),
                      C.tolerant_cast("amount", "double").alias("amount"))


@register("parse_timestamp")
def parse_timestamp(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    return raw.select("id", F.col("timestamp").alias("timestamp_text"),
                      C.parse_timestamp("timestamp").alias("ts"))


@register("normalize_text")
def normalize_text(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    return raw.select("id", C.city_as_written("city").alias("city"),
                      C.category_as_written("category").alias("category"),
                      C.normalized_category("category").alias("category_key"))


@register("null_sentinels")
def null_sentinels(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    city = C.null_if_in(C.null_if_in(C.city_as_written("city"), V.SENTINELS_FIRST), V.SENTINELS)
    cat = C.null_if_in(C.null_if_in(C.category_as_written("category"), V.SENTINELS_FIRST), V.SENTINELS)
    return raw.select("id", city.alias("city"), C.null_if_in(cat, V.CATEGORY_BLANKS).alias("category"))


@register("recode_city")
def recode_city(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    return raw.select("id", C.recode(C.city_as_written("city"), V.CITY_NAMES).alias("city"),
                      C.intended_city("city").alias("city_intended"))


@register("fill_defaults")
def fill_defaults(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    typed = raw.select("id", "city", "category", C.parse_decimal_comma("amount").alias("amount"),
                       C.parse_timestamp("timestamp").alias("timestamp"))
    return cleaning.fill_defaults(typed)


@register("whitelist_filter")
def whitelist_filter(spark, sf_dir):
    """Literal whitelist on the literally normalised category (trap 1: only fills pass)."""
    raw = raw_transactions(spark, sf_dir)
    cat = C.null_if_in(C.null_if_in(C.category_as_written("category"), V.SENTINELS_FIRST), V.SENTINELS)
    cat = F.coalesce(C.null_if_in(cat, V.CATEGORY_BLANKS), F.lit(V.UNKNOWN_LABEL))
    return cleaning.whitelist_filter(raw.select("id", cat.alias("category")))


@register("category_multiif")
def category_multiif(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    return raw.select("id", F.col("category").alias("category_text"),
                      C.category_multiif("category").alias("category"))


@register("big_amount_alerts")
def big_amount_alerts(spark, sf_dir):
    msgs = fixtures.messages_from_orders(table(spark, sf_dir, "orders"))
    return messages.big_amounts(msgs, V.BIG_AMOUNT_THRESHOLD).select("id", "user", "amount", "category")


@register("enrich_deterministic")
def enrich_deterministic(spark, sf_dir):
    return messages.enrich(raw_transactions(spark, sf_dir))


@register("epoch_to_event_time")
def epoch_to_event_time(spark, sf_dir):
    msgs = fixtures.messages_from_events(table(spark, sf_dir, "events"))
    return collapse.with_event_time(msgs).select("id", "timestamp", "event_time")


@register("clock_fallback")
def clock_fallback(spark, sf_dir):
    msgs = fixtures.untidy_messages(table(spark, sf_dir, "events"))
    now = F.lit(fixtures.FIXED_NOW).cast("timestamp")
    return msgs.select("id", "timestamp", C.to_wall_clock(C.clock_fallback("timestamp", now)).alias("event_time"))


@register("json_decode")
def json_decode(spark, sf_dir):
    """SRC6 on events.props ({"k": int})."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k INT").alias("p")).select("event_id", "p.k")


# --- collapse, windows (DED2, AGG4, STR1, STR2, SRT2) ---------------------------

def _latest(spark, sf_dir):
    return collapse.latest_per_day(fixtures.account_messages(table(spark, sf_dir, "events")))


@register("latest_version")
def latest_version(spark, sf_dir):
    return _latest(spark, sf_dir)


@register("latest_100")
def latest_100(spark, sf_dir):
    return reports.latest_n(_latest(spark, sf_dir), "event_time", 100, "id")


@register("summing_10min")
def summing_10min(spark, sf_dir):
    msgs = fixtures.untidy_messages(table(spark, sf_dir, "events"))
    now = F.lit(fixtures.FIXED_NOW).cast("timestamp")
    return collapse.collapse_summing(collapse.summing_rows(msgs, now))


def _event_facts(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("id"), F.col("ts").alias("event_time"),
                     F.col("event_type").alias("category"), F.col("value").alias("amount"))


@register("sliding_window_batch")
def sliding_window_batch(spark, sf_dir):
    """STR1 over the whole table, bucket pre-aggregate path."""
    return windows.money_window_output(windows.sliding_window_stats_preagg(_event_facts(spark, sf_dir)))


@register("flatten_window")
def flatten_window(spark, sf_dir):
    """STR1 with its window struct flattened for a JDBC sink (SNK5); only the one-minute partials are
    fanned out to their ten windows."""
    flat = windows.flatten_window(windows.sliding_window_stats_preagg(_event_facts(spark, sf_dir)))
    return flat.select("window_start", "window_end", "category", C.money("total_sum").alias("total_sum"), "tx_count")


@register("tumbling_10min")
def tumbling_10min(spark, sf_dir):
    return windows.money_window_output(windows.tumbling_window_stats(_event_facts(spark, sf_dir)))


# --- sources ----------------------------------------------------------------------

@register("parquet_scan")
def parquet_scan_q(spark, sf_dir):
    """SRC3: projection and a filter that reach the parquet reader."""
    return parquet_scan(spark, f"{sf_dir}/events.parquet", ["event_id", "event_type", "value"],
                        F.col("value") > 50)


@register("generate_users")
def generate_users_q(spark, sf_dir):
    """SRC10: one generated user per customer row, fixed clock."""
    n = table(spark, sf_dir, "customer").count()
    return generate_users(spark, n, fixtures.FIXED_NOW)
