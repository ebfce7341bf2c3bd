"""Inputs derived from the driver tables (rules in FIXTURES.md).

Every frame here is a projection / union / join of whole driver tables, so its size
grows with the tables. Rules use the order key only to *make* dirty values, never to
drop rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.functions import columns as C

# --- Fixed values: dirty-input rule (FIXTURES.md §3) --------------------------
# category by k % 12 (None = SQL NULL)
DIRTY_CATEGORIES = ["retail", " Tech ", "FOOD\t", "fin ance", "Unknown", "N/A", "NULL", "", None,
                    "Retail", "noname", "toys"]
# city by k % 8 (None = SQL NULL)
DIRTY_CITIES = ["nyc", "LA", " sf", "n/a", "unknown\t", None, "new york", "NULL"]
# amount: 'bad' when k % 17 = 0, NULL when k % 19 = 0, ',' decimal mark when k is even
# timestamp: 'not a time' when k % 23 = 0, NULL when k % 29 = 0, else 'YYYY-MM-DD HH:30:00', HH = k % 24
# rows with k % 20 = 0 appear twice
CHANGE_LOG_START = _dt.datetime(2024, 1, 1, 0, 0, 0)


def _hundredths(col: str) -> Column:
    """A money amount in whole cents, or a rate in whole percent, as BIGINT.

    Prices in the driver data are whole cents and rates whole percents, so products
    and sums of these integers are exact, as DECIMAL arithmetic would be, but stay
    on 64-bit integers (Spark multiplies decimals through BigDecimal, per row). With
    ANSI on, an overflow fails instead of wrapping.
    """
    return F.round(F.col(col) * 100).cast("bigint")


def _to_cents(units: Column, scale: int) -> Column:
    """An exact integer count of 10^-scale units -> DECIMAL(18,2), rounded half up;
    applied once per group, after the integer sum."""
    return (units.cast("decimal(38,0)") / F.lit(10 ** scale)).cast("decimal(18,2)")


def _cycle(k: Column, items: list) -> Column:
    arr = F.array(*[F.lit(x).cast("string") for x in items])
    return F.element_at(arr, (F.pmod(k, F.lit(len(items))) + 1).cast("int"))


def dirty_transactions(orders: DataFrame) -> DataFrame:
    """Raw CSV-shaped rows (all text except ids) with every kind of dirt, from ``orders``."""
    k = F.col("o_orderkey")
    amount_txt = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    amount = (F.when(k % 17 == 0, F.lit("bad"))
              .when(k % 19 == 0, F.lit(None).cast("string"))
              .when(k % 2 == 0, F.translate(amount_txt, ".", ","))
              .otherwise(amount_txt))
    ts_txt = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "),
                      F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":30:00"))
    ts = (F.when(k % 23 == 0, F.lit("not a time"))
          .when(k % 29 == 0, F.lit(None).cast("string"))
          .otherwise(ts_txt))
    # rows with k % 20 = 0 come out twice: one scan, no self-union
    copies = F.explode(F.sequence(F.lit(1), F.when(k % 20 == 0, F.lit(2)).otherwise(F.lit(1)))).alias("_copy")
    rows = orders.select(
        copies,
        k.alias("id"),
        F.col("o_custkey").alias("user_id"),
        amount.alias("amount"),
        _cycle(k, DIRTY_CATEGORIES).alias("category"),
        ts.alias("timestamp"),
        _cycle(k, DIRTY_CITIES).alias("city"),
    )
    return rows.drop("_copy")


def users_dimension(customer: DataFrame) -> DataFrame:
    """users (user_id, name, gender, age) from ``customer``: gender by key parity,
    age 18 + key % 60."""
    k = F.col("c_custkey")
    return customer.select(
        k.alias("user_id"),
        F.col("c_name").alias("name"),
        F.when(k % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        (F.lit(18) + k % 60).cast("int").alias("age"),
    )


# --- Fixed values: segment labels by market segment ---------------------------
SEGMENT_OF_MARKET = {"AUTOMOBILE": "VIP", "BUILDING": "Standart", "FURNITURE": "Premium"}


def segments_dimension(customer: DataFrame) -> DataFrame:
    """segments (user STRING, segment) for customers of three market segments."""
    seg = C.recode("c_mktsegment", SEGMENT_OF_MARKET)
    return (customer.filter(F.col("c_mktsegment").isin(list(SEGMENT_OF_MARKET)))
            .select(F.col("c_custkey").cast("string").alias("user"), seg.alias("segment")))


def messages_from_events(events: DataFrame) -> DataFrame:
    """Typed message rows: value -> amount, event_type -> category, ts -> epoch seconds."""
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("user"),
        F.col("value").alias("amount"),
        C.timestamp_to_epoch("ts").alias("timestamp"),
        F.col("event_type").alias("category"),
    )


def untidy_messages(events: DataFrame) -> DataFrame:
    """The event messages as a careless producer sends them: by event id a time of 0 (k % 7 = 0) or none
    (k % 11 = 0), no amount (k % 13 = 0), and every dirty category of the fixed list in turn."""
    k = F.col("id")
    return messages_from_events(events).select(
        "id", "user",
        F.when(k % 13 != 0, F.col("amount")).alias("amount"),
        F.when(k % 7 == 0, F.lit(0)).when(k % 11 != 0, F.col("timestamp")).cast("bigint").alias("timestamp"),
        F.when(k % 3 == 0, _cycle(k, DIRTY_CATEGORIES)).otherwise(F.col("category")).alias("category"))


def messages_from_orders(orders: DataFrame) -> DataFrame:
    """Typed message rows from orders (large amounts, used for alerts)."""
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").cast("string").alias("user"),
        F.col("o_totalprice").alias("amount"),
        C.timestamp_to_epoch("o_orderdate").alias("timestamp"),
        F.col("o_orderpriority").alias("category"),
    )


def as_versioned(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").cast("string").alias("user"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ts"),
    )


def versioned_transactions(orders: DataFrame) -> DataFrame:
    """Merge target: the live table holds every order that is not pending."""
    return as_versioned(orders.filter(F.col("o_orderstatus") != "P"))


def pending_transactions(orders: DataFrame) -> DataFrame:
    """The pending orders in the same shape: a later load appended to the table."""
    return as_versioned(orders.filter(F.col("o_orderstatus") == "P"))


def settlements(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Merge source: one row per order that has line items, with the settled amount
    (sum of net price with tax, to cents) and the last ship date."""
    # cents x (100 - discount %) x (100 + tax %): units of 10^-6
    gross = _hundredths("l_extendedprice") * (100 - _hundredths("l_discount")) * (100 + _hundredths("l_tax"))
    per_order = lineitem.groupBy("l_orderkey").agg(
        _to_cents(F.sum(gross), 6).cast("double").alias("amount"),
        F.max("l_shipdate").alias("ts"),
    )
    return per_order.join(orders.select("o_orderkey", "o_custkey"),
                          per_order.l_orderkey == orders.o_orderkey, "inner").select(
        F.col("l_orderkey").alias("id"),
        F.col("o_custkey").cast("string").alias("user"),
        F.col("amount"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
    )


def change_log(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Append-only change log of the transactions table.

    version 1 inserts every order. Returned line items (flag 'R') change their order
    at version 1 + line number: a 'delete' when a line is finished ('F') with a
    discount of at least 0.08, else an 'update' (amount = net price of those lines).
    committed_at = start + version hours.
    """
    inserts = as_versioned(orders).withColumns({"op": F.lit("insert"), "version": F.lit(1)})
    # line numbers repeat within an order in the driver data: one change per
    # (order, line number), amounts added up, delete if any of the lines says so
    returned = (lineitem.filter(F.col("l_returnflag") == "R")
                .groupBy("l_orderkey", "l_linenumber").agg(
                    # cents x (100 - discount %): units of 10^-4
                    _to_cents(F.sum(_hundredths("l_extendedprice") * (100 - _hundredths("l_discount"))), 4)
                    .alias("net"),
                    F.max("l_shipdate").alias("l_shipdate"),
                    F.max(((F.col("l_linestatus") == "F") & (F.col("l_discount") >= 0.08)).cast("int"))
                    .alias("drop")))
    changes = returned.join(orders.select("o_orderkey", "o_custkey"),
                            returned.l_orderkey == orders.o_orderkey, "inner").select(
        F.col("l_orderkey").alias("id"),
        F.col("o_custkey").cast("string").alias("user"),
        F.col("net").cast("decimal(18,2)").cast("double").alias("amount"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("ts"),
        F.when(F.col("drop") == 1, F.lit("delete")).otherwise(F.lit("update")).alias("op"),
        (F.col("l_linenumber") + 1).cast("int").alias("version"),
    )
    log = inserts.unionByName(changes)
    start = F.lit(CHANGE_LOG_START).cast("timestamp_ntz")
    return log.withColumn("committed_at", start + F.make_dt_interval(hours=F.col("version")))


def account_messages(events: DataFrame) -> DataFrame:
    """Messages keyed by account (id = user_id), in arrival order ``seq`` = event_id:
    the input of the replacing (latest-version) table. Times are whole hours, so that
    versions of an account tie and the last to arrive wins."""
    return events.select(
        F.col("user_id").alias("id"),
        F.col("user_id").cast("string").alias("user"),
        F.col("value").alias("amount"),
        (C.timestamp_to_epoch("ts") - C.timestamp_to_epoch("ts") % 3600).alias("timestamp"),
        F.col("event_type").alias("category"),
        F.col("event_id").alias("seq"),
    )


# fixed clock for the "timestamp = 0 -> now" fallback in registered queries
FIXED_NOW = _dt.datetime(2024, 2, 1, 0, 0, 0)


def truncate_payloads(env: DataFrame, when: Column) -> DataFrame:
    """Damage the JSON of rows matching ``when`` (last character cut off): the broken
    messages a quarantine must catch."""
    text = F.col("value").cast("string")
    broken = F.expr("substring(CAST(value AS STRING), 1, length(CAST(value AS STRING)) - 1)")
    return env.withColumn("value", F.when(when, broken).otherwise(text).cast("binary"))


def publish(env: DataFrame, path: str, partitions: int | None = None) -> str:
    """Append envelope rows as parquet files (what a producer run would publish).

    With ``partitions``: one file per topic partition. Rows go to the writer of
    their key's hash partition, the same Murmur3 hash of the key bytes that chose
    their ``partition`` value, so a micro-batch reads the topic partitions in
    parallel, as the Kafka source does.
    """
    if partitions:
        env = env.repartition(partitions, "key")
    env.write.mode("append").parquet(path)
    return path


def ragged_messages(events: DataFrame) -> DataFrame:
    """The event messages as three producers spell them, by event id: typed values; all fields as text, with a decimal
    comma, a written-out time and two more fields; the account as a number named user_id, the whole properties too."""
    m = events.select(F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("user"),
                      F.col("value").alias("amount"), C.timestamp_to_epoch("ts").alias("timestamp"),
                      F.col("event_type").alias("category"), "props")
    k = F.col("id")
    typed = F.to_json(F.struct("id", "user", "amount", "timestamp", "category"))
    text = F.to_json(F.struct(
        k.cast("string").alias("id"), "user", F.translate(F.col("amount").cast("decimal(18,2)").cast("string"), ".", ",").alias("amount"),
        F.date_format(F.timestamp_seconds("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "category",
        F.lit("vip").alias("class"), F.lit("refund").alias("type")))
    nested = F.to_json(F.struct(k.alias("id"), F.col("user").cast("bigint").alias("user_id"), "amount", "timestamp", "category",
                                F.from_json("props", "k INT").alias("props")))
    value = F.when(k % 3 == 0, typed).when(k % 3 == 1, text).otherwise(nested)
    return m.select(k.alias("offset"), value.cast("binary").alias("value"))


def order_lines(orders: DataFrame) -> DataFrame:
    """month, value: one text line for each order, ``key|status|price``, in order of the keys within its month's file."""
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    rows = orders.select(F.date_format("o_orderdate", "yyyyMM").alias("month"), "o_orderkey", line.alias("value"))
    return rows.repartition("month").sortWithinPartitions("month", "o_orderkey").select("month", "value")
