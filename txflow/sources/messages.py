"""Message envelopes: encode rows as keyed JSON, decode, quarantine broken ones.

The envelope has the columns of Spark's Kafka source (key, value, topic, partition,
offset, timestamp), so the same decode runs on ``readStream.format('kafka')`` and on
the parquet stand-in used where no broker exists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.functions import columns as C
from txflow.functions import values as V
from txflow.sources import schemas

CORRUPT_COLUMN = "_corrupt_record"
MESSAGE_FIELDS = ("id", "user", "user_id", "amount", "timestamp", "category")


def enrich(messages: DataFrame, key: str = "id") -> DataFrame:
    """Producer enrichment, reproducible (CLN12): class and type picked by key,
    category picked when empty, amount cleaned with 0.0 fallback (CLN1)."""
    cat = F.col("category")
    return (messages
            .withColumn("class", C.pick(key, V.PRODUCER_CLASSES, salt=1))
            .withColumn("amount", C.parse_amount_or_zero(F.col("amount").cast("string")))
            .withColumn("category", F.when(cat.isNull() | (cat == ""), C.pick(key, V.PRODUCER_CATEGORIES, salt=2))
                        .otherwise(cat))
            .withColumn("type", C.pick(key, V.PRODUCER_TYPES, salt=3)))


def to_envelope(messages: DataFrame, key: str = "user", offset: str = "id", event_time: str | None = None,
                topic: str = "raw_transactions", partitions: int = 3, carry: list[str] | None = None) -> DataFrame:
    """Rows -> envelope: key = key column as bytes, value = JSON of all columns (SNK7).

    The partition is a hash of the key (as a producer would do); the offset is taken
    from an increasing column of the rows, so no global numbering pass is needed.
    ``carry`` passes message columns through beside the envelope (for tests that
    damage chosen rows).
    """
    payload = F.to_json(F.struct(*[F.col(c) for c in messages.columns]))
    ts = F.current_timestamp() if event_time is None else F.col(event_time).cast("timestamp")
    return messages.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.hash(F.col(key)), F.lit(partitions)).cast("int").alias("partition"),
        F.col(offset).cast("bigint").alias("offset"),
        ts.alias("timestamp"),
        *[F.col(c) for c in (carry or [])],
    )


def decode(envelope: DataFrame, ddl: str = schemas.LOOSE_MESSAGE, keep: list[str] | None = None) -> DataFrame:
    """value bytes -> text -> JSON struct -> columns (SRC6). Undecodable -> all NULL."""
    keep = keep or []
    data = F.from_json(F.col("value").cast("string"), ddl).alias("data")
    return envelope.select(*keep, data).select(*keep, "data.*")


def typed(decoded: DataFrame) -> DataFrame:
    """Loose (all-text) message -> typed message: ids and epochs to BIGINT, amount via
    the decimal-comma parse. A float amount like 12.0 survives, unlike a strict INT
    schema."""
    return decoded.select(
        C.tolerant_cast(F.col("id"), "bigint").alias("id"),
        F.col("user"),
        C.parse_decimal_comma("amount").alias("amount"),
        C.tolerant_cast(F.col("timestamp"), "bigint").alias("timestamp"),
        F.col("category"),
        *[c for c in decoded.columns if c not in ("id", "user", "amount", "timestamp", "category")],
    )


def decode_any(envelope: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One decode for producers that spell the message differently (SRC6): numbers or text, a decimal comma, the time as
    epoch seconds or written out, the account as ``user`` or ``user_id``. Columns: ``keep``, id, user, amount, timestamp,
    category, extra, broken.

    The value is parsed once into a VARIANT and every field is taken from it with a cast that gives NULL where it does
    not fit. Fields that the message does not have are kept in ``extra`` (name -> VARIANT, NULL when broken); ``broken``
    is true when the value is no JSON object.
    """
    keep = keep or []
    parsed = envelope.select(*keep, F.try_parse_json(F.col("value").cast("string")).alias("_v"))
    fields = F.try_variant_get("_v", "$", "map<string,variant>")

    def text(name: str) -> Column:
        return F.try_variant_get("_v", f"$.{name}", "string")

    time = text("timestamp")
    out = parsed.select(
        *keep, text("id").alias("id"), F.coalesce(text("user"), text("user_id")).alias("user"), text("amount").alias("amount"),
        F.coalesce(C.tolerant_cast(time, "bigint"), F.unix_seconds(F.try_to_timestamp(time))).cast("string").alias("timestamp"),
        text("category").alias("category"),
        F.map_filter(fields, lambda k, _: ~k.isin(*MESSAGE_FIELDS)).alias("extra"), fields.isNull().alias("broken"))
    return typed(out).select(*keep, "id", "user", "amount", "timestamp", "category", "extra", "broken")


def unknown_fields(decoded: DataFrame) -> DataFrame:
    """field, type, rows: what ``decode_any`` kept beside the message, by name and JSON type."""
    return (decoded.select(F.explode("extra").alias("field", "value"))
            .groupBy("field", F.schema_of_variant("value").alias("type")).agg(F.count(F.lit(1)).alias("rows")))


def decode_with_quarantine(envelope: DataFrame, ddl: str = schemas.LOOSE_MESSAGE,
                           keep: list[str] | None = None) -> DataFrame:
    """Decode and flag: ``_bad`` is true when the value is missing, empty or blank (no
    JSON object at all), or not valid JSON for the schema; ``_corrupt_record`` holds the
    broken text (SRC7)."""
    keep = keep or ["partition", "offset"]
    ddl_c = f"{ddl}, {CORRUPT_COLUMN} STRING"
    data = F.from_json(F.col("value").cast("string"), ddl_c,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}).alias("data")
    parsed = envelope.select(*keep, data)
    bad = F.col("data").isNull() | F.col(f"data.{CORRUPT_COLUMN}").isNotNull()
    return parsed.select(*keep, "data.*", bad.alias("_bad"))


def split_quarantine(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the flag columns, bad rows) from ``decode_with_quarantine``."""
    good = flagged.filter(~F.col("_bad")).drop("_bad", CORRUPT_COLUMN)
    bad = flagged.filter(F.col("_bad"))
    return good, bad


class TooManyBrokenMessages(RuntimeError):
    pass


def check_broken(bad_count: int, count: int, most: float | None = None) -> None:
    """Refuse a block of ``count`` messages when more than the share ``most`` of them is broken;
    no limit by default. A share, so that it means the same at every block size."""
    if most is not None and bad_count > most * count:
        raise TooManyBrokenMessages(f"{bad_count} of {count} messages of one batch are broken (at most {most:.2%})")


def big_amounts(messages: DataFrame, threshold: float = V.BIG_AMOUNT_THRESHOLD) -> DataFrame:
    """amount > threshold, strict; NULL amounts drop (CLN10)."""
    return messages.filter(F.col("amount") > F.lit(threshold))
