"""Schemas as DDL strings, one per place data lives."""

RAW_TRANSACTIONS = "id BIGINT, user_id BIGINT, amount STRING, category STRING, timestamp STRING, city STRING"
# decode every field as text, then convert with try_cast: numbers and strings both arrive
LOOSE_MESSAGE = "id STRING, user STRING, amount STRING, timestamp STRING, category STRING"
TYPED_MESSAGE = "id BIGINT, user STRING, amount DOUBLE, timestamp BIGINT, category STRING"
MESSAGE_WITH_DEFAULTS = ("id BIGINT DEFAULT 0, user STRING DEFAULT '', amount DOUBLE DEFAULT 0.0, "
                         "timestamp BIGINT DEFAULT 0, category STRING DEFAULT ''")
ENVELOPE = "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
VERSIONED_TRANSACTIONS = "id BIGINT, user STRING, amount DOUBLE, ts TIMESTAMP_NTZ"
CHANGE_LOG = (
    "id BIGINT, user STRING, amount DOUBLE, ts TIMESTAMP_NTZ, op STRING, version INT, committed_at TIMESTAMP_NTZ"
)

# The driver tables this library reads, as stored (same at every scale factor). A
# declared schema skips the footer read of schema inference and pins the types: a
# file written with other types fails the scan instead of changing a result.
DRIVER_TABLES = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}
