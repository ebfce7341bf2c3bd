"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark code: plain SQL over the driver's views. Shared
pieces are CTE text. DuckDB spellings: ``regexp_replace(..., 'g')`` for replace-all,
``chr(9)`` for a tab, lists are 1-based, Spark's ``initcap`` (lower-case, then upper
the first letter after each blank) is spelled with ``string_split``.
"""

from __future__ import annotations

TAB = "chr(9)"


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


DIRTY = f"""
raw1 AS (
  SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_custkey AS BIGINT) AS user_id,
    CASE WHEN o_orderkey % 17 = 0 THEN 'bad'
         WHEN o_orderkey % 19 = 0 THEN NULL
         WHEN o_orderkey % 2 = 0 THEN replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
    (['retail', ' Tech ', 'FOOD' || {TAB}, 'fin ance', 'Unknown', 'N/A', 'NULL', '', NULL,
      'Retail', 'noname', 'toys'])[o_orderkey % 12 + 1] AS category,
    CASE WHEN o_orderkey % 23 = 0 THEN 'not a time'
         WHEN o_orderkey % 29 = 0 THEN NULL
         ELSE strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0')
              || ':30:00' END AS "timestamp",
    (['nyc', 'LA', ' sf', 'n/a', 'unknown' || {TAB}, NULL, 'new york', 'NULL'])[o_orderkey % 8 + 1] AS city
  FROM orders),
raw AS (SELECT * FROM raw1 UNION ALL SELECT * FROM raw1 WHERE id % 20 = 0)"""

_CITY_I = initcap(r"regexp_replace(city, '^\s+|\s+$', '', 'g')")

INTENDED = DIRTY + f""",
norm AS (
  SELECT id, user_id,
    coalesce(TRY_CAST(trim(replace(amount, ',', '.')) AS DOUBLE), 0.0) AS amount,
    upper(regexp_replace(category, '\\s+', '', 'g')) AS cat,
    coalesce(TRY_CAST("timestamp" AS TIMESTAMP), TIMESTAMP '1970-01-01 00:00:00') AS "timestamp",
    {_CITY_I} AS c1
  FROM raw),
norm2 AS (
  SELECT id, user_id, amount,
    CASE WHEN cat IS NULL OR cat IN ('', 'N/A', 'NULL', 'UNKNOWN') THEN 'UNKNOWN' ELSE cat END AS category,
    "timestamp",
    coalesce(CASE WHEN upper(c1) IN ('', 'N/A', 'NULL', 'UNKNOWN') THEN NULL
                  WHEN c1 = 'La' THEN 'Los Angeles' WHEN c1 = 'Sf' THEN 'San Francisco'
                  WHEN c1 = 'Nyc' THEN 'New York' ELSE c1 END, 'Unknown') AS city
  FROM norm),
silver AS (
  SELECT id, user_id, amount, category, "timestamp", city FROM norm2
  WHERE category IN ('FINANCE', 'FOOD', 'NONAME', 'RETAIL', 'TECH', 'UNKNOWN')
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY user_id ASC NULLS FIRST, amount ASC NULLS FIRST,
      category ASC NULLS FIRST, "timestamp" ASC NULLS FIRST, city ASC NULLS FIRST) = 1)"""

_S1 = ("CASE WHEN {x} IN ('N/a' || chr(9), 'Tech' || chr(9), chr(9)) THEN NULL ELSE {x} END")
_S2 = ("CASE WHEN {x} IN ('N/a', 'Unknown' || chr(9), 'Unknown', 'NULL', chr(9)) THEN NULL ELSE {x} END")


def _sentinels(x: str) -> str:
    return _S2.format(x=f"({_S1.format(x=x)})")


LITERAL = DIRTY + f""",
lit1 AS (
  SELECT id, user_id,
    TRY_CAST(trim(replace(amount, ',', '.')) AS FLOAT) AS amount,
    TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp",
    trim({initcap('city')}) AS city,
    trim(upper(regexp_replace({initcap('category')}, '\\s+', '', 'g'))) AS category
  FROM raw),
lit2 AS (
  SELECT id, user_id, amount, "timestamp",
    {_sentinels('city')} AS city, {_sentinels('category')} AS category FROM lit1),
lit3 AS (
  SELECT id, user_id, coalesce(amount, CAST(0 AS FLOAT)) AS amount, "timestamp",
    coalesce(CASE WHEN city = 'La' THEN 'Los Angeles' WHEN city = 'Sf' THEN 'San Francisco'
                  WHEN city = 'Nyc' THEN 'New York' ELSE city END, 'Unknown') AS city,
    coalesce(CASE WHEN category IN ('', ' ', chr(9)) THEN NULL ELSE category END, 'Unknown') AS category
  FROM lit2),
silver_literal AS (
  SELECT id, user_id, amount, category, "timestamp", city FROM lit3
  WHERE category IN ('Retail', 'Tech', 'Food', 'Finance', 'Unknown', 'NoName', chr(9))
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY user_id ASC NULLS FIRST, amount ASC NULLS FIRST,
      category ASC NULLS FIRST, "timestamp" ASC NULLS FIRST, city ASC NULLS FIRST) = 1)"""

USERS = """
users AS (
  SELECT CAST(c_custkey AS BIGINT) AS user_id, c_name AS name,
    CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    CAST(18 + c_custkey % 60 AS INTEGER) AS age
  FROM customer)"""

SEGMENTS = """
segments AS (
  SELECT CAST(c_custkey AS VARCHAR) AS "user",
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'VIP' WHEN 'BUILDING' THEN 'Standart'
                      WHEN 'FURNITURE' THEN 'Premium' END AS segment
  FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE'))"""

MONEY_AGGS = ("round(sum(amount), 2) AS total_amount, count(id) AS tx_count, "
              "round(avg(amount), 2) AS avg_check")


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


SQL: dict[str, str] = {}

SQL["category_report"] = with_(INTENDED) + f"""
SELECT category, {MONEY_AGGS} FROM silver GROUP BY category ORDER BY total_amount DESC"""

SQL["clean_intended"] = with_(INTENDED) + """
SELECT * FROM silver"""

SQL["clean_literal"] = with_(LITERAL) + """
SELECT * FROM silver_literal"""

SQL["dedupe_by_id"] = with_(DIRTY) + """
SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY id ORDER BY user_id ASC NULLS FIRST,
  amount ASC NULLS FIRST, category ASC NULLS FIRST, "timestamp" ASC NULLS FIRST, city ASC NULLS FIRST) = 1"""

SQL["join_gender_category"] = with_(INTENDED, USERS) + f"""
SELECT gender, category, {MONEY_AGGS}
FROM silver JOIN users USING (user_id) GROUP BY gender, category ORDER BY total_amount DESC"""

SQL["join_segment_hourly"] = with_(INTENDED, SEGMENTS) + """
SELECT CAST(hour("timestamp") AS INTEGER) AS hour_time, count(s."user") AS tx_count,
  round(sum(amount), 2) AS total_sum, round(avg(amount), 2) AS avg_value
FROM silver JOIN segments s ON CAST(silver.user_id AS VARCHAR) = s."user"
GROUP BY 1 ORDER BY 1"""

SQL["top3_per_category"] = with_(INTENDED) + """
SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY amount DESC NULLS LAST, id ASC NULLS FIRST)
  AS INTEGER) AS level
FROM silver QUALIFY level <= 3"""

# --- scalar steps ---------------------------------------------------------------

_CITY_W = f"trim({initcap('city')})"
_CAT_W = f"trim(upper(regexp_replace({initcap('category')}, '\\s+', '', 'g')))"


def _multiif(x: str) -> str:
    n = f"upper(regexp_replace(coalesce({x}, ''), '\\s+', '', 'g'))"
    return f"CASE WHEN {n} IN ('', 'N/A', 'NULL') THEN 'UNKNOWN' ELSE {n} END"


def _pick(key: str, items: list[str], salt: int) -> str:
    lst = ", ".join(f"'{x}'" for x in items)
    return f"([{lst}])[CAST((CAST({key} AS BIGINT) * 1000003 + {salt}) % {len(items)} AS INTEGER) + 1]"


SQL["parse_amount"] = with_(DIRTY) + """
SELECT id, amount AS amount_text, TRY_CAST(trim(replace(amount, ',', '.')) AS DOUBLE) AS amount,
  coalesce(TRY_CAST(trim(replace(amount, ',', '.')) AS DOUBLE), 0.0) AS amount_or_zero FROM raw"""

SQL["cast_tolerant"] = with_(DIRTY) + """
SELECT id, CAST(user_id AS VARCHAR) AS "user", TRY_CAST(amount AS DOUBLE) AS amount FROM raw"""

SQL["parse_timestamp"] = with_(DIRTY) + """
SELECT id, "timestamp" AS timestamp_text, TRY_CAST("timestamp" AS TIMESTAMP) AS ts FROM raw"""

SQL["normalize_text"] = with_(DIRTY) + f"""
SELECT id, {_CITY_W} AS city, {_CAT_W} AS category,
  upper(regexp_replace(category, '\\s+', '', 'g')) AS category_key FROM raw"""

SQL["null_sentinels"] = with_(DIRTY) + f"""
SELECT id, {_sentinels(_CITY_W)} AS city,
  CASE WHEN ({_sentinels(_CAT_W)}) IN ('', ' ', chr(9)) THEN NULL ELSE {_sentinels(_CAT_W)} END AS category
FROM raw"""

SQL["recode_city"] = with_(INTENDED) + f"""
SELECT id,
  CASE WHEN {_CITY_W} = 'La' THEN 'Los Angeles' WHEN {_CITY_W} = 'Sf' THEN 'San Francisco'
       WHEN {_CITY_W} = 'Nyc' THEN 'New York' ELSE {_CITY_W} END AS city,
  coalesce(CASE WHEN upper(c1) IN ('', 'N/A', 'NULL', 'UNKNOWN') THEN NULL
                WHEN c1 = 'La' THEN 'Los Angeles' WHEN c1 = 'Sf' THEN 'San Francisco'
                WHEN c1 = 'Nyc' THEN 'New York' ELSE c1 END, 'Unknown') AS city_intended
FROM (SELECT *, {_CITY_I} AS c1 FROM raw)"""

SQL["fill_defaults"] = with_(DIRTY) + """
SELECT id, coalesce(city, 'Unknown') AS city, coalesce(category, 'Unknown') AS category,
  coalesce(TRY_CAST(trim(replace(amount, ',', '.')) AS DOUBLE), 0.0) AS amount,
  coalesce(TRY_CAST("timestamp" AS TIMESTAMP), TIMESTAMP '1970-01-01 00:00:00') AS "timestamp"
FROM raw"""

SQL["whitelist_filter"] = with_(DIRTY) + f""",
c AS (SELECT id, coalesce(CASE WHEN ({_sentinels(_CAT_W)}) IN ('', ' ', chr(9)) THEN NULL
                            ELSE {_sentinels(_CAT_W)} END, 'Unknown') AS category FROM raw)
SELECT * FROM c WHERE category IN ('Retail', 'Tech', 'Food', 'Finance', 'Unknown', 'NoName', chr(9))"""

SQL["category_multiif"] = with_(DIRTY) + f"""
SELECT id, category AS category_text, {_multiif('category')} AS category FROM raw"""

SQL["big_amount_alerts"] = """
SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS "user", o_totalprice AS amount,
  o_orderpriority AS category FROM orders WHERE o_totalprice > 15000"""

_ENRICH = f"""
SELECT id, user_id,
  coalesce(TRY_CAST(trim(replace(CAST(amount AS VARCHAR), ',', '.')) AS DOUBLE), 0.0) AS amount,
  CASE WHEN category IS NULL OR category = '' THEN {_pick('id', ['electro', 'food', 'auto', 'beauty'], 2)}
       ELSE category END AS category,
  "timestamp", city,
  {_pick('id', ['standart', 'premium', 'vip'], 1)} AS class,
  {_pick('id', ['transfer', 'refund', 'purchase'], 3)} AS type
FROM raw"""

SQL["enrich_deterministic"] = with_(DIRTY) + _ENRICH

MSG_EVENTS = """
msg AS (SELECT event_id AS id, CAST(user_id AS VARCHAR) AS "user", value AS amount,
  epoch_us(ts) // 1000000 AS "timestamp", event_type AS category FROM events)"""

SQL["epoch_to_event_time"] = with_(MSG_EVENTS) + """
SELECT id, "timestamp", make_timestamp("timestamp" * 1000000) AS event_time FROM msg"""

# by event id: a time of 0 or none, no amount, a dirty category (NULL included)
UNTIDY = MSG_EVENTS + """,
untidy AS (SELECT id, "user", CASE WHEN id % 13 <> 0 THEN amount END AS amount,
  CASE WHEN id % 7 = 0 THEN 0 WHEN id % 11 <> 0 THEN "timestamp" END AS "timestamp",
  CASE WHEN id % 3 = 0 THEN ['retail', ' Tech ', 'FOOD' || chr(9), 'fin ance', 'Unknown', 'N/A', 'NULL', '', NULL,
                             'Retail', 'noname', 'toys'][CAST(id % 12 AS INTEGER) + 1] ELSE category END AS category
  FROM msg)"""

SQL["clock_fallback"] = with_(UNTIDY) + """
SELECT id, "timestamp", CASE WHEN coalesce("timestamp", 0) = 0 THEN TIMESTAMP '2024-02-01 00:00:00'
  ELSE make_timestamp("timestamp" * 1000000) END AS event_time FROM untidy"""

SQL["json_decode"] = """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""

# --- collapse, windows --------------------------------------------------------------

LATEST = """
acct AS (SELECT user_id AS id, CAST(user_id AS VARCHAR) AS "user", value AS amount,
  epoch_us(ts) // 3600000000 * 3600 AS "timestamp", event_type AS category, event_id AS seq FROM events),
latest AS (
  SELECT id, "user", amount, "timestamp", category, make_timestamp("timestamp" * 1000000) AS event_time
  FROM acct
  QUALIFY row_number() OVER (PARTITION BY CAST(make_timestamp("timestamp" * 1000000) AS DATE), id
                             ORDER BY "timestamp" DESC, seq DESC) = 1)"""

SQL["latest_version"] = with_(LATEST) + """
SELECT * FROM latest"""

SQL["latest_100"] = with_(LATEST) + """
SELECT * FROM latest ORDER BY event_time DESC NULLS LAST, id DESC NULLS LAST LIMIT 100"""

SQL["summing_10min"] = with_(UNTIDY) + f"""
SELECT time_bucket(INTERVAL 10 MINUTE, CASE WHEN coalesce("timestamp", 0) = 0 THEN TIMESTAMP '2024-02-01 00:00:00'
         ELSE make_timestamp("timestamp" * 1000000) END) AS timer,
  {_multiif('category')} AS category,
  CAST(sum(CAST(round_even(coalesce(amount, 0), 2) AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_sum,
  CAST(count(*) AS BIGINT) AS tx_count
FROM untidy GROUP BY 1, 2"""

SLIDING = """
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, category,
  round(sum(amount), 2) AS total_sum, count(id) AS tx_count
FROM (SELECT unnest(generate_series(date_trunc('minute', ts) - INTERVAL 9 MINUTE, date_trunc('minute', ts),
                                    INTERVAL 1 MINUTE)) AS window_start,
             event_type AS category, value AS amount, event_id AS id FROM events)
GROUP BY window_start, category"""

SQL["sliding_window_batch"] = SLIDING
SQL["flatten_window"] = SLIDING

SQL["tumbling_10min"] = """
SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS window_start,
  time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end,
  event_type AS category, round(sum(value), 2) AS total_sum, count(event_id) AS tx_count
FROM events GROUP BY 1, 2, 3"""

SQL["parquet_scan"] = """
SELECT event_id, event_type, value FROM events WHERE value > 50"""

SQL["generate_users"] = """
SELECT CAST(i AS BIGINT) AS id, 'user_' || CAST(i AS VARCHAR) AS "user", TIMESTAMP '2024-02-01 00:00:00' AS ts
FROM range((SELECT count(*) FROM customer)) t(i)"""

# --- changing tables ------------------------------------------------------------------

TARGET = """
target AS (SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_custkey AS VARCHAR) AS "user",
  o_totalprice AS amount, o_orderdate AS ts FROM orders WHERE o_orderstatus <> 'P')"""

SETTLEMENTS = """
src AS (
  SELECT CAST(l_orderkey AS BIGINT) AS id, CAST(o_custkey AS VARCHAR) AS "user",
    CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                  * (1 + CAST(l_tax AS DECIMAL(4,2)))) AS DECIMAL(18,2)) AS DOUBLE) AS amount,
    max(l_shipdate) AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, o_custkey)"""

CHANGE_LOG = """
log0 AS (
  SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_custkey AS VARCHAR) AS "user", o_totalprice AS amount,
    o_orderdate AS ts, 'insert' AS op, 1 AS version FROM orders
  UNION ALL
  SELECT CAST(l_orderkey AS BIGINT), CAST(o_custkey AS VARCHAR), CAST(CAST(net AS DECIMAL(18,2)) AS DOUBLE),
    l_shipdate, CASE WHEN drop = 1 THEN 'delete' ELSE 'update' END, CAST(l_linenumber + 1 AS INTEGER)
  FROM (SELECT l_orderkey, l_linenumber,
          sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS net,
          max(l_shipdate) AS l_shipdate,
          max(CAST(l_linestatus = 'F' AND l_discount >= 0.08 AS INTEGER)) AS drop
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_linenumber) r
  JOIN orders ON l_orderkey = o_orderkey),
log AS (SELECT *, TIMESTAMP '2024-01-01 00:00:00' + version * INTERVAL 1 HOUR AS committed_at FROM log0)"""


def _as_of(v: int, name: str) -> str:
    return f"""
{name} AS (
  SELECT id, "user", amount, ts FROM (
    SELECT * FROM log WHERE version <= {v}
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1) WHERE op <> 'delete')"""


SQL["merge_upsert"] = with_(TARGET, SETTLEMENTS) + """
SELECT t.id, t."user", CASE WHEN s.id IS NOT NULL THEN s.amount ELSE t.amount END AS amount,
  CASE WHEN s.id IS NOT NULL THEN s.ts ELSE t.ts END AS ts
FROM target t LEFT JOIN src s ON t.id = s.id
UNION ALL
SELECT s.id, s."user", s.amount, s.ts FROM src s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.id = s.id)"""

SQL["update_column"] = with_(TARGET) + """
SELECT id, "user", 0.0::DOUBLE AS amount, ts FROM target"""

SQL["version_history"] = with_(CHANGE_LOG) + """
SELECT version, max(committed_at) AS committed_at,
  CASE WHEN sum(CASE WHEN op = 'insert' THEN 1 ELSE 0 END) = count(*) THEN 'append'
       WHEN sum(CASE WHEN op = 'delete' THEN 1 ELSE 0 END) = count(*) THEN 'delete'
       ELSE 'overwrite' END AS operation,
  count(*) AS changed_rows
FROM log GROUP BY version ORDER BY committed_at DESC, version DESC LIMIT 5"""

SQL["as_of_version"] = with_(CHANGE_LOG, _as_of(4, "state")) + """
SELECT * FROM state"""

SQL["retain_last_versions"] = with_(CHANGE_LOG) + """,
kept AS (SELECT version, max(committed_at) AS committed_at FROM log GROUP BY version
         ORDER BY version DESC LIMIT 5),
cut AS (SELECT version, committed_at FROM kept ORDER BY version LIMIT 1),
base AS (
  SELECT id, "user", amount, ts FROM (
    SELECT * FROM log WHERE version <= (SELECT version FROM cut)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1) WHERE op <> 'delete')
SELECT id, "user", amount, ts, 'insert' AS op, (SELECT version FROM cut) AS version,
  (SELECT committed_at FROM cut) AS committed_at FROM base
UNION ALL
SELECT * FROM log WHERE version > (SELECT version FROM cut)"""

SQL["view_projection"] = with_(TARGET) + """
SELECT "user", amount, ts FROM target"""

SQL["append_table"] = """
SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_custkey AS VARCHAR) AS "user", o_totalprice AS amount,
  o_orderdate AS ts FROM orders"""

SQL["peek_ordered"] = with_(TARGET) + """
SELECT * FROM target ORDER BY id LIMIT 5"""

# --- messages and streams ------------------------------------------------------------

SQL["json_encode"] = """
SELECT CAST(user_id AS VARCHAR) AS key, event_id AS offset, event_id AS id, CAST(user_id AS VARCHAR) AS "user",
  value AS amount, epoch_us(ts) // 1000000 AS "timestamp", event_type AS category FROM events"""

SQL["json_quarantine"] = """
SELECT event_id AS offset, CAST(user_id AS VARCHAR) AS key FROM events WHERE event_type = 'error'"""

SQL["stream_quarantine"] = """
SELECT event_id AS offset, CASE WHEN NOT bad THEN value END AS amount, bad
FROM (SELECT *, event_type = 'error' OR event_id % 10 = 0 AS bad FROM events)"""

SQL["stream_to_silver"] = """
WITH clean AS (SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS "user",
                 CASE WHEN o_orderkey % 9 = 0 THEN -o_totalprice WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS amount,
                 epoch_us(o_orderdate) // 1000000 AS "timestamp", o_orderpriority AS category FROM orders)
SELECT 'silver' AS sink, * FROM clean WHERE amount > 0
UNION ALL SELECT 'alerts', NULL, "user", amount, NULL, category FROM clean WHERE amount > 10000"""

SQL["stream_alerts"] = """
SELECT CAST(o_custkey AS VARCHAR) AS "user", o_totalprice AS amount, o_orderpriority AS category
FROM orders WHERE o_totalprice > 10000"""

SQL["sliding_window_stream"] = """
WITH e AS (SELECT event_id AS id, event_type AS category, value AS amount,
                  make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS t FROM events),
w AS (
  SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, category,
    round(sum(amount), 2) AS total_sum, count(id) AS tx_count
  FROM (SELECT unnest(generate_series(date_trunc('minute', t) - INTERVAL 9 MINUTE, date_trunc('minute', t),
                                      INTERVAL 1 MINUTE)) AS window_start, category, amount, id FROM e)
  GROUP BY window_start, category)
SELECT * FROM w WHERE window_end <= (SELECT max(t) FROM e) - INTERVAL 15 MINUTE"""

SQL["incremental_summing"] = SQL["summing_10min"]
SQL["incremental_latest"] = SQL["latest_version"]

# --- files and layout ---------------------------------------------------------------

SQL["silver_roundtrip"] = SQL["clean_intended"]
SQL["compact"] = SQL["clean_intended"]

SQL["partition_profile"] = with_(TARGET) + """
SELECT strftime(ts, '%Y%m') AS month, CAST(ts AS DATE) AS dt, count(*) AS rows FROM target GROUP BY 1, 2"""

SQL["day_bucket_layout"] = """
SELECT CAST(ts AS DATE) AS dt, count(*) AS rows, count(DISTINCT user_id) AS users, 0::BIGINT AS strays
FROM events GROUP BY 1"""

SQL["describe_table"] = """
SELECT * FROM (VALUES ('id', 'bigint'), ('user', 'string'), ('amount', 'double'), ('ts', 'timestamp_ntz'))
  AS t(col_name, data_type)"""

SQL["file_report"] = with_(TARGET) + """
SELECT strftime(ts, '%Y%m') AS month, count(*) AS record_count, 0 AS empty_files FROM target GROUP BY 1"""

SQL["orphan_files"] = """
SELECT o_orderpriority AS priority, count(*) AS orphan_rows FROM orders WHERE o_orderstatus = 'P' GROUP BY 1"""

SQL["archive_by_day"] = with_(INTENDED) + """
SELECT *, DATE '2024-01-31' AS archive_date FROM silver"""

# an empty cell reads back as NULL (CSV has one spelling for both)
SQL["csv_declared"] = with_(DIRTY) + """
SELECT id, user_id, NULLIF(amount, '') AS amount, NULLIF(category, '') AS category,
  NULLIF("timestamp", '') AS "timestamp", NULLIF(city, '') AS city FROM raw"""
SQL["csv_inferred"] = SQL["csv_declared"]

SQL["as_of_bucketed"] = SQL["as_of_version"]
SQL["stream_restart"] = SQL["sliding_window_stream"]

# STR3: the newer half (epoch second >= the middle of the range) arrives first; a pair
# (older row, window) still counts when the window ends after that half's watermark
SQL["stream_late_rows"] = """
WITH ev AS (SELECT event_id, ts, event_type, value, CAST(floor(epoch(ts)) AS BIGINT) AS e FROM events),
cut AS (SELECT CAST(floor((min(e) + max(e)) / 2) AS BIGINT) AS c FROM ev),
wm AS (SELECT make_timestamp(max(e) * 1000000) - INTERVAL 15 MINUTE AS w FROM ev, cut WHERE e >= c),
pairs AS (
  SELECT unnest(generate_series(date_trunc('minute', ts) - INTERVAL 9 MINUTE, date_trunc('minute', ts),
                                INTERVAL 1 MINUTE)) AS window_start,
         event_type AS category, value AS amount, event_id AS id, e
  FROM ev)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, category,
  round(sum(amount), 2) AS total_sum, count(id) AS tx_count
FROM pairs, cut, wm
WHERE e >= c OR window_start + INTERVAL 10 MINUTE > w
GROUP BY window_start, category, w
HAVING window_start + INTERVAL 10 MINUTE <= w"""

# --- versions of file sets: rows, and what must hold of the files whatever their number ------------------

RECENT = """
cut AS (SELECT max(o_orderdate) - INTERVAL 90 DAY AS c FROM orders),
recent AS (SELECT src.* FROM src JOIN orders ON id = o_orderkey WHERE o_orderdate > (SELECT c FROM cut))"""

SQL["merge_files"] = with_(TARGET, SETTLEMENTS, RECENT) + """,
old AS (SELECT strftime(t.ts, '%Y%m') AS month, bool_and(r.id IS NULL) AS month_kept
        FROM target t LEFT JOIN recent r ON t.id = r.id GROUP BY 1),
merged AS (
  SELECT t.id, t."user", CASE WHEN r.id IS NOT NULL THEN r.amount ELSE t.amount END AS amount,
    CASE WHEN r.id IS NOT NULL THEN r.ts ELSE t.ts END AS ts
  FROM target t LEFT JOIN recent r ON t.id = r.id
  UNION ALL
  SELECT r.id, r."user", r.amount, r.ts FROM recent r WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.id = r.id))
SELECT m.*, strftime(m.ts, '%Y%m') AS month, month_kept FROM merged m LEFT JOIN old ON strftime(m.ts, '%Y%m') = month"""

SQL["update_files"] = with_(TARGET) + """,
cut AS (SELECT max(o_orderdate) - INTERVAL 90 DAY AS c FROM orders)
SELECT id, "user", CASE WHEN ts > c THEN 0.0 ELSE amount END AS amount, ts, strftime(ts, '%Y%m') AS month,
  bool_and(ts <= c) OVER (PARTITION BY strftime(ts, '%Y%m')) AS month_kept
FROM target, cut"""

SQL["compact_files"] = """
SELECT strftime(o_orderdate, '%Y%m') AS month, count(*) AS rows,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount, true AS few_files, true AS large_kept
FROM orders GROUP BY 1"""

SQL["expire_files"] = with_(CHANGE_LOG, *[_as_of(v, f"state{v}") for v in (1, 2, 3, 4)]) + """,
states AS (SELECT 1 AS version, * FROM state1 UNION ALL SELECT 2, * FROM state2
           UNION ALL SELECT 3, * FROM state3 UNION ALL SELECT 4, * FROM state4),
moved AS (SELECT s.version, s.id, strftime(s.ts, '%Y%m') AS month, amount,
            EXISTS (SELECT 1 FROM log l WHERE l.id = s.id AND l.version > s.version AND l.version <= 3) AS changed FROM states s)
SELECT version, month, count(*) AS rows, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount,
  bool_and(NOT changed) AS all_needed
FROM moved GROUP BY version, month"""

SQL["archive_files"] = """
WITH lines AS (SELECT strftime(o_orderdate, '%Y%m') AS month, o_orderkey,
                 concat_ws('|', o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2))) || chr(10) AS line FROM orders)
SELECT month, CAST(sum(strlen(line)) AS BIGINT) AS length, sha256(string_agg(line, '' ORDER BY o_orderkey)) AS sha256
FROM lines GROUP BY month"""

# --- layouts, defaults, views, one decode for several schemas, metrics, state and late rows ---------------

SQL["join_pruned"] = with_(TARGET) + """
SELECT strftime(ts, '%Y%m') AS month, count(*) AS rows, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS turnover
FROM target WHERE quarter(ts) = 4 GROUP BY 1"""

SQL["insert_defaults"] = """
SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS "user", o_totalprice AS amount,
  CAST(floor(epoch(o_orderdate)) AS BIGINT) AS "timestamp", o_orderpriority AS category FROM orders
UNION ALL
SELECT event_id, CAST(user_id AS VARCHAR), 0.0, CAST(floor(epoch(ts)) AS BIGINT), '' FROM events"""

SQL["persistent_view"] = with_(TARGET) + """
SELECT 'before' AS phase, "user", amount, ts FROM target
UNION ALL SELECT 'after', "user", 0.0, ts FROM target"""

SQL["variant_decode"] = """
SELECT event_id AS "offset", event_id AS id, CAST(user_id AS VARCHAR) AS "user", value AS amount,
  CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp", event_type AS category,
  CAST(CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS INTEGER) AS extra_fields, false AS broken
FROM events"""

SQL["variant_unknown"] = """
SELECT field, type, rows FROM (
  SELECT 'class' AS field, 'STRING' AS type, count(*) AS rows FROM events WHERE event_id % 3 = 1
  UNION ALL SELECT 'type', 'STRING', count(*) FROM events WHERE event_id % 3 = 1
  UNION ALL SELECT 'props', CASE WHEN json_extract(props, '$.k') IS NULL THEN 'OBJECT<>' ELSE 'OBJECT<k: BIGINT>' END, count(*)
            FROM events WHERE event_id % 3 = 2 GROUP BY 2) WHERE rows > 0"""

SQL["stream_metrics"] = """
SELECT count(*) AS rows, count(*) FILTER (WHERE bad) AS broken, count(*) FILTER (WHERE NOT bad AND o_totalprice > 10000) AS large,
  count(*) FILTER (WHERE NOT bad) AS good_written, count(*) FILTER (WHERE bad) AS bad_written
FROM (SELECT *, starts_with(o_orderpriority, '2') AS bad FROM orders)"""

SQL["stream_held_windows"] = f"""
SELECT *, window_end > (SELECT max(ts) - INTERVAL 15 MINUTE FROM events) AS held FROM ({SLIDING})"""

SQL["stream_late_split"] = """
WITH ev AS (SELECT event_id, value, CAST(floor(epoch(ts)) AS BIGINT) AS e FROM events),
cut AS (SELECT CAST(floor((min(e) + max(e)) / 2) AS BIGINT) AS c FROM ev),
wm AS (SELECT max(e) - 900 AS w FROM ev, cut WHERE e >= c)
SELECT event_id AS id, value AS amount, make_timestamp(e * 1000000) AS event_time,
  CASE WHEN e < c AND (e // 600) * 600 + 600 <= w THEN make_timestamp(w * 1000000) END AS watermark
FROM ev, cut, wm"""

SQL["profile_table"] = with_(DIRTY) + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{kind}' AS "type", count(*) AS rows, count(*) - count("{c}") AS nulls,
  CAST(min("{c}") AS VARCHAR) AS least, CAST(max("{c}") AS VARCHAR) AS greatest FROM raw"""
    for c, kind in (("id", "bigint"), ("user_id", "bigint"), ("amount", "string"), ("category", "string"),
                    ("timestamp", "string"), ("city", "string")))

SQL["rollback_files"] = with_(TARGET) + """
SELECT id, "user", amount, ts, strftime(ts, '%Y%m') AS month, true AS month_kept FROM target"""
