"""URL rules as a sort-merge range join.

A rule (host, path) fits the host and its subdomains when the url's path starts with the
rule's. Written with the host's labels reversed, ``net/es/`` or ``com.example.www/en/``, a
rule is a prefix and so an interval of the sorted keys. A url takes one key for each
ancestor of its host (``com/..``, ``com.example/..``): a key lies in a rule's interval exactly
when the rule fits. Keys and rules are dealt to ranges of the key order, sorted, and swept
once; a stack holds the nested rules that are open, so the top is the longest that fits.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.llm.common import ascii_lower, shuffle_width, text_of

SAMPLED_PER_RANGE = 32   # keys looked at to place one boundary


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to / ? # with A-Z lowered, path up to ? or #.

    A null url and one without ``://`` have both empty.
    """
    url = text_of(url)
    after = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"^(?s:.*?)://", "")).otherwise("")
    return (ascii_lower(F.regexp_extract(after, r"^([^/?#]*)", 1)),
            F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1))


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) triples as a frame for ``judge_urls``."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _bounds(keys: DataFrame, n: int) -> list[tuple[str, str]]:
    """At most n - 1 boundaries from the n * SAMPLED_PER_RANGE keys of lowest hash: bounded, and the
    same on every run. They only balance the ranges; no row depends on them."""
    sample = (keys.select("key", "host", F.xxhash64("key", "host", "head").alias("h"))
              .orderBy("h").limit(n * SAMPLED_PER_RANGE).collect())
    ordered = sorted((r["key"], r["host"]) for r in sample)
    step = max(1, -(-len(ordered) // n))
    return ordered[step::step]


def _ranges_udf(bounds: list[tuple[str, str]]):
    @F.pandas_udf("array<int>")
    def ranges(key: pd.Series, host: pd.Series, rule: pd.Series) -> pd.Series:
        out = []
        for k, h, r in zip(key, host, rule):
            lo = hi = bisect_right(bounds, (k, h))
            if r is not None:   # a rule is open in every range that starts inside its interval
                lo = hi = bisect_right(bounds, (k, ""))
                while hi < len(bounds) and bounds[hi][0].startswith(k):
                    hi += 1
            out.append(list(range(lo, hi + 1)))
        return pd.Series(out)

    return ranges


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    stack: list[tuple[str, str, str, int]] = []
    at = None
    for batch in batches:
        out = []
        for part, key, host, head, rule, verdict, depth in zip(
                batch["part"], batch["key"], batch["host"], batch["head"], batch["rule"],
                batch["verdict"], batch["depth"]):
            if part != at:
                stack, at = [], part
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rule is not None:
                stack.append((key, rule, verdict, depth))
            elif stack:
                out.append((host, head, *stack[-1][1:]))
        yield pd.DataFrame(out, columns=["host", "head", "rule", "verdict", "depth"])


def judge_urls(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict.

    ``rules``: host, path, verdict. A rule needs a host and a path from ``/`` on; others (nulls, empty
    host) are left out. Of equal rules the smallest verdict counts once. The longest rule (characters
    of host + path) wins, then the longer host. Without a rule: rule null, verdict ``default``. Null or
    odd urls have empty host and path, repeated rows stay repeated, an empty table gives no rows; other
    columns of ``pages`` are not read.

    Only distinct (host, head of the path as long as the longest rule's) are swept, so a host with a
    third of all rows shrinks before the shuffle; the verdicts are joined back by equality.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rules = (rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict")
             .filter(F.col("host").isNotNull() & (F.col("host") != "") & F.col("path").startswith("/"))
             .groupBy("host", "path").agg(F.min("verdict").alias("verdict")))
    longest, deepest = rules.agg(F.max(F.length("path")), F.max(F.size(F.split("host", r"\.")))).first()
    longest, deepest = longest or 0, deepest or 0

    urls = urls.withColumn("head", F.substring("path", 1, longest))
    distinct = urls.select("host", "head").filter("host <> '' and head <> ''").distinct()
    labels = _reversed_labels(F.col("host"))
    keys = (distinct.withColumn("labels", F.slice(labels, 1, max(deepest, 1)))
            .select("host", "head", F.explode(F.transform(
                F.sequence(F.lit(1), F.size("labels")),
                lambda i: F.concat(F.array_join(F.slice("labels", F.lit(1), i), "."), F.col("head")))).alias("key")))
    no_text = F.lit(None).cast("string")
    rule_rows = rules.select(F.lit("").alias("host"), F.lit("").alias("head"),
                             F.concat(F.array_join(_reversed_labels(F.col("host")), "."), "path").alias("key"),
                             F.concat("host", "path").alias("rule"), "verdict",
                             F.length("host").alias("depth"))
    url_rows = keys.select("host", "head", "key", no_text.alias("rule"), no_text.alias("verdict"),
                           F.lit(0).alias("depth"))
    n = shuffle_width(spark)
    ranges = _ranges_udf(_bounds(keys, n))
    dealt = (rule_rows.unionByName(url_rows)
             .withColumn("part", F.explode(ranges("key", "host", "rule")))
             .repartition(n, "part")
             .sortWithinPartitions("part", "key", F.col("rule").isNull(), "host", "head"))
    hits = dealt.mapInPandas(_sweep, "host string, head string, rule string, verdict string, depth int")
    best = (hits.groupBy("host", "head")
            .agg(F.max(F.struct(F.length("rule").alias("n"), "depth", "rule", "verdict")).alias("won"))
            .select(F.col("host").alias("u_host"), F.col("head").alias("u_head"),
                    F.xxhash64("host", "head").alias("u"), "won"))
    # joined on a hash as well, so that both sides are dealt by the join itself and a hot url is split
    found = urls.withColumn("h", F.xxhash64("host", "head")).join(
        best, (F.col("h") == F.col("u")) & (F.col("host") == F.col("u_host"))
        & (F.col("head") == F.col("u_head")), "left")
    return found.select(F.col("id").alias(id_col), "host", "path", F.col("won.rule").alias("rule"),
                        F.coalesce("won.verdict", F.lit(default)).alias("verdict"))
