"""SimHash near-duplicates by multi-index hashing.

The 64 bits are cut into segments. Two fingerprints that differ in at most ``r`` bits are close in
some segment (pigeonhole: r = m * q + rest, so one of the first rest + 1 segments differs in at most
q bits or one of the others in at most q - 1). Each segment value in use is a bucket; the small
Hamming ball around it is enumerated, the buckets met are fetched, and whole distances are checked.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import saved
from txflow.llm.components import connected_components

BLOCK = 512              # fingerprints of one bucket that are compared in one row
HASHED_AT_ONCE = 1 << 16
WIDE_FROM = 1 << 26      # distinct fingerprints from which two segments are used instead of three


def fingerprint(text: bytes, words: int) -> int:
    """Majority bits of the XXH64 (seed 42) of every ``words``-word shingle, repeats included.

    Words are split at ASCII white space, A-Z is lowered. Fewer words: one shingle; none: zero.
    """
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    set_bits = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, HASHED_AT_ONCE):
        hashes = np.array([digest(joined[s:e], 42) for s, e in
                           zip(starts[at:at + HASHED_AT_ONCE], ends[at:at + HASHED_AT_ONCE])], dtype="<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, words: int) -> Column:
    """The fingerprint of a text as a signed 64-bit integer."""
    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t or b"", words) for t in texts], dtype=np.uint64).view(np.int64))

    return hashed(text.cast("binary"))


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, fp): one row per row."""
    return docs.select(F.col(id_col).alias("id"), fingerprints(F.col(text_col), words).alias("fp"))


def _segments(m: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of m segments that cover 64 bits, the wider first."""
    widths = [64 // m + (i < 64 % m) for i in range(m)]
    return [(sum(widths[i + 1:]), w) for i, w in enumerate(widths)]


def _masks(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in bits) for r in range(1, radius + 1) for bits in combinations(range(width), r)]


def forest(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``values``: as many components, at most len - 1 edges."""
    left, edges = np.ones(len(values), dtype=bool), []
    for first in range(len(values)):
        if not left[first]:
            continue
        left[first], todo = False, [first]
        while todo:
            at = todo.pop()
            near = np.nonzero(left & (np.bitwise_count(values ^ values[at]) <= max_bits))[0]
            left[near] = False
            todo += near.tolist()
            edges += [(int(values[at].view(np.int64)), int(v)) for v in values[near].view(np.int64)]
    return edges


def links(fps: DataFrame, max_bits: int, segments: int | None = None) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) whose components are those of all links.

    Buckets and not fingerprints meet in the join. A bucket of many fingerprints is split into blocks of
    about BLOCK, and a pair of blocks gives a spanning forest instead of all its pairs. Three segments, or
    two from WIDE_FROM fingerprints on so that buckets stay small: both are exact.
    """
    if segments is None:
        segments = 3 if fps.count() < WIDE_FROM else 2
    rows = None
    for s, (low, width) in enumerate(_segments(segments)):
        key = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        part = fps.select(F.lit(s).alias("s"), key.alias("key"), "fp")
        rows = part if rows is None else rows.unionByName(part)
    crowded = rows.groupBy("s", "key").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK)
    crowded = crowded.select(F.col("s").alias("c_s"), F.col("key").alias("c_key"), F.ceil(F.col("n") / BLOCK).alias("k"))
    blocks = (rows.join(crowded, (F.col("s") == F.col("c_s")) & (F.col("key") == F.col("c_key")), "left")
              .withColumn("k", F.coalesce("k", F.lit(1)))
              .withColumn("block", F.pmod(F.xxhash64("fp"), "k"))
              .groupBy("s", "key", "k", "block").agg(F.collect_list("fp").alias("fps")))
    blocks = saved(blocks, "simhash-blocks")
    within = blocks.filter(F.size("fps") > 1).select("fps")

    radius, extra = divmod(max_bits, segments)
    to = F.lit(None)
    for s, (_, width) in enumerate(_segments(segments)):
        r = radius if s <= extra else radius - 1
        # only upward, so that a pair of buckets meets once; 0: the blocks of a split bucket meet each other
        probes = [0, *(_masks(width, r) if r > 0 else [])]
        keys = F.array(*[F.col("key").bitwiseXOR(F.lit(m).cast("long")) for m in probes])
        to = F.when(F.col("s") == s, F.filter(
            keys, lambda k: (k > F.col("key")) | ((k == F.col("key")) & (F.col("k") > 1)))).otherwise(to)
    probing = blocks.select("s", "key", "block", "fps", F.explode(to).alias("to"))
    fetched = blocks.select(*[F.col(c).alias(f"o_{c}") for c in ("s", "key", "block", "fps")])
    across = (probing.join(fetched, (F.col("s") == F.col("o_s")) & (F.col("to") == F.col("o_key"))
                           & ((F.col("key") < F.col("o_key")) | (F.col("block") < F.col("o_block"))))
              .select(F.concat("fps", "o_fps").alias("fps")))
    met = within.unionByName(across).filter(
        (F.size("fps") > 2) | (F.bit_count(F.col("fps")[0].bitwiseXOR(F.col("fps")[1])) <= max_bits))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [e for fps in batch["fps"] for e in forest(np.asarray(fps, dtype=np.int64).view(np.uint64), max_bits)]
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return met.mapInPandas(verify, "a long, b long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                    max_bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: id, fp (signed), fingerprint (16 hex digits), root, component_id.

    ``component_id`` is the smallest id that links reach, the row's own included; ``root`` a fingerprint of
    the component. Null and empty texts have fingerprint zero and link like any other. A null id takes its
    component's smallest id, null if there is none. Repeated rows stay rows of one component. An empty table
    gives no rows; other columns are not read. Equal fingerprints are one node of the graph, so a group of
    copies, however large, is one aggregated row before anything is joined.
    """
    rows = saved(with_fingerprints(docs, id_col, text_col, words), "simhash-fingerprints")
    nodes = saved(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    comps = connected_components(links(nodes.select("fp"), max_bits), "simhash-components")
    joined = nodes.join(comps, nodes["fp"] == comps["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = joined.select("fp", "root").join(least, "root").select(
        F.col("fp").alias("n_fp"), "root", "component_id", F.xxhash64("fp").alias("h"))
    # joined on a hash as well, so that both sides are dealt by the join itself and a hot fingerprint is split
    out = rows.withColumn("r_h", F.xxhash64("fp")).join(
        of_fp, (F.col("r_h") == F.col("h")) & (F.col("fp") == F.col("n_fp")))
    return out.select(F.col("id").alias(id_col), "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "root", "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
             max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each component: the one whose id is the component's smallest.

    Rows without an id stay only in a component that has no id at all. What a row is a copy of is decided by its own
    text: an id that stands on several texts may stay once in each of their components. Where several rows of a
    component have its id, the one whose columns have the lowest hash stays. Columns and their order are those of
    ``docs``.

    A row with an id of its own is decided by the id; only rows whose id repeats or is null are told apart by their
    fingerprints.
    """
    found = saved(near_duplicates(docs, id_col=id_col, text_col=text_col, words=words, max_bits=max_bits),
                  "simhash-members").select(F.col(id_col).alias("__member"), "fp", "root", "component_id")
    per_id = (found.filter("__member is not null").groupBy("__member")
              .agg(F.count("*").alias("n"), F.bool_or(F.col("__member") == F.col("component_id")).alias("first")))
    apart = per_id.filter("n > 1")
    out = docs.filter(F.col(id_col).isNotNull()).join(
        per_id.filter("not first or n > 1").select("__member"), F.col(id_col) == F.col("__member"), "left_anti")
    several = docs.filter(F.col(id_col).isNull())
    if not apart.isEmpty():
        several = several.unionByName(docs.join(apart.select("__member"), F.col(id_col) == F.col("__member"), "left_semi"))
    if several.isEmpty():
        return out
    staying = (found.filter(F.col("__member").eqNullSafe(F.col("component_id"))).select("__member", "fp", "root").distinct()
               .select(F.col("__member").alias("__id"), F.col("fp").alias("__fp"), F.col("root").alias("__root")))
    rows = several.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(id_col).alias("__own"),
                          fingerprints(F.col(text_col), words).alias("__print"))
    held = (rows.join(staying, F.col("__own").eqNullSafe(F.col("__id")) & (F.col("__print") == F.col("__fp")))
            .groupBy("__root").agg(F.min_by("__row", F.xxhash64("__row")).alias("__row")))
    return out.unionByName(held.select("__row.*"))
