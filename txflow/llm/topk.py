"""Exact top-k inner products by a three-phase uniform threshold.

A vector's components are dealt to m lists (slices of the dimensions), which are stored and read apart; a score is the
sum of the m local scores. 1: every list gives its k best local entries of each query; the whole scores of these few
give a value t that at least k vectors reach. 2: if all m local scores were under t / m the whole score would be
under t, so t / m is a safe cutoff: it goes out with the queries, and every list sends the entries that reach it.
A block of a list whose longest slice can't reach the cutoff of a query isn't multiplied with it. 3: only what some
list sent is resolved to whole scores; each pair of blocks hands on a query's k best of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txflow.llm.common import saved, shuffle_width, small_batches

VECTORS_IN_BLOCK = 2048
QUERIES_IN_BLOCK = 512
BLOCKS_TOGETHER = 16          # of vectors, that a copy of the queries is read for: 16 MB of 64 components
RESOLVED_AT_ONCE = 1 << 16
LIST = "b int, list int, ids array<long>, values array<long>, norm double"


def quantised(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, or null for a vector that is null or has a null or non-finite one. A component
    that passes 2^62 then is an error."""
    whole = F.coalesce(F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))),
                       F.lit(False))
    fits = F.forall(embedding, lambda x: F.abs(F.lit(float(scale)) * x.cast("double")) < F.lit(float(1 << 62)))
    held = F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return F.when(whole, F.when(fits, held).otherwise(F.raise_error(F.lit("a component is too large for 64 bits")).cast("array<long>")))


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """A row for each vector, zeros behind a shorter one."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), dims), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two in a type in which every sum of their products is exact."""
    most = max(1, int(np.abs(a).max(initial=0))) * max(1, int(np.abs(b).max(initial=0))) * max(1, a.shape[1])
    kind = np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object
    return a.astype(kind), b.astype(kind)


def _lists(rows: DataFrame, n: int, dims: int, lists: int) -> DataFrame:
    """Blocks of each list (b, list, ids, values, norm of the longest slice); list -1 has the whole vectors. The rows
    (id, vec) are dealt evenly to n blocks, whatever their ids, and stand by id in them."""
    edges = [dims * j // lists for j in range(lists + 1)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = rows.values.field("id").to_numpy(zero_copy_only=False)
                whole = _matrix(rows.values.field("vec"), dims)
                for j, part in [(-1, whole), *enumerate(whole[:, x:y] for x, y in zip(edges, edges[1:]))]:
                    norm = float(np.sqrt((part.astype(np.float64) ** 2).sum(1)).max(initial=0.0))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b], pa.int32()), pa.array([j], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                         pa.array([part.ravel()], pa.list_(pa.int64())), pa.array([norm])], names=["b", "list", "ids", "values", "norm"])

    dealt = rows.withColumn("b", F.pmod(F.monotonically_increasing_id(), F.lit(n)).cast("int"))
    return dealt.groupBy("b").agg(F.array_sort(F.collect_list(F.struct("id", "vec"))).alias("rows")).mapInArrow(cut, LIST)


def _read(ids, values) -> tuple[np.ndarray, np.ndarray]:
    ids = ids.values.to_numpy(zero_copy_only=False)
    return ids, values.values.to_numpy(zero_copy_only=False).reshape(len(ids), -1)


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(list, queries, vectors, more) of every block of queries with the blocks of vectors that stand before it in its
    part of ``_met``, or with those that something was sent for; a block is (b, ids, values, norm). ``more`` has the cutoffs, or what was
    sent."""
    current, vectors, queries = None, {}, None
    for batch in batches:
        for j, part, q, v, ids, values, norm, cutoff, sent in zip(*batch.columns):
            at, q, v = (j.as_py(), part.as_py()), q.as_py(), v.as_py()
            if at != current:
                current, vectors, queries = at, {}, None
            if sent.is_valid:
                yield j.as_py(), queries, vectors[v], sent
            elif q < 0:
                vectors[v] = v, *_read(ids, values), norm.as_py()
            else:
                queries, cutoff = (q, *_read(ids, values), norm.as_py()), cutoff.as_py()
                if j.as_py() >= 0:
                    for block in vectors.values():
                        yield j.as_py(), queries, block, cutoff


def _best(q_ids: np.ndarray, q_at: np.ndarray, v_at: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of each query (q_at sorted), ties to the smaller place among its own."""
    order = np.lexsort((v_at, [-s for s in scores.tolist()] if scores.dtype == object else -scores, q_at))
    first = np.searchsorted(q_at[order], np.arange(len(q_ids)))
    rank = np.arange(len(order)) - first[q_at[order]]
    return order[rank < k]


def _local_best(k: int):
    """Phase 1: the k best local entries (query, vector, its place) of each query in a block of a list."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for j, queries, vectors, _ in _meetings(batches):
            (_, q_ids, q, _), (v_block, v_ids, v, _) = queries, vectors
            a, b = _exact(q, v)
            local = a @ b.T
            found: list[list] = [[], [], []]
            for i in range(len(q_ids)):
                at = np.flatnonzero(v_ids != q_ids[i])
                if len(at) > k:
                    kth = np.partition(local[i, at], len(at) - k)[len(at) - k]
                    at = at[local[i, at] >= kth]
                    at = at[np.argsort(-local[i, at], kind="stable")[:k]]
                found[0].append(np.full(len(at), q_ids[i]))
                found[1].append(at)
                found[2] += [int(x) for x in local[i, at]]
            q_at, at = np.concatenate(found[0]), np.concatenate(found[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(q_at, pa.int64()), pa.array([j] * len(at), pa.int32()), pa.array([v_block] * len(at), pa.int32()),
                 pa.array(at, pa.int32()), pa.array(v_ids[at], pa.int64()), pa.array([float(x) for x in found[2]], pa.float64())],
                names=["query_id", "list", "v", "at", "vec_id", "local"])

    return scan


def _reaching(m: int):
    """Phase 2: the pairs of a block of queries and a block of a list whose local score reaches the query's cutoff."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, queries, vectors, cutoff in _meetings(batches):
            (q_block, q_ids, q, _), (v_block, v_ids, v, longest) = queries, vectors
            least = np.array([-np.inf if c is None else float(c) for c in cutoff])
            # Cauchy-Schwarz, with room for rounding
            bound = m * np.sqrt((q.astype(np.float64) ** 2).sum(1)) * longest
            asked = np.flatnonzero(bound * (1 + 1e-9) + 1 >= least)
            if not len(asked):
                continue
            a, b = _exact(q[asked], v)
            local = a @ b.T
            exact = np.array([-(1 << 200) if cutoff[i] is None else int(cutoff[i]) for i in asked], dtype=object)
            if local.dtype != object:
                # local * m >= cutoff in whole numbers: local >= ceil(cutoff / m), held within the type
                exact = np.array([max(-(1 << 62), min(1 << 62, -(-c // m))) for c in exact]).astype(local.dtype)
                reach = local >= exact[:, None]
            else:
                reach = local * m >= exact[:, None]
            i, at = np.nonzero((reach & (q_ids[asked][:, None] != v_ids[None, :])).astype(bool))
            if len(i):
                pairs = asked[i].astype(np.int64) << 32 | at
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q_block], pa.int32()), pa.array([v_block], pa.int32()), pa.array([pairs], pa.list_(pa.int64()))],
                    names=["q", "v", "pairs"])

    return scan


def _resolved(k: int):
    """Phase 3: whole scores of the pairs that some list sent, the k best of each query."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, queries, vectors, sent in _meetings(batches):
            (_, q_ids, q, _), (_, v_ids, v, _) = queries, vectors
            pairs = np.unique(np.concatenate([x.values.to_numpy(zero_copy_only=False) for x in sent.values]))
            q_at, v_at = pairs >> 32, pairs & (1 << 32) - 1
            a, b = _exact(q, v)
            scores = [(a[q_at[x:x + RESOLVED_AT_ONCE]] * b[v_at[x:x + RESOLVED_AT_ONCE]]).sum(1)
                      for x in range(0, len(pairs), RESOLVED_AT_ONCE)]
            scores = np.concatenate(scores)
            best = _best(q_ids, q_at, v_at, scores, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q_ids[q_at[best]], pa.int64()), pa.array(v_ids[v_at[best]], pa.int64()),
                 pa.array([int(x) for x in scores[best]], pa.int64())], names=["query_id", "vec_id", "score"])

    return scan


def _whole_score(a: str, b: str) -> Column:
    """The inner product of two arrays of longs of any size, exactly; components that one lacks are zeros."""
    products = F.zip_with(a, b, lambda x, y: F.coalesce(x, F.lit(0)).cast("decimal(19,0)") * F.coalesce(y, F.lit(0)).cast("decimal(19,0)"))
    return F.aggregate(products, F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + x).cast("decimal(38,0)"))


def _prepared(vectors: DataFrame, queries: DataFrame, id_col: str, vec_col: str, lists: int) -> tuple | None:
    def usable(df: DataFrame) -> DataFrame:
        return (df.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vec_col)).alias("vec"))
                .filter("id is not null and vec is not null"))

    rows = usable(vectors)
    n, dims = rows.agg(F.count("*"), F.max(F.size("vec"))).first()
    asked = saved(usable(queries).groupBy("id").agg(F.min("vec").alias("vec")), "topk-queries")
    n_queries, q_dims = asked.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not n or not n_queries:
        return None
    dims = max(1, dims, q_dims)
    lists = max(1, min(lists, dims))
    v_lists = saved(_lists(rows, -(-n // VECTORS_IN_BLOCK), dims, lists), "topk-lists")
    q_lists = saved(_lists(asked, -(-n_queries // QUERIES_IN_BLOCK), dims, lists), "topk-query-lists")
    return v_lists, q_lists, -(-n // VECTORS_IN_BLOCK), lists, dims


def _met(q_lists: DataFrame, v_lists: DataFrame, n_blocks: int, sent: DataFrame | None = None) -> DataFrame:
    """The rows that ``_meetings`` reads: list by list, in every part some blocks of vectors and then all blocks of queries;
    with ``sent`` those of whole vectors, and behind a block of queries what was sent for it.

    A block of queries is copied for each part, and no side is joined: Spark's estimates count an array as one number
    and a row that is exploded as one row, so that a join would broadcast all copies, through the driver."""
    together = max(1, min(BLOCKS_TOGETHER, n_blocks // (2 * shuffle_width(v_lists.sparkSession))))
    lists = F.col("list") >= 0 if sent is None else F.col("list") < 0
    part_of = F.floor(F.col("v") / together).cast("int")
    lacking, strings, arrays = F.lit(-1), F.lit(None).cast("array<string>"), F.lit(None).cast("array<array<bigint>>")
    vectors = v_lists.filter(lists).withColumnRenamed("b", "v").select(
        "list", part_of.alias("part"), lacking.alias("q"), "v", "ids", "values", "norm", strings.alias("cutoff"), arrays.alias("sent"))
    queries = q_lists.filter(lists).select(
        "list", F.explode(F.sequence(F.lit(0), F.lit((n_blocks - 1) // together))).alias("part"), F.col("b").alias("q"),
        lacking.alias("v"), "ids", "values", "norm", "cutoff" if "cutoff" in q_lists.columns else strings.alias("cutoff"), arrays.alias("sent"))
    rows = vectors.unionByName(queries)
    if sent is not None:
        longs = F.lit(None).cast("array<bigint>")
        rows = rows.unionByName(sent.select(
            lacking.alias("list"), part_of.alias("part"), "q", "v", longs.alias("ids"), longs.alias("values"),
            F.lit(None).cast("double").alias("norm"), strings.alias("cutoff"), "sent"))
    return rows.repartition("list", "part").sortWithinPartitions("list", "part", "q", "v").select(vectors.columns)


def cutoffs(v_lists: DataFrame, q_lists: DataFrame, n_blocks: int, lists: int, dims: int, k: int) -> DataFrame:
    """query_id, cutoff: a whole score that k vectors reach; none for a query with fewer candidates."""
    first = _met(q_lists, v_lists, n_blocks).mapInArrow(
        _local_best(k), "query_id long, list int, v int, at int, vec_id long, local double")
    by_list = Window.partitionBy("query_id", "list").orderBy(F.desc("local"), "vec_id", "v", "at")
    held = first.withColumn("r", F.row_number().over(by_list)).filter(F.col("r") <= k).select("query_id", "v", "at").distinct()

    def one(table: DataFrame, block: str, place: str, name: str) -> DataFrame:
        """The whole vectors by block and place: at most k for each list and query are looked up."""
        return (table.filter("list = -1").select(F.col("b").alias(block), F.posexplode("ids").alias(place, f"{name}_id"), "values")
                .select(block, place, f"{name}_id", F.slice("values", F.col(place) * dims + 1, dims).alias(name)))

    found = held.join(one(v_lists, "v", "at", "vec").hint("merge"), ["v", "at"]).join(
        one(q_lists, "qb", "q_at", "query").select("query_id", "query").hint("merge"), "query_id")
    scored = found.select("query_id", "v", "at", _whole_score("vec", "query").alias("score"))
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "v", "at")
    return (scored.withColumn("r", F.row_number().over(by_query)).filter(F.col("r") == k)
            .select("query_id", F.col("score").alias("cutoff")))


def survivors(v_lists: DataFrame, q_lists: DataFrame, n_blocks: int, lists: int, reached: DataFrame) -> DataFrame:
    """q, v, sent: the pairs of two blocks that some list sends under the cutoffs, a number for each pair; a pair that
    several lists send is in several of the arrays."""
    own = (q_lists.filter("list = -1").select("b", F.posexplode("ids").alias("at", "query_id")).join(reached, "query_id", "left")
           .groupBy("b").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", F.col("cutoff").cast("string").alias("c")))),
                                         lambda x: x["c"]).alias("cutoff")))
    cut = q_lists.join(saved(own, "topk-cutoffs").hint("merge"), "b")
    sent = _met(cut, v_lists, n_blocks).mapInArrow(_reaching(lists), "q int, v int, pairs array<long>")
    return sent.groupBy("q", "v").agg(F.collect_list("pairs").alias("sent"))


def top_k(vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding",
          k: int = 5, lists: int = 2) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query, ties to the smaller id.

    Rows take no part when the id is null or the vector null or holding a null or non-finite component; an
    empty vector counts as zeros, as do components that a shorter one lacks. A query's own id is no candidate.
    Candidates that repeat an id are ranked row by row; of queries that repeat an id the smallest vector counts.
    Fewer than k candidates: all of them. Empty tables: no rows. Scores are exact whatever their size; one that does
    not fit 64 bits is an error. Other columns are not read.

    Vectors are shuffled once into even blocks, a list of a block of queries is copied to each BLOCKS_TOGETHER blocks of that
    list; a pair of blocks hands on at most k rows a query and list, and pairs that reach the cutoff as one number
    each. No side is collected or broadcast.
    """
    with small_batches(vectors.sparkSession):
        return _top_k(vectors, queries, id_col, vec_col, k, lists)


def _top_k(vectors: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int, lists: int) -> DataFrame:
    ready = _prepared(vectors, queries, id_col, vec_col, lists)
    if ready is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    v_lists, q_lists, n_blocks, lists, dims = ready
    reached = cutoffs(v_lists, q_lists, n_blocks, lists, dims, k)
    sent = saved(survivors(v_lists, q_lists, n_blocks, lists, reached), "topk-survivors")
    best = _met(q_lists, v_lists, n_blocks, sent).mapInArrow(_resolved(k), "query_id long, vec_id long, score long")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return saved(best.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"), "topk-results")
