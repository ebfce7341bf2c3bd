"""Embedding near-duplicates by E8 lattice hashing.

A table projects the unit vectors with random directions to groups of eight numbers and takes the
nearest point of the E8 lattice in each group; the points together are the vector's cell. A vector is
filed under its own cell and probes it and the neighbouring cells that it lies closest to. Vectors that
meet in any table are compared by cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import saved
from txflow.llm.components import connected_components

BLOCK = 256   # vectors of one cell that are compared in one row


def e8_roots() -> np.ndarray:
    """The 240 shortest vectors: a lattice point's nearest neighbours."""
    rows = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            row = np.zeros(8)
            row[i], row[j] = a, b
            rows.append(row)
    rows += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(rows)


def _even_point(x: np.ndarray) -> np.ndarray:
    """Nearest integer point with an even sum: round, and turn the worst coordinate where the sum is odd."""
    near = np.rint(x)
    error = x - near
    odd = np.nonzero(near.sum(1) % 2 != 0)[0]
    worst = np.abs(error[odd]).argmax(1)
    near[odd, worst] += np.where(error[odd, worst] >= 0, 1, -1)
    return near


def e8_nearest(x: np.ndarray) -> np.ndarray:
    """E8 is the even points and the same shifted by a half in all coordinates; the nearer of the two."""
    whole, half = _even_point(x), _even_point(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


class Cells:
    """The cells of ``tables`` random lattices; column 0 of a table is the own cell, the rest its neighbours."""

    def __init__(self, dims: int, tables: int, groups: int, width: float, probes: int, seed: int):
        rng = np.random.default_rng(seed)
        self.shape, self.probes = (tables, groups), probes
        self.directions = rng.standard_normal((dims, tables * groups * 8)) / width
        self.shift = rng.uniform(0, 1, tables * groups * 8)
        self.mix = rng.integers(1, 1 << 62, (tables, groups, 8), dtype=np.int64) | 1
        self.roots = e8_roots()
        doubled = (2 * self.roots).astype(np.int64)
        self.steps = [np.concatenate([(doubled * self.mix[t, g]).sum(1) for g in range(groups)]) for t in range(tables)]

    def near(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The own cell in every table, a 64-bit mix of the doubled lattice coordinates, and the steps to the cells probed."""
        tables, groups = self.shape
        at = (unit @ self.directions + self.shift).reshape(len(unit), tables, groups, 8)
        own = np.zeros((len(unit), tables), dtype=np.int64)
        best = np.empty((len(unit), tables, self.probes), dtype=np.int16)
        for t in range(tables):
            towards = []
            for g in range(groups):
                point = e8_nearest(at[:, t, g])
                own[:, t] += ((2 * point).astype(np.int64) * self.mix[t, g]).sum(1)
                towards.append((at[:, t, g] - point) @ self.roots.T)   # the larger, the closer that neighbour
            best[:, t] = np.argsort(-np.concatenate(towards, 1), axis=1, kind="stable")[:, :self.probes]
        return own, best

    def whole(self, own: np.ndarray, best: np.ndarray) -> np.ndarray:
        """(vectors, tables, 1 + probes): the own cell and those probed."""
        out = np.empty((*own.shape, 1 + self.probes), dtype=np.int64)
        out[:, :, 0] = own
        for t, step in enumerate(self.steps):
            out[:, t, 1:] = own[:, t, None] + step[best[:, t]]
        return out

    def of(self, unit: np.ndarray) -> np.ndarray:
        return self.whole(*self.near(unit))


def _unit(flat: np.ndarray, dims: int) -> np.ndarray:
    x = flat.astype(np.float64).reshape(-1, dims)
    x = x / np.abs(x).max(1, keepdims=True)   # so that squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _unpack(rows: pa.StructArray, dims: int, cells: Cells):
    """ids, copies, unit vectors and cells of the rows of a block, from what was sent of them."""
    n, (tables, _) = len(rows), cells.shape
    own = rows.field("own").flatten().to_numpy(zero_copy_only=False).reshape(n, tables)
    best = np.frombuffer(b"".join(rows.field("best").to_pylist()), np.int16).reshape(n, tables, cells.probes)
    return (rows.field("id").to_numpy(zero_copy_only=False), rows.field("copies").to_numpy(zero_copy_only=False),
            _unit(rows.field("vec").flatten().to_numpy(zero_copy_only=False), dims), cells.whole(own, best))


def _met(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For pairs of rows: in which tables the first probes the second's own cell."""
    return (x == y[:, :, :1]).any(2)


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.95,
                 tables: int = 8, groups: int = 2, width: float = 1.6, probes: int = 8, seed: int = 8) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Null and zero vectors, empty ones, and those with a null or non-finite component link with nothing.
    A vector shorter than the longest is filled up with zeros.
    A row with a null id is compared like any other; its component takes the smallest id there is. Rows that
    repeat an id are rows of their own. Equal vectors are one class that counts its rows, so copies are never
    paired. ``n_links`` counts the other rows linked directly. Empty table: no rows; other columns are not read.

    The rows that probe a cell and those filed in it are grouped into blocks of about BLOCK; a pair of blocks
    gives counts and a spanning forest, never its pairs. A pair is counted in the first table, and the first
    direction, in which it meets, which both rows' cells tell without another shuffle.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("vec"))
    whole = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(whole & F.exists("vec", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("vec", F.when(usable, F.transform("vec", lambda x: x + F.lit(0.0))))   # -0.0 is 0.0
    dims = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    rows = rows.withColumn("vec", F.concat("vec", F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("vec"))))
    # a class of equal vectors is named by two hashes of the whole vector
    rows = rows.select("id", "vec", F.when(F.col("vec").isNotNull(), F.xxhash64("vec")).alias("h"),
                       F.when(F.col("vec").isNotNull(), F.hash("vec")).alias("h2"))
    classes = saved(rows.filter("vec is not null").groupBy("h", "h2")
                    .agg(F.count("*").alias("copies"), F.min("id").alias("least"), F.any_value("vec").alias("vec"))
                    .select(F.monotonically_increasing_id().alias("id"), "h", "h2", "copies", "least", "vec"), "lattice-classes")

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = Cells(dims, tables, groups, width, probes, seed)
        for batch in batches:
            if not batch.num_rows:
                continue
            own, best = cells.near(_unit(batch.column("vec").flatten().to_numpy(zero_copy_only=False), dims))
            whole, n = cells.whole(own, best), len(own)

            def listed(values: np.ndarray) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * values[0].size), pa.array(values.ravel()))

            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("copies"), batch.column("vec"), listed(own),
                 pa.array([x.tobytes() for x in best], pa.binary()), listed(whole)],
                names=["id", "copies", "vec", "own", "best", "cells"])

    # a vector is sent as it is stored, its probed cells as two bytes each
    kind = "float" if vectors.schema[vec_col].dataType.elementType.typeName() == "float" else "double"
    units = saved(classes.select("id", "copies", F.col("vec").cast(f"array<{kind}>").alias("vec")).mapInArrow(
        filed, f"id long, copies long, vec array<{kind}>, own array<long>, best binary, cells array<long>"), "lattice-cells")
    per = 1 + probes
    probed = units.select("id", F.posexplode("cells").alias("pos", "cell")).select(
        "id", (F.col("pos") / per).cast("int").alias("t"), F.pmod("pos", F.lit(per)).alias("nth"), "cell")
    # only cells with a filed vector and another that probes it
    live = (probed.groupBy("t", "cell").agg(F.count("*").alias("n"), F.sum((F.col("nth") == 0).cast("long")).alias("filed"))
            .filter("filed > 0 and n > 1")
            .select(F.col("t").alias("l_t"), F.col("cell").alias("l_cell"), F.ceil(F.col("n") / BLOCK).alias("k")))
    hits = probed.join(live, (F.col("t") == F.col("l_t")) & (F.col("cell") == F.col("l_cell"))).select(
        F.col("id").alias("p_id"), "t", "cell", "k", "nth")
    grouped = saved(hits.join(units.drop("cells"), F.col("p_id") == F.col("id")).groupBy(
        "t", "cell", "k", F.pmod(F.xxhash64("id"), "k").alias("block")).agg(F.collect_list(
            F.struct("nth", "id", "copies", "vec", "own", "best")).alias("rows")), "lattice-blocks")
    one = grouped.filter("k = 1").select("t", F.col("rows").alias("asking"), F.col("rows").alias("there"))
    split = grouped.filter("k > 1")
    other = split.select(F.col("t").alias("o_t"), F.col("cell").alias("o_cell"), F.col("rows").alias("there"))
    pairs = one.unionByName(split.join(other, (F.col("t") == F.col("o_t")) & (F.col("cell") == F.col("o_cell")))
                            .select("t", F.col("rows").alias("asking"), "there"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = Cells(dims, tables, groups, width, probes, seed)
        for batch in batches:
            nodes, counts, a, b = [], [], [], []
            for i in range(batch.num_rows):
                t = batch.column("t")[i].as_py()
                x_id, x_copies, x, x_cells = _unpack(batch.column("asking")[i].values, dims, cells)
                filed_rows = batch.column("there")[i].values
                filed_rows = filed_rows.filter(pc.equal(filed_rows.field("nth"), 0))
                y_id, y_copies, y, y_cells = _unpack(filed_rows, dims, cells)
                p, q = np.nonzero((x @ y.T >= least) & (x_id[:, None] != y_id[None, :]))
                if not len(p):
                    continue
                there, back = _met(x_cells[p], y_cells[q]), _met(y_cells[q], x_cells[p])
                # counted here if no earlier table has it, and not also in the other direction
                first = ~(there | back)[:, :t].any(1) & (~back[:, t] | (x_id[p] < y_id[q]))
                p, q = p[first], q[first]
                nodes += [x_id[p], y_id[q]]
                counts += [y_copies[q], x_copies[p]]
                left, right = _forest(p, q, len(x_id), len(y_id))
                a.append(x_id[left])
                b.append(y_id[right])
            if not nodes:
                continue
            node, count = np.concatenate(nodes), np.concatenate(counts)
            ids, at = np.unique(node, return_inverse=True)
            totals = np.bincount(at, weights=count).astype(np.int64)
            a, b = np.concatenate(a), np.concatenate(b)
            none = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array(ids), pa.array(a)]), pa.concat_arrays([pa.nulls(len(ids), pa.int64()), pa.array(b)]),
                 pa.concat_arrays([pa.array(totals), none])], names=["a", "b", "n"])

    found = saved(pairs.mapInArrow(compare, "a long, b long, n long"), "lattice-links")
    comps = connected_components(found.filter("b is not null").select("a", "b"), "lattice-components")
    degrees = found.filter("n is not null").groupBy("a").agg(F.sum("n").alias("n"))
    joined = (classes.select("id", "h", "h2", "copies", "least")
              .join(comps, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id"))
              .join(degrees, F.col("id") == F.col("a"), "left"))
    lowest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = joined.join(lowest, "root").select(
        F.col("h").alias("c_h"), F.col("h2").alias("c_h2"), "component_id",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.lit(1).alias("one"))
    # joined on the hashes and a constant, so that both sides are dealt by the join itself and a hot class is split
    out = rows.drop("vec").withColumn("r_one", F.lit(1)).join(
        of_class, (F.col("h") == F.col("c_h")) & (F.col("h2") == F.col("c_h2")) & (F.col("r_one") == F.col("one")), "left")
    alone = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      alone.alias("component_id"), F.coalesce(F.col("id") == alone, F.lit(False)).alias("kept"))


def _forest(p: np.ndarray, q: np.ndarray, n_left: int, n_right: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the links p[i] - q[i] between two blocks those that join what was apart: n_left + n_right - 1 at most."""
    up = list(range(n_left + n_right))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    kept = []
    for i, (x, y) in enumerate(zip(p.tolist(), (q + n_left).tolist())):
        x, y = top(x), top(y)
        if x != y:
            up[x] = y
            kept.append(i)
    return p[kept], q[kept]
