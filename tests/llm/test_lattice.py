import numpy as np
import pytest

from tests.conftest import SF01
from txflow.llm import lattice
from txflow.llm.lattice import Cells, e8_nearest, e8_roots, near_vectors
from txflow.llm.queries import op5_lattice


def brute(rows, least=0.95):
    ok = [v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    dims = max((len(v) for (_, v), u in zip(rows, ok) if u), default=1)
    unit = np.array([[*v, *[0.0] * (dims - len(v))] if u else [0.0] * dims for (_, v), u in zip(rows, ok)], dtype=float).reshape(-1, dims)
    for step in (np.abs(unit).max(1, keepdims=True, initial=0), None):
        size = step if step is not None else np.linalg.norm(unit, axis=1, keepdims=True)
        unit = np.divide(unit, size, out=np.zeros_like(unit), where=size > 0)
    linked = unit @ unit.T >= least
    np.fill_diagonal(linked, False)
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        todo, part = [i], {i}
        while todo:
            for j in np.nonzero(linked[todo.pop()])[0].tolist():
                if j not in part:
                    part.add(j)
                    todo.append(j)
        seen |= part
        least_id = min((rows[j][0] for j in part if rows[j][0] is not None), default=None)
        for j in part:
            out[j] = (rows[j][0], int(linked[j].sum()), least_id, rows[j][0] is not None and rows[j][0] == least_id)
    return sorted(out, key=repr)


def test_query_finds_every_link_of_the_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in op5_lattice(spark, SF01).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("block", [256, 5])
def test_odd_vectors_and_split_cells(spark, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK", block)
    rng = np.random.default_rng(3)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.05 * rng.standard_normal(16)).tolist()) for i in range(40)]
    rows += [(100 + i, rng.standard_normal(16).tolist()) for i in range(20)]
    rows += [(200, rows[0][1]), (0, rows[0][1]), (201, [2 * x for x in rows[0][1]]), (202, None), (203, []), (204, [0.0] * 16),
             (205, [float("nan")] * 16), (206, [None] * 16), (None, rows[45][1]), (207, [1.0]), (208, [1.0] + [0.0] * 15),
             (209, [1e300] * 16), (210, [1e-300] * 16), (211, [-0.0] * 16)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, id int, kept string")
    assert sorted((tuple(r) for r in near_vectors(df).collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_e8_points_are_nearest():
    rng = np.random.default_rng(1)
    x = rng.uniform(-3, 3, (300, 8))
    point = e8_nearest(x)
    doubled = np.rint(2 * point)
    assert np.allclose(doubled, 2 * point) and np.all(doubled % 2 == doubled[:, :1] % 2) and np.all(point.sum(1) % 2 == 0)
    roots = e8_roots()
    assert roots.shape == (240, 8) and np.allclose((roots ** 2).sum(1), 2)
    near = ((x - point) ** 2).sum(1)
    assert np.all(near <= 1 + 1e-9)   # the covering radius
    assert np.all(near[:, None] <= ((x[:, None] - point[:, None] - roots[None]) ** 2).sum(2) + 1e-9)


def test_recall_at_the_threshold_itself():
    """Pairs with a cosine of exactly 0.95 in 64 dimensions, the hardest that count."""
    rng = np.random.default_rng(2)
    a = rng.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((3000, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.95 * a + np.sqrt(1 - 0.95 ** 2) * b
    cells = Cells(64, 8, 2, 1.6, 8, 8)
    x, y = cells.of(a), cells.of(b)
    met = ((x == y[:, :, :1]).any(2) | (y == x[:, :, :1]).any(2)).any(1)
    assert met.mean() >= 0.9
