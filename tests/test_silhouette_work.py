"""Work of the silhouette trees: points put on grids once, far cells met through grids, blocks shared."""

import numpy as np
import pyarrow as pa
import pytest

import covaria.operators.silhouette as S


def _batch(n, depth, side):
    rng = np.random.default_rng(3)
    x, y = np.sort(rng.random(n)) * side, rng.random(n) * side
    cell = [np.minimum((v * 2**depth / side).astype(np.int64), 2**depth - 1) for v in (x, y)]
    c, w = rng.integers(0, 3, n).astype(np.int32), rng.integers(1, 4, n)
    columns = dict(ix=cell[0], iy=cell[1], x=x, y=y, c=c, w=w)
    return columns, pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})


def test_points_are_put_on_a_grid_once_whatever_the_depth(monkeypatch):
    depth, side = 6, 5.0
    columns, batch = _batch(400, depth, side)
    seen, on_grid = [], S._on_grid
    monkeypatch.setattr(S, "_on_grid", lambda u, v: seen.append(len(u)) or on_grid(u, v))
    frame = S._Frame(0.0, 0.0, side, 400, np.ones(3))
    emitted = list(S._tree_weights(frame, depth)([batch]))
    assert sum(seen) == 400
    ix, iy, x, y, c, w = columns.values()
    levels = {b.column(0)[0].as_py(): b for b in emitted}
    assert sorted(levels) == [2, 3, 4, 5, 6]
    for level, b in levels.items():  # the same as straight from the points
        scale = 2.0**level / side
        lx, ly = ix >> (depth - level), iy >> (depth - level)
        direct = S._emit(np.full(400, level), lx, ly, c, on_grid(x * scale - lx, y * scale - ly) * w[:, None])
        assert b.drop_columns(["vec"]).equals(direct.drop_columns(["vec"]))
        found, plain = (S.matrix(some.column(4), S.GRID**2) for some in (b, direct))
        assert found == pytest.approx(plain, abs=1e-11)


def test_leaves_reach_few_blocks(spark):
    """Points of a leaf travel to less than two blocks on average, not to nine cells."""
    depth, n = 5, 32
    cells = [(i, j, (i + 0.5) / n, (j + 0.5) / n, (i + j) % 2, 1) for i in range(n) for j in range(n)]
    placed = spark.createDataFrame(cells, "ix long, iy long, x double, y double, c int, w long")
    frame = S._Frame(0.0, 0.0, 1.0, n * n, np.array([n * n / 2, n * n / 2]))
    sums = S._leaf_sums(placed, None, frame, depth).collect()
    assert sum(r["rows"] for r in sums) == n * n
    assert len(sums) <= n * n // 16


def test_large_coordinates_do_not_overflow(spark):
    points = [(x * 1e200, y * 1e200, label) for x, y, label in [(0, 0, "a"), (0, 1, "a"), (9, 0, "b"), (9, 1, "b")]]
    found = S.silhouette(spark.createDataFrame(points, "x double, y double, l string"), "x", "y", "l").first()
    other = (9 + np.hypot(9, 1)) / 2
    assert found["silhouette"] == pytest.approx((other - 1) / other, abs=1e-12)


def test_grid_vectors_add_up_across_batches(spark):
    """25,000 rows of one cell span several batches; the others are told apart by class."""
    key = ["cast(2 as int) level", "1L ix", "3L iy", "cast(if(id < 25000, 0, id % 2 + 1) as int) c"]
    rows = spark.range(25_007).repartition(5).selectExpr(*key, "array_repeat(double(1), 100) vec")
    added = S._added(rows).collect()
    assert sorted((r["c"], r["vec"][0], r["vec"][99]) for r in added) == [(0, 25_000, 25_000), (1, 4, 4), (2, 3, 3)]
