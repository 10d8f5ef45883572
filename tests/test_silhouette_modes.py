"""The adaptive tree and the sampled mode of the silhouette against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from covaria.operators import adaptive
from covaria.operators.adaptive import silhouette_adaptive
from covaria.operators.sampled import silhouette_sampled
from covaria.operators.silhouette import _frame
from tests import plain


def _points(spark, x, y, labels):
    rows = [(float(a), float(b), str(c)) for a, b, c in zip(x, y, labels)]
    return spark.createDataFrame(rows, "x double, y double, l string")


def _spot(n, seed=1):
    """Half of the points in one spot of side 1e-6, the rest log-uniform over six decades."""
    rng = np.random.default_rng(seed)
    c = rng.integers(0, 3, n)
    x, y = 10 ** rng.uniform(-6, 0, n) + c * 0.05, 10 ** rng.uniform(-6, 0, n)
    x[: n // 2], y[: n // 2] = 0.5 + 1e-6 * rng.random(n // 2), 0.25 + 1e-6 * rng.random(n // 2)
    return x, y, np.array([f"c{v}" for v in c])


@pytest.mark.parametrize("leaf", [16, 64])
def test_adaptive_tree_equals_all_pairs(spark, leaf):
    x, y, labels = _spot(1500)
    row = silhouette_adaptive(_points(spark, x, y, labels), "x", "y", "l", leaf_points=leaf).first()
    assert row["n_rows"] == 1500 and row["n_classes"] == 3
    assert row["silhouette"] == pytest.approx(plain.silhouette(x, y, labels), abs=1e-8)


def test_adaptive_leaves_have_their_own_depth(spark):
    x, y, labels = _spot(3000, seed=2)
    points = _points(spark, x, y, labels).select("x", "y", F.lit(0).alias("c"), F.lit(1).cast("long").alias("w"))
    bounds = points.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
                        F.count("*").alias("points")).collect()
    placed, cells = adaptive._leaves(points, _frame(bounds, np.array([3000.0])), 32)
    per_leaf = placed.groupBy("level", "ix", "iy").count()
    assert per_leaf.agg(F.max("count")).first()[0] <= 32
    levels = [r["level"] for r in cells.where("leaf").select("level").distinct().collect()]
    assert min(levels) <= 6 and max(levels) >= 20
    assert placed.count() == 3000


def test_adaptive_on_a_line_and_with_an_outlier(spark):
    x = np.arange(600.0)
    labels = np.array(["a", "b"])[(x > 200).astype(int)]
    row = silhouette_adaptive(_points(spark, x, 0 * x, labels), "x", "y", "l", leaf_points=16).first()
    assert row["silhouette"] == pytest.approx(plain.silhouette(x, 0 * x, labels), abs=1e-8)
    rng = np.random.default_rng(6)
    x, y, c = rng.normal(size=400), rng.normal(size=400), rng.integers(0, 2, 400)
    x[0] = 1e9
    labels = np.array(["a", "b"])[c]
    row = silhouette_adaptive(_points(spark, x, y, labels), "x", "y", "l", leaf_points=32).first()
    assert row["silhouette"] == pytest.approx(plain.silhouette(x, y, labels), abs=1e-6)


def test_adaptive_edge_cases(spark):
    one = silhouette_adaptive(_points(spark, [0.0, 1.0], [0.0, 1.0], ["a", "a"]), "x", "y", "l").first()
    assert one["silhouette"] is None and one["n_rows"] == 2
    copies = silhouette_adaptive(_points(spark, [0.0] * 50 + [1.0] * 50, [0.0] * 100, ["a"] * 50 + ["b"] * 50),
                                 "x", "y", "l", leaf_points=4).first()
    assert copies["silhouette"] == pytest.approx(1.0)


def test_sampled_interval_holds_the_exact_value(spark):
    rng = np.random.default_rng(3)
    n = 4000
    c = rng.integers(0, 3, n)
    x, y = rng.normal(size=n) + c, rng.normal(size=n) * 0.5 - 0.5 * c
    labels = np.array([f"c{v}" for v in c])
    exact = plain.silhouette(x, y, labels)
    table = _points(spark, x, y, labels)
    row = silhouette_sampled(table, "x", "y", "l", per_class=300, seed=1).first()
    assert row["approximate"] and row["anchors"] == 900
    assert row["low"] <= exact <= row["high"]
    assert row["high"] - row["low"] < 0.1
    again = silhouette_sampled(table.repartition(7), "x", "y", "l", per_class=300, seed=1).first()
    assert again["silhouette"] == pytest.approx(row["silhouette"], abs=1e-12)


def test_sampled_drawn_whole_is_exact(spark):
    x, y, labels = _spot(600, seed=4)
    row = silhouette_sampled(_points(spark, x, y, labels), "x", "y", "l", per_class=10_000).first()
    assert not row["approximate"]
    assert row["silhouette"] == pytest.approx(plain.silhouette(x, y, labels), abs=1e-9)
    assert row["low"] == row["high"] == row["silhouette"]
