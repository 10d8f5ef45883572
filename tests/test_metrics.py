import numpy as np
import pandas as pd
import pytest

from covaria.operators import metrics as M
from covaria.operators.labels import class_dictionary, one_hot
from covaria.operators.silhouette import silhouette
from tests import plain


def test_confusion_metrics(spark):
    actual = ["a", "a", "a", "b", "b", "c"]
    predicted = ["a", "b", "a", "b", "b", "d"]
    df = spark.createDataFrame(list(zip(actual, predicted)), "y string, p string")
    confusion = M.confusion_matrix(df, "y", "p")
    assert {(r["label"], r["prediction"]): r["n"] for r in confusion.collect()}[("a", "a")] == 2
    assert M.accuracy(confusion).first()[0] == pytest.approx(4 / 6)
    assert M.macro_f1(confusion).first()[0] == pytest.approx(plain.macro_f1(actual, predicted))


def test_row_without_a_label_is_left_out(spark):
    df = spark.createDataFrame([("a", "a"), (None, "a")], "y string, p string")
    assert M.accuracy(M.confusion_matrix(df, "y", "p")).first()[0] == 1.0


def test_fisher_without_scatter(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 1.0, 1.0), ("b", 2.0, 0.0)], "l string, x double, y double")
    row = M.fisher_ratio(df, ["x", "y"], "l").first()
    assert row["fisher_ratio"] is None and row["within"] == 0.0


def test_fisher_with_large_offset(spark):
    rng = np.random.default_rng(3)
    x, label = rng.normal(size=200), rng.integers(0, 2, 200)
    x = x + label
    frame = pd.DataFrame({"l": label.astype(str), "x": x + 1e6, "y": x * 0})
    row = M.fisher_ratio(spark.createDataFrame(frame), ["x", "y"], "l").first()
    means = [x[label == c].mean() for c in (0, 1)]
    between = sum((label == c).sum() * (means[c] - x.mean()) ** 2 for c in (0, 1))
    within = sum(((x[label == c] - means[c]) ** 2).sum() for c in (0, 1))
    assert row["fisher_ratio"] == pytest.approx(between / within, rel=1e-6)


def test_labels(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, l string")
    assert [tuple(r) for r in class_dictionary(df, "l").orderBy("class_index").collect()] == [(0, "a"), (1, "b")]
    rows = one_hot(df, "l", keep=["id"]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 0.0, 1.0), (2, 1.0, 0.0), (3, 0.0, 0.0)]


def _points(spark, x, y, labels):
    return spark.createDataFrame(pd.DataFrame({"x": x, "y": y, "l": labels}))


@pytest.mark.parametrize("leaf", [24, 1000])
def test_silhouette_of_a_crowded_spot(spark, leaf):
    """A third of the points crowd within a thousandth of the spread; some are copies."""
    rng = np.random.default_rng(5)
    n = 1200
    c = rng.integers(0, 3, n)
    x, y = rng.normal(size=n) + c, rng.normal(size=n) * 0.3 - c
    x[: n // 3], y[: n // 3] = 1 + 1e-3 * rng.normal(size=n // 3), 0.5 + 1e-3 * rng.normal(size=n // 3)
    x[-100:], y[-100:] = 0.25, 0.25
    labels = np.array([f"c{v}" for v in c])
    row = silhouette(_points(spark, x, y, labels), "x", "y", "l", leaf_points=leaf, direct_points=0).first()
    assert row["n_rows"] == n and row["n_classes"] == 3
    assert row["silhouette"] == pytest.approx(plain.silhouette(x, y, labels), abs=1e-8)


def test_silhouette_on_a_line(spark):
    x = np.arange(900.0)
    labels = np.array(["a", "b"])[(x > 300).astype(int)]
    row = silhouette(_points(spark, x, 0 * x, labels), "x", "y", "l", leaf_points=16, direct_points=0).first()
    assert row["silhouette"] == pytest.approx(plain.silhouette(x, 0 * x, labels), abs=1e-8)


def test_silhouette_with_a_far_outlier(spark):
    """One point a billion spreads away: the tree has to go deep."""
    rng = np.random.default_rng(6)
    x, y, c = rng.normal(size=400), rng.normal(size=400), rng.integers(0, 2, 400)
    x[0] = 1e9
    labels = np.array(["a", "b"])[c]
    row = silhouette(_points(spark, x, y, labels), "x", "y", "l", leaf_points=64, direct_points=0).first()
    assert row["silhouette"] == pytest.approx(plain.silhouette(x, y, labels), abs=1e-6)


def test_silhouette_of_few_points_is_direct(spark):
    rng = np.random.default_rng(7)
    x, y, labels = rng.normal(size=500), rng.normal(size=500), rng.choice(["a", "b", "c"], 500)
    row = silhouette(_points(spark, x, y, labels), "x", "y", "l").first()
    assert row["silhouette"] == pytest.approx(plain.silhouette(x, y, labels), abs=1e-12)


def test_silhouette_edges(spark):
    def of(x, labels):
        x = np.array(x, dtype=float)
        return silhouette(_points(spark, x, x, labels), "x", "y", "l").first()["silhouette"]

    assert of([1, 2, 3], ["a", "a", "a"]) is None
    assert of([1, 2], ["a", "b"]) is None
    assert of([1, 1, 1, 1], ["a", "a", "b", "b"]) == 0.0
    assert of([1, 2, 9], ["a", "a", "b"]) == pytest.approx(plain.silhouette(
        np.array([1.0, 2, 9]), np.array([1.0, 2, 9]), np.array(["a", "a", "b"])))


def test_infinite_coordinates_are_refused(spark):
    from covaria.operators.silhouette import silhouette

    df = spark.createDataFrame([(0.0, 1.0, "a"), (float("inf"), 1.0, "b"), (1.0, 2.0, "a")], "x double, y double, l string")
    with pytest.raises(ValueError):
        silhouette(df, "x", "y", "l").first()


def test_one_pass_gives_both_measures(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("c", None), (None, "a")]
    confusion = M.confusion_matrix(spark.createDataFrame(rows, "y string, p string"), "y", "p")
    both = M.hits_and_f1(confusion).first()
    assert both["accuracy"] == pytest.approx(M.accuracy(confusion).first()[0]) == 0.5
    assert both["macro_f1"] == pytest.approx(M.macro_f1(confusion).first()[0])
