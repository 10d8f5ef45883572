"""Moments from merged partial states against the two-pass moments and against numpy."""

import numpy as np
import pytest

from covaria.operators import merged
from covaria.operators.features import FeatureTable
from covaria.operators.merged import merged_moments, of_batch
from covaria.operators.moments import fit_moments


def _table(spark, x, labels, parts=4):
    rows = [(str(l), [None if np.isnan(v) else float(v) for v in r]) for l, r in zip(labels, x)]
    df = spark.createDataFrame(rows, "label string, x array<double>").repartition(parts)
    return FeatureTable.of(df, [f"f{j}" for j in range(x.shape[1])], "label", array="x")


def _data(n=3000, p=6, seed=1, offsets=(1e9, -5, 0, 3, 1e6, 7)):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) * [1, 2, 3, 0.5, 1e-3, 4] + list(offsets)
    x[rng.random((n, p)) < 0.05] = np.nan
    x[:, 3][rng.random(n) < 0.01] = np.inf
    labels = rng.choice(["a", "b", "c"], n)
    return x, labels


def _exact_z(x):
    """Standardised values in extended precision; missing and infinite ones count as the mean."""
    X = x.astype(np.longdouble)
    fin = np.isfinite(x)
    mu = np.array([X[fin[:, j], j].sum() / fin[:, j].sum() for j in range(x.shape[1])])
    sd = np.array([np.sqrt(((X[fin[:, j], j] - mu[j]) ** 2).sum() / fin[:, j].sum()) for j in range(x.shape[1])])
    return np.where(fin, (X - mu) / sd, 0)


def _exact_correlation(x):
    z = _exact_z(x)
    return (z.T @ z).astype(np.float64) / len(x)


def test_merged_equals_the_two_passes(spark):
    x, labels = _data()
    table = _table(spark, x, labels)
    ours, theirs = merged_moments(table), fit_moments(table)
    assert ours.classes == theirs.classes
    # Values of 1e9 with unit spread carry about 1e-7 of it in their last digit: correlations
    # agree to a few parts in 1e9, and the merged ones stay that close to extended precision.
    np.testing.assert_allclose(ours.correlation(), theirs.correlation(), atol=1e-8)
    np.testing.assert_allclose(ours.correlation(), _exact_correlation(x), atol=1e-8)
    z = _exact_z(x)
    exact_sums = np.array([z[labels == c].sum(axis=0) for c in ours.classes], dtype=np.float64)
    np.testing.assert_allclose(ours.class_sums, exact_sums, atol=3e-5)
    np.testing.assert_allclose(ours.scaling.mean, theirs.scaling.mean, rtol=1e-14)
    np.testing.assert_allclose(ours.scaling.scale, theirs.scaling.scale, rtol=1e-9)
    assert (ours.class_counts == theirs.class_counts).all()


@pytest.mark.parametrize("offsets, digits", [((10, -5, 0, 3, 1, 7), 1e-12), ((1e9, -5, 0, 3, 1e6, 7), 1e-8)])
def test_row_order_does_not_matter(spark, offsets, digits):
    """To rounding; values of 1e9 with unit spread hold only 1e-7 of it, which sets the bound."""
    x, labels = _data(seed=2, offsets=offsets)
    a = merged_moments(_table(spark, x, labels, parts=3))
    order = np.random.default_rng(0).permutation(len(x))
    b = merged_moments(_table(spark, x[order], labels[order], parts=37))
    np.testing.assert_allclose(a.correlation(), b.correlation(), atol=digits)
    np.testing.assert_allclose(a.class_sums, b.class_sums, atol=digits * 1e4)


def test_many_states_merge_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(merged, "FAN_IN", 2)
    x, labels = _data(n=800, seed=3)
    a = merged_moments(_table(spark, x, labels, parts=13))
    b = fit_moments(_table(spark, x, labels, parts=1))
    np.testing.assert_allclose(a.correlation(), b.correlation(), atol=1e-8)


def test_batch_merge_against_numpy_with_a_huge_mean():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 3)) + 1e12
    x[rng.random((500, 3)) < 0.1] = np.nan
    parts = [of_batch(x[i:i + 50], ["k"] * len(x[i:i + 50])) for i in range(0, 500, 50)]
    state = parts[0]
    for more in parts[1:]:
        state = merged.merged(state, more)
    X, fin = x.astype(np.longdouble), np.isfinite(x)
    mean = np.array([X[fin[:, j], j].mean() for j in range(3)])
    z = np.where(fin, X - mean, 0)
    np.testing.assert_allclose(state.ref, mean.astype(np.float64), rtol=1e-15)
    # Values near 1e12 hold their unit spread to about 1e-4 only.
    np.testing.assert_allclose(state.c, (z.T @ z).astype(np.float64), atol=0.05)


def test_empty_table(spark):
    table = _table(spark, np.zeros((0, 3)), np.array([], dtype=str))
    found = merged_moments(table)
    assert found.n_rows == 0 and found.classes == ()
