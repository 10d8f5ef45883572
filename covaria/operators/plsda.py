"""Partial least squares discriminant analysis, fitted from moments.

The kernel form of PLS2 (Lindgren, Geladi and Wold 1993; Dayal and MacGregor 1997) needs
X'X and X'Y only. It gives the exact weights that iterating over rows converges to.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covaria.functions import display_number
from covaria.operators.features import FeatureTable
from covaria.operators.moments import Moments, fit_moments
from covaria.operators.pca import TOP, canonical_sign, ranked, side_by_side
from covaria.operators.profile import Scaling, sample_deviation, usable_features
from covaria.operators.project import classify, project

# A component is given up when what is left to explain is this small a share of what
# perfectly correlated features and classes would give.
RESIDUAL_TOLERANCE = 1e-12


@dataclass(frozen=True)
class PLSModel:
    scaling: Scaling
    classes: tuple
    weights: np.ndarray  # unit X weights, features x components
    rotations: np.ndarray  # scores = Z @ rotations
    coefficients: np.ndarray  # responses = Z @ coefficients + intercept
    intercept: np.ndarray  # share of rows in each class
    score_variance: np.ndarray  # population variance of each score
    total_variance: float  # summed population variance of the standardised features
    class_counts: np.ndarray
    class_score_means: np.ndarray  # classes x components

    @property
    def features(self) -> tuple[str, ...]:
        return self.scaling.features

    def component_names(self) -> list[str]:
        return [f"LV{a + 1}" for a in range(self.weights.shape[1])]

    def scores(self, table: FeatureTable, keep: Sequence[str] = (), missing: str | None = None) -> DataFrame:
        """``keep`` columns and the latent scores of every row (``missing`` as for ``project``)."""
        return project(table, self.scaling, self.rotations, self.component_names(), keep, missing=missing)

    def responses(self, table: FeatureTable, keep: Sequence[str] = (), missing: str | None = None) -> DataFrame:
        """``keep`` columns and the fitted response ``y_<class>`` of every class."""
        names = [f"y_{c}" for c in self.classes]
        return project(table, self.scaling, self.coefficients, names, keep, self.intercept, missing)

    def predict(self, table: FeatureTable, keep: Sequence[str] = (), missing: str | None = None) -> DataFrame:
        """``keep`` columns and ``prediction``, the class of the largest response."""
        return classify(
            table, self.scaling, self.coefficients, self.intercept, self.classes, keep, missing=missing
        )

    @property
    def variance_percent(self) -> np.ndarray:
        if self.total_variance <= 0:
            return np.zeros(len(self.score_variance))
        return self.score_variance / self.total_variance * 100.0

    def variance(self, spark: SparkSession) -> DataFrame:
        rows = [
            (a + 1, float(v), float(pct))
            for a, (v, pct) in enumerate(zip(self.score_variance, self.variance_percent))
        ]
        return spark.createDataFrame(rows, "component int, score_variance double, percent double")

    def weights_df(self, spark: SparkSession) -> DataFrame:
        rows = [
            (a + 1, f, float(self.weights[j, a]))
            for a in range(self.weights.shape[1])
            for j, f in enumerate(self.features)
        ]
        return spark.createDataFrame(rows, "component int, feature string, weight double")

    def top_weights(self, spark: SparkSession, top: int = TOP) -> DataFrame:
        return side_by_side(spark, self.features, self.weights, top, "lv", "weight")

    @property
    def vip(self) -> np.ndarray:
        """Variable importance: squares sum to the number of features, constants included."""
        total = self.score_variance.sum()
        if total <= 0:
            return np.zeros(len(self.features))
        return np.sqrt(len(self.features) * (self.weights**2 @ self.score_variance) / total)

    def vip_df(self, spark: SparkSession, top: int | None = TOP) -> DataFrame:
        """``rank, feature, vip`` and its text; all features if ``top`` is ``None``."""
        vip = self.vip
        order = ranked(vip, len(vip) if top is None else top)
        rows = [(r + 1, self.features[j], float(vip[j])) for r, j in enumerate(order)]
        df = spark.createDataFrame(rows, "rank int, feature string, vip double")
        return df.withColumn("vip_text", display_number(F.col("vip")))

    @property
    def fisher_ratio(self) -> float | None:
        """Between-class over within-class scatter of the scores; no pass over rows."""
        n = self.scaling.n_rows
        between = float((self.class_counts[:, None] * self.class_score_means**2).sum())
        within = float(n * self.score_variance.sum()) - between
        return between / within if within > 1e-6 else None


def _components(gram: np.ndarray, cross: np.ndarray, count: int, n: int):
    p, k = cross.shape
    weights, rotations, loadings, y_loadings = [], [], [], []
    nothing = RESIDUAL_TOLERANCE * np.sqrt(np.trace(gram) * n)
    for _ in range(count):
        if np.linalg.norm(cross) <= nothing:
            break
        left, _, _ = np.linalg.svd(cross, full_matrices=False)
        w = canonical_sign(left[:, 0])
        r = w.copy()
        for loading, rotation in zip(loadings, rotations):
            r -= (loading @ w) * rotation
        tt = float(r @ gram @ r)
        if tt <= RESIDUAL_TOLERANCE * np.trace(gram):
            break
        x_loading, y_loading = gram @ r / tt, cross.T @ r / tt
        cross = cross - tt * np.outer(x_loading, y_loading)
        weights.append(w)
        rotations.append(r)
        loadings.append(x_loading)
        y_loadings.append(y_loading)

    def stack(vectors, size):  # components that could not be found are zero
        return np.column_stack(vectors + [np.zeros(size)] * (count - len(vectors)))

    return stack(weights, p), stack(rotations, p), stack(y_loadings, k)


def plsda_from_moments(moments: Moments, n_components: int = 2, scale: bool = True) -> PLSModel:
    """Fit on all features of the moments.

    ``scale`` rescales features and class indicators to unit sample deviation, so that a
    rare class weighs as much as a common one; without it indicators are only centred.
    """
    n, p, k = moments.n_rows, len(moments.features), len(moments.classes)
    if moments.class_sums is None:
        raise ValueError("the moments were fitted without a label")
    share = moments.class_counts / max(n, 1)
    gram, cross = moments.gram, moments.class_sums.T
    x_scale, y_scale = np.ones(p), np.ones(k)
    if scale:
        x_scale = sample_deviation(np.diag(gram), n)
        y_scale = sample_deviation(moments.class_counts * (1.0 - share), n)
    gram = gram / np.outer(x_scale, x_scale)
    cross = cross / np.outer(x_scale, y_scale)
    weights, rotations, y_loadings = _components(gram, cross, n_components, n)
    on_z = rotations / x_scale[:, None]
    counts = np.maximum(moments.class_counts, 1)[:, None]
    return PLSModel(
        moments.scaling,
        moments.classes,
        weights,
        on_z,
        (on_z @ y_loadings.T) * y_scale,
        share,
        np.einsum("ja,jl,la->a", rotations, gram, rotations) / max(n, 1),
        float(np.trace(moments.gram)) / max(n, 1),
        moments.class_counts,
        moments.class_sums @ on_z / counts,
    )


def coefficients_of_subsets(moments: Moments, used: np.ndarray, n_components: int = 2) -> np.ndarray:
    """Coefficients of the unscaled models of many subsets: features x subsets x classes.

    ``used`` (features x subsets) marks each subset's features; others get zeros. All subsets
    are fitted side by side: weights come from classes x classes problems, and what needs the
    features' products is one matrix product a component for all subsets together.
    """
    used = used.astype(np.float64)
    p, m = used.shape
    gram, n = moments.gram, moments.n_rows
    cross = moments.class_sums.T[:, None, :] * used[:, :, None]
    traces = np.diag(gram) @ used
    nothing = RESIDUAL_TOLERANCE * np.sqrt(traces * n)
    coefficients = np.zeros_like(cross)
    loadings, rotations = [], []
    for _ in range(n_components):
        live = np.sqrt(np.einsum("pmk,pmk->m", cross, cross)) > nothing
        _, vectors = np.linalg.eigh(np.einsum("pmk,pml->mkl", cross, cross))
        w = np.einsum("pmk,mk->pm", cross, vectors[:, :, -1])
        w /= np.maximum(np.sqrt((w * w).sum(axis=0)), np.finfo(float).tiny)
        size = np.abs(w)
        first = np.argmax(size >= size.max(axis=0) * (1 - 1e-9), axis=0)
        w *= np.where(w[first, np.arange(m)] < 0, -1.0, 1.0) * live
        r = w.copy()
        for loading, rotation in zip(loadings, rotations):
            r -= (loading * w).sum(axis=0) * rotation
        u = (gram @ r) * used
        tt = (r * u).sum(axis=0)
        live &= tt > RESIDUAL_TOLERANCE * traces
        tt = np.where(live, tt, 1.0)
        r *= live
        x_loading = u * live / tt
        y_loading = np.einsum("pmk,pm->mk", cross, r) / tt[:, None]
        cross -= (x_loading * tt)[:, :, None] * y_loading[None]
        coefficients += r[:, :, None] * y_loading[None]
        loadings.append(x_loading)
        rotations.append(r)
    return coefficients


def fit_plsda(
    table: FeatureTable,
    n_components: int = 2,
    scale: bool = True,
    nan_policy: str = "error",
    moments: Moments | None = None,
) -> PLSModel | None:
    """Model of the table's features, or ``None`` with fewer of them than components.

    Constant features stay in: they get weight 0 but count as features. With ``moments``
    given (fitted on at least these features) no row is read.
    """
    if table.label is None:
        raise ValueError("PLS-DA needs a label column")
    moments = fit_moments(table) if moments is None else moments
    used = usable_features(moments.scaling.subset(table.features), nan_policy, drop_constant=False)
    if len(used) < max(n_components, 2):
        return None
    return plsda_from_moments(moments.subset(used), n_components, scale)
