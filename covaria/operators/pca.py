"""Principal component analysis of standardised features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covaria.functions import display_number, display_percent
from covaria.operators.features import FeatureTable
from covaria.operators.moments import Moments, fit_moments
from covaria.operators.profile import Scaling, usable_features
from covaria.operators.project import project
from covaria.sources.catalog import FeatureCatalog

TOP = 10


def canonical_sign(vector: np.ndarray) -> np.ndarray:
    """The vector or its negative: the entry largest in size is made positive.

    Entries equal in size up to rounding count as tied; the first of them decides.
    """
    size = np.abs(vector)
    if not size.size or size.max() == 0:
        return vector
    first = int(np.flatnonzero(size >= size.max() * (1 - 1e-9))[0])
    return -vector if vector[first] < 0 else vector


def ranked(weights: np.ndarray, top: int) -> list[int]:
    """Positions by size, largest first; sizes equal up to rounding keep feature order."""
    size = np.abs(weights)
    order = np.argsort(-size, kind="stable")
    if not len(order):
        return []
    drop = size[order[:-1]] - size[order[1:]] > 1e-9 * max(size.max(), 1e-300)
    level = np.concatenate([[0], np.cumsum(drop)])
    return [int(i) for i in order[np.lexsort((order, level))][:top]]


@dataclass(frozen=True)
class PCAModel:
    scaling: Scaling  # of the features used
    dropped: tuple[str, ...]  # features left out: missing values or constant
    loadings: np.ndarray  # features x components
    eigenvalues: np.ndarray  # of the kept components
    total_variance: float

    @property
    def features(self) -> tuple[str, ...]:
        return self.scaling.features

    @property
    def fitted(self) -> bool:
        return self.loadings.shape[1] > 0

    @property
    def explained_percent(self) -> np.ndarray:
        if self.total_variance <= 0:
            return np.zeros(len(self.eigenvalues))
        return self.eigenvalues / self.total_variance * 100.0

    def component_names(self) -> list[str]:
        return [f"PC{a + 1}" for a in range(self.loadings.shape[1])]

    def scores(self, table: FeatureTable, keep: Sequence[str] = (), missing: str | None = None) -> DataFrame:
        """``keep`` columns and the component scores of every row (``missing`` as for ``project``)."""
        if not self.fitted:
            return empty_scores(table, keep, ["PC1", "PC2"])
        return project(table, self.scaling, self.loadings, self.component_names(), keep, missing=missing)

    def loadings_df(self, spark: SparkSession) -> DataFrame:
        """``component, feature, loading``."""
        rows = [
            (a + 1, f, float(self.loadings[j, a]))
            for a in range(self.loadings.shape[1])
            for j, f in enumerate(self.features)
        ]
        return spark.createDataFrame(rows, "component int, feature string, loading double")

    def explained_variance(self, spark: SparkSession) -> DataFrame:
        """``component, eigenvalue, percent, percent_text``."""
        rows = [
            (a + 1, float(v), float(pct))
            for a, (v, pct) in enumerate(zip(self.eigenvalues, self.explained_percent))
        ]
        df = spark.createDataFrame(rows, "component int, eigenvalue double, percent double")
        return df.withColumn("percent_text", display_percent(F.col("percent")))

    def top_loadings(self, spark: SparkSession, top: int = TOP) -> DataFrame:
        return side_by_side(spark, self.features, self.loadings, top, "pc", "loading")


def side_by_side(
    spark: SparkSession, features: Sequence[str], weights: np.ndarray, top: int, prefix: str, value: str
) -> DataFrame:
    """``rank``, then for each component its ranked feature, value and 3-decimal text."""
    count = weights.shape[1]
    order = [ranked(weights[:, a], top) for a in range(count)]
    fields = ["rank int"]
    for a in range(count):
        fields += [f"{prefix}{a + 1}_feature string", f"{prefix}{a + 1}_{value} double"]
    rows = [
        (r + 1, *[x for a in range(count) for x in (features[order[a][r]], float(weights[order[a][r], a]))])
        for r in range(min(top, len(features)) if count else 0)
    ]
    df = spark.createDataFrame(rows, ", ".join(fields))
    for a in range(count):
        name = f"{prefix}{a + 1}_{value}"
        df = df.withColumn(f"{name}_text", display_number(F.col(name)))
    return df


def empty_scores(table: FeatureTable, keep: Sequence[str], names: Sequence[str]) -> DataFrame:
    """No rows, but the columns a fitted model would give."""
    kept = [table.df[f"`{k}`"] for k in keep]
    return table.df.select(*kept, *[F.lit(0.0).alias(n) for n in names]).limit(0)


def pca_from_moments(moments: Moments, n_components: int = 2, dropped: Sequence[str] = ()) -> PCAModel:
    """Eigenvectors of the correlation matrix; no component if there are too few features."""
    p = len(moments.features)
    if p < max(n_components, 2) or moments.n_rows == 0:
        return PCAModel(moments.scaling, tuple(dropped), np.zeros((p, 0)), np.zeros(0), 0.0)
    r = moments.correlation()
    values, vectors = np.linalg.eigh(r)
    order = np.argsort(values)[::-1][:n_components]
    loadings = np.column_stack([canonical_sign(vectors[:, a]) for a in order])
    return PCAModel(
        moments.scaling, tuple(dropped), loadings, np.maximum(values[order], 0.0), float(np.trace(r))
    )


def fit_pca(
    table: FeatureTable,
    n_components: int = 2,
    nan_policy: str = "drop_column",
    moments: Moments | None = None,
) -> PCAModel:
    """PCA of the table's usable features.

    With ``moments`` given (fitted on at least these features) no row is read at all,
    which is how switching features on and off is meant to be used.
    """
    moments = fit_moments(table) if moments is None else moments
    used = usable_features(moments.scaling.subset(table.features), nan_policy)
    dropped = tuple(f for f in table.features if f not in set(used))
    return pca_from_moments(moments.subset(used), n_components, dropped)


def pca_by_group(
    spark: SparkSession, moments: Moments, catalog: FeatureCatalog, nan_policy: str = "drop_column"
) -> DataFrame:
    """One row per catalogue group: explained variance of a PCA of that group alone.

    All groups are refitted from one set of moments. A group with fewer than two usable
    features gets NULLs.
    """
    rows = []
    for group in catalog.groups:
        names = catalog.resolve(moments.features, groups=[group]).columns
        used = usable_features(moments.scaling.subset(names), nan_policy)
        model = pca_from_moments(moments.subset(used))
        pct = [float(v) for v in model.explained_percent] if model.fitted else [None, None]
        rows.append((group, len(used), *pct))
    return spark.createDataFrame(
        rows, "group_id string, n_features int, pc1_percent double, pc2_percent double"
    )
