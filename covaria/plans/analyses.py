"""Whole analyses, from a feature request to the tables a user looks at."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covaria.operators.features import FeatureTable
from covaria.operators.links import link_counts, pair_links
from covaria.operators.lookups import invert_categories, with_category
from covaria.operators.metrics import confusion_matrix, hits_and_f1, metrics_table
from covaria.operators.moments import Moments
from covaria.operators.pca import PCAModel, fit_pca
from covaria.operators.plsda import PLSModel, fit_plsda
from covaria.operators.silhouette import silhouette
from covaria.sources.categories import element_categories
from covaria.sources.catalog import FeatureCatalog


@dataclass(frozen=True)
class PCAMap:
    model: PCAModel
    scores: DataFrame
    explained_variance: DataFrame
    top_loadings: DataFrame


def requested(
    df: DataFrame, catalog: FeatureCatalog, label: str | None = None, **request
) -> FeatureTable:
    """Feature table of a catalogue request (see ``FeatureCatalog.resolve``)."""
    return FeatureTable.of(df, catalog.resolve(df.columns, **request).columns, label)


def pca_map(
    table: FeatureTable, key: str, nan_policy: str = "drop_column", moments: Moments | None = None
) -> PCAMap:
    """Entities in component space: scores by key, explained variance, top loadings."""
    spark = table.df.sparkSession
    model = fit_pca(table, nan_policy=nan_policy, moments=moments)
    scores = model.scores(table, [key]).withColumn(key, F.col(f"`{key}`").cast("string"))
    return PCAMap(model, scores, model.explained_variance(spark), model.top_loadings(spark))


def with_element_category(scores: DataFrame, key: str = "Symbol") -> DataFrame:
    """Scores with the category of each element symbol."""
    categories = invert_categories(element_categories(scores.sparkSession))
    return with_category(scores, categories, key)


@dataclass(frozen=True)
class PairMap:
    entities: PCAMap
    links: DataFrame
    counts: DataFrame


def pair_map(table: FeatureTable, pairs: DataFrame, key: str, order_by: Sequence[str] = ()) -> PairMap:
    """Pairs as links between entities in component space."""
    entities = pca_map(table, key)
    scores = entities.model.scores(table, [key, *[o for o in order_by if o != key]])
    return PairMap(
        entities, pair_links(pairs, scores, key, order_by=order_by), link_counts(pairs, scores, key)
    )


def quality(table: FeatureTable, model: PLSModel, with_silhouette: bool = True) -> DataFrame:
    """One row ``accuracy, macro_f1, silhouette, fisher_ratio`` of a fitted model.

    Accuracy and F1 come from one pass that counts label and prediction; the Fisher
    ratio needs none, since class means and variances of scores follow from the moments.
    """
    predicted = model.predict(table, [table.label])
    confusion = confusion_matrix(predicted, table.label, "prediction")
    score = None
    if with_silhouette and len(model.classes) > 1:
        points = model.scores(table, [table.label])
        if len(model.component_names()) == 2:
            score = silhouette(points, "LV1", "LV2", table.label).first()["silhouette"]
    return hits_and_f1(confusion).select(
        "accuracy",
        "macro_f1",
        F.lit(score).cast("double").alias("silhouette"),
        F.lit(model.fisher_ratio).cast("double").alias("fisher_ratio"),
    )


@dataclass(frozen=True)
class PLSDAView:
    model: PLSModel
    scores: DataFrame
    variance: DataFrame
    metrics: DataFrame
    top_weights: DataFrame
    vip: DataFrame


def plsda_view(table: FeatureTable, keep: Sequence[str] = (), moments: Moments | None = None) -> PLSDAView | None:
    """Latent scores, variance, metrics, top weights and importance; ``None`` if too few features."""
    spark: SparkSession = table.df.sparkSession
    model = fit_plsda(table, moments=moments)
    if model is None:
        return None
    kept = [k for k in keep if k != table.label]
    return PLSDAView(
        model,
        model.scores(table, [*kept, table.label]),
        model.variance(spark),
        metrics_table(quality(table, model)),
        model.top_weights(spark),
        model.vip_df(spark),
    )

