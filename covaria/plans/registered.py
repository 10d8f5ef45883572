"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covaria.functions import column, formula_tokens, safe_division
from covaria.operators import history as H
from covaria.operators import metrics as M
from covaria.operators import profile as P
from covaria.operators.features import FeatureTable, kept
from covaria.operators.labels import class_dictionary, one_hot
from covaria.operators.links import link_counts, pair_links, rejected_pairs, split_pairs
from covaria.operators.lookups import invert_categories, with_category
from covaria.operators.merged import merged_moments
from covaria.operators.moments import fit_moments
from covaria.operators.pca import fit_pca, pca_by_group
from covaria.operators.plsda import PLSModel, fit_plsda
from covaria.operators.selection import (
    backward_elimination,
    evaluate_subsets,
    forward_selection,
    scores_at,
    sweep_add_one,
    sweep_drop_one,
)
from covaria.operators.adaptive import silhouette_adaptive
from covaria.operators.sampled import silhouette_sampled
from covaria.operators.subsets import pca_of_subsets
from covaria.operators.silhouette import silhouette
from covaria.plans import bindings as B
from covaria.plans.analyses import quality
from covaria.sources import CATEGORY_BYTES, ENTITY_CATALOG, SAMPLE_CATALOG, element_categories, read_entities, read_pairs, read_samples

Query = Callable[[SparkSession, str], DataFrame]

# Seed features and steps of the registered selection queries.
SEED_FEATURES = ("n_digits", "n_marks")
REPLAY_SIZE = 3

# Rounding: distributed sums depend on the order of addition in their last digits.
# Profiles take a seventh digit: a mean of cents over a round number of rows can lie
# exactly halfway between two values of the sixth.
SMALL, ROWS, PROFILE = 6, 5, 7


def rounded(value: Column, digits: int) -> Column:
    """Half up, in plain double arithmetic (``round`` goes through decimals)."""
    unit = F.lit(10.0**digits)
    return F.floor(value * unit + F.lit(0.5)) / unit


def _round(df: DataFrame, digits: int = SMALL) -> DataFrame:
    """Every double column rounded."""
    return df.select(
        *[
            rounded(column(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else column(f.name)
            for f in df.schema.fields
        ]
    )


# --- sources and selection of columns ------------------------------------------------


def scan_samples(spark, sf_dir):
    return read_samples(
        spark, f"{sf_dir}/lineitem.parquet", "l_returnflag", B.LINE_FEATURES, keys=B.LINE_KEYS
    )


def scan_entities(spark, sf_dir):
    return read_entities(spark, f"{sf_dir}/part.parquet", "p_partkey", ["p_size", "p_retailprice"])


def scan_pairs(spark, sf_dir):
    return read_pairs(spark, f"{sf_dir}/customer.parquet", "c_name", "c_mktsegment")


def catalog_group_sizes(spark, sf_dir):
    """Per catalogue group: features listed, features the table has, values present."""
    lines = B.lines(spark, sf_dir)
    measured = P.profile(lines).select("column", (F.col("n_rows") - F.col("n_null") - F.col("n_nan")).alias("n"))
    return (
        B.LINE_CATALOG.to_df(spark)
        .join(measured, "column", "left")
        .groupBy("group_id", "group_ord")
        .agg(
            F.count(F.lit(1)).alias("n_features"),
            F.count("n").alias("n_available"),
            F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("n_values"),
        )
    )


def catalog_on_vectors(spark, sf_dir):
    """Both whole catalogues, their entries bound in order to the entries of the embeddings."""
    vectors = B.vectors(spark, sf_dir)
    named = FeatureTable.of(vectors.df, vectors.features, array="embedding")
    means = P.profile(named).select(F.col("ord").cast("int").alias("i"), "mean")
    entries = SAMPLE_CATALOG.to_df(spark).union(ENTITY_CATALOG.to_df(spark))
    bound = entries.join(means, F.col("i") == entries.ord % len(vectors.features))
    return _round(
        bound.groupBy("catalog", "group_id").agg(F.count(F.lit(1)).alias("n_features"), F.sum("mean").alias("mean_sum"))
    )


def select_feature_group(spark, sf_dir):
    df = B.table(spark, sf_dir, "lineitem")
    chosen = B.LINE_CATALOG.resolve(df.columns, groups=["rates"], columns=["l_quantity"]).columns
    return df.select(*B.LINE_KEYS, *[column(c) for c in chosen])


# --- profile and cleaning ------------------------------------------------------------


def column_profile(spark, sf_dir):
    return _round(P.profile(B.dirty_lines(spark, sf_dir)).drop("ord"), PROFILE)


def drop_nan_columns(spark, sf_dir):
    dirty = B.dirty_lines(spark, sf_dir)
    return P.drop_nan_columns(dirty.df, dirty.features)


def drop_zero_variance(spark, sf_dir):
    dirty = B.dirty_lines(spark, sf_dir)
    return P.drop_zero_variance(dirty.df, dirty.features)


def clean_values(spark, sf_dir):
    dirty = B.dirty_lines(spark, sf_dir)
    return P.clean_columns(dirty.df, dirty.features, nan_value=0.0, inf_value=-1.0)


def standardize(spark, sf_dir):
    return _round(P.standardize(B.lines(spark, sf_dir), keep=B.LINE_KEYS), ROWS)


def standardize_impute(spark, sf_dir):
    return _round(P.standardize(B.dirty_lines(spark, sf_dir), keep=B.LINE_KEYS, impute=True), ROWS)


# --- lookups and pairs ---------------------------------------------------------------


def category_lookup(spark, sf_dir):
    customers = B.table(spark, sf_dir, "customer").select("c_custkey", B.nation_symbol("c_nationkey").alias("sign"))
    symbols = invert_categories(element_categories(spark))
    return with_category(customers, symbols, "sign", symbol_bytes=CATEGORY_BYTES)


def invert_category_lists(spark, sf_dir):
    """Brands listed by part type, inverted to the type of each brand."""
    listed = (
        B.table(spark, sf_dir, "part")
        .groupBy("p_type")
        .agg(F.collect_set("p_brand").alias("brands"), F.min("p_partkey").alias("ord"))
    )
    return invert_categories(listed, "p_type", "brands", "ord")


def split_formula(spark, sf_dir):
    tokens = split_pairs(B.pairs(spark, sf_dir))
    return tokens.select(
        "formula", "structure", F.size("tokens").alias("n_tokens"), F.concat_ws(" ", "tokens").alias("symbols")
    )


def pair_rejects(spark, sf_dir):
    """Documents read as formulas; kept are those without exactly two symbols."""
    documents = B.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("formula"))
    return rejected_pairs(documents).select("doc_id", "n_tokens")


def pair_links_query(spark, sf_dir):
    entities = B.entities(spark, sf_dir)
    scores = fit_pca(entities).scores(entities, ["Symbol"])
    return _round(pair_links(B.pairs(spark, sf_dir), scores))


def pair_link_counts(spark, sf_dir):
    entities = B.entities(spark, sf_dir)
    scores = fit_pca(entities).scores(entities, ["Symbol"])
    return link_counts(B.pairs(spark, sf_dir), scores)


# --- labels --------------------------------------------------------------------------


def class_dictionary_query(spark, sf_dir):
    return class_dictionary(B.table(spark, sf_dir, "events"), "event_type")


def one_hot_query(spark, sf_dir):
    return one_hot(B.table(spark, sf_dir, "orders"), "o_orderstatus", keep=["o_orderkey"])


# --- moments and PCA -----------------------------------------------------------------


def correlation_matrix(spark, sf_dir):
    return _round(fit_moments(B.lines(spark, sf_dir)).correlation_df(spark))


def feature_guard(spark, sf_dir):
    """The too-few-features guard on 0, 1 and 2 of the text features: PCA refuses below two usable ones."""
    with kept(B.text_samples(spark, sf_dir)) as table:
        moments = fit_moments(table)
        rows = []
        for size in (0, 1, 2):
            names = list(B.TEXT_FEATURES[:size])
            model = fit_pca(FeatureTable.of(table.df, names, table.label), moments=moments)
            components = int(model.loadings.shape[1])
            rows.append((size, size - len(model.dropped), components, components == 0))
    return spark.createDataFrame(rows, "n_features int, n_usable int, n_components int, refused boolean")


def pca_of_feature_pairs(spark, sf_dir):
    """PCA of every pair of the 64 embedding features, all pairs solved on executors as one job."""
    table = B.vectors(spark, sf_dir)
    moments = fit_moments(table)
    p = len(moments.features)
    names = F.array(*[F.lit(f) for f in moments.features])
    pairs = (
        spark.range(p * p)
        .select(F.col("id").alias("subset_id"), (F.col("id") / p).cast("int").alias("i"), (F.col("id") % p).cast("int").alias("j"))
        .where(F.col("i") < F.col("j"))
        .select("subset_id", F.array(F.get(names, F.col("i")), F.get(names, F.col("j"))).alias("features"))
    )
    return _round(pca_of_subsets(spark, moments, pairs))


def correlation_merged(spark, sf_dir):
    """The correlation matrix in one pass from partial states merged pairwise, no rough mean first."""
    return _round(merged_moments(B.lines(spark, sf_dir)).correlation_df(spark))


def class_feature_sums_merged(spark, sf_dir):
    return _round(merged_moments(B.lines(spark, sf_dir, "l_linestatus")).class_sums_df(spark))


def correlation_matrix_wide(spark, sf_dir):
    return _round(fit_moments(B.vectors(spark, sf_dir)).correlation_df(spark))


def class_feature_sums(spark, sf_dir):
    return _round(fit_moments(B.lines(spark, sf_dir, "l_linestatus")).class_sums_df(spark))


def class_feature_sums_wide(spark, sf_dir):
    return _round(fit_moments(B.vectors(spark, sf_dir)).class_sums_df(spark))


def _size_features(spark, sf_dir) -> FeatureTable:
    df = B.table(spark, sf_dir, "lineitem")
    return FeatureTable.of(df, B.LINE_CATALOG.resolve(df.columns, groups=["size"]).columns)


def pca_fit(spark, sf_dir):
    return _round(fit_pca(_size_features(spark, sf_dir)).loadings_df(spark))


def pca_scores(spark, sf_dir):
    table = _size_features(spark, sf_dir)
    return _round(fit_pca(table).scores(table, B.LINE_KEYS), ROWS)


def pca_explained_variance(spark, sf_dir):
    return _round(fit_pca(_size_features(spark, sf_dir)).explained_variance(spark))


def pca_top_loadings(spark, sf_dir):
    top = fit_pca(_size_features(spark, sf_dir)).top_loadings(spark)
    return _round(top.drop("pc1_loading_text", "pc2_loading_text"))


def pca_by_feature_group(spark, sf_dir):
    return _round(pca_by_group(spark, fit_moments(B.lines(spark, sf_dir)), B.LINE_CATALOG))


# --- PLS-DA --------------------------------------------------------------------------


def _banded(spark, sf_dir, scale: bool = True) -> tuple[FeatureTable, PLSModel]:
    table = B.banded_lines(spark, sf_dir)
    return table, fit_plsda(table, scale=scale)


def plsda_fit(spark, sf_dir):
    return _round(_banded(spark, sf_dir)[1].weights_df(spark))


def plsda_fit_unscaled(spark, sf_dir):
    return _round(_banded(spark, sf_dir, scale=False)[1].weights_df(spark))


def plsda_scores(spark, sf_dir):
    table, model = _banded(spark, sf_dir)
    return _round(model.scores(table, [*B.LINE_KEYS, "band"]), ROWS)


def plsda_variance(spark, sf_dir):
    return _round(_banded(spark, sf_dir)[1].variance(spark))


def plsda_predict(spark, sf_dir):
    table, model = _banded(spark, sf_dir)
    return model.predict(table, [*B.LINE_KEYS, "band"])


def plsda_predict_gaps(spark, sf_dir):
    """Predictions of rows that lack a feature: none."""
    return _banded(spark, sf_dir)[1].predict(B.gapped_lines(spark, sf_dir), [*B.LINE_KEYS, "band"])


def _halved(spark, sf_dir) -> tuple[FeatureTable, PLSModel]:
    table = B.halved_vectors(spark, sf_dir)
    return table, fit_plsda(table)


def plsda_scores_wide(spark, sf_dir):
    table, model = _halved(spark, sf_dir)
    return _round(model.scores(table, ["vec_id", "half"]), ROWS)


def plsda_predict_wide(spark, sf_dir):
    table, model = _halved(spark, sf_dir)
    return model.predict(table, ["vec_id", "half"])


def plsda_top_weights_wide(spark, sf_dir):
    return _round(_halved(spark, sf_dir)[1].top_weights(spark))


def plsda_vip_wide(spark, sf_dir):
    return _round(_halved(spark, sf_dir)[1].vip_df(spark))


def plsda_top_weights(spark, sf_dir):
    top = _banded(spark, sf_dir)[1].top_weights(spark)
    return _round(top.drop("lv1_weight_text", "lv2_weight_text"))


def plsda_vip(spark, sf_dir):
    return _round(_banded(spark, sf_dir)[1].vip_df(spark).drop("vip_text"))


# --- metrics -------------------------------------------------------------------------


def _banded_confusion(spark, sf_dir) -> DataFrame:
    table, model = _banded(spark, sf_dir)
    return M.confusion_matrix(model.predict(table, ["band"]), "band", "prediction")


def confusion_matrix(spark, sf_dir):
    return _banded_confusion(spark, sf_dir)


def accuracy(spark, sf_dir):
    return _round(M.accuracy(_banded_confusion(spark, sf_dir)))


def macro_f1(spark, sf_dir):
    return _round(M.macro_f1(_banded_confusion(spark, sf_dir)))


def silhouette_exact(spark, sf_dir):
    return _round(silhouette(B.vector_points(spark, sf_dir), "x", "y", "label"))


def silhouette_orders(spark, sf_dir):
    """Silhouette of all orders by status: price against customer."""
    points = B.table(spark, sf_dir, "orders").select(
        (F.col("o_totalprice") / 1000).alias("x"), F.col("o_custkey").cast("double").alias("y"), "o_orderstatus"
    )
    return _round(silhouette(points, "x", "y", "o_orderstatus", direct_points=256))


def _order_points(spark, sf_dir):
    return B.table(spark, sf_dir, "orders").select(
        (F.col("o_totalprice") / 1000).alias("x"), F.col("o_custkey").cast("double").alias("y"), "o_orderstatus"
    )


def silhouette_adaptive_orders(spark, sf_dir):
    """Silhouette of all orders by status on the adaptive tree: leaves of their own depth."""
    return _round(silhouette_adaptive(_order_points(spark, sf_dir), "x", "y", "o_orderstatus"))


def silhouette_sampled_orders(spark, sf_dir):
    """Silhouette of all orders by status estimated from 1,000 anchors a status, with a 95 % interval."""
    found = silhouette_sampled(_order_points(spark, sf_dir), "x", "y", "o_orderstatus", per_class=1000, seed=0)
    return _round(found)


def silhouette_lines(spark, sf_dir):
    """Silhouette of all line scores by price band."""
    table, model = _banded(spark, sf_dir)
    return _round(silhouette(model.scores(table, ["band"]), "LV1", "LV2", "band"))


def fisher_ratio(spark, sf_dir):
    table, model = _banded(spark, sf_dir)
    return _round(M.fisher_ratio(model.scores(table, ["band"]), ["LV1", "LV2"], "band"), ROWS)


def metrics_table(spark, sf_dir):
    with kept(B.text_samples(spark, sf_dir)) as table:
        return _round(M.metrics_table(quality(table, fit_plsda(table))))


def metrics_unlabelled(spark, sf_dir):
    """The metrics where some rows have no label, from the model and from the selection."""
    with kept(B.partly_labelled_texts(spark, sf_dir)) as table:
        model = fit_plsda(table, scale=False)
        confusion = M.confusion_matrix(model.predict(table, ["quality"]), "quality", "prediction")
        scored = {s: evaluate_subsets(table, fit_moments(table), [table.features], scoring=s)[0].value for s in ("accuracy", "f1")}
        fisher = M.fisher_ratio(model.scores(table, ["quality"]), ["LV1", "LV2"], "quality")
        rows = [
            ("accuracy", M.accuracy(confusion).first()["accuracy"]),
            ("accuracy_of_selection", scored["accuracy"]),
            ("f1_of_selection", scored["f1"]),
            ("fisher_of_model", model.fisher_ratio),
            ("fisher_of_scores", fisher.first()["fisher_ratio"]),
            ("macro_f1", M.macro_f1(confusion).first()["macro_f1"]),
        ]
    return _round(spark.createDataFrame(rows, "measure string, value double"))


# --- selection -----------------------------------------------------------------------


def evaluate_subset(spark, sf_dir):
    with kept(B.text_samples(spark, sf_dir)) as table:
        moments = fit_moments(table)
        subsets = [table.features[: n + 1] for n in range(1, len(table.features))]
        rows = []
        for scoring in ("accuracy", "f1"):
            scores = evaluate_subsets(table, moments, subsets, scoring=scoring)
            rows += [(scoring, len(s), score.value) for s, score in zip(subsets, scores)]
    return _round(spark.createDataFrame(rows, "scoring string, n_features int, score double"))


def sweep_add_one_query(spark, sf_dir):
    with kept(B.text_samples(spark, sf_dir)) as table:
        return _round(sweep_add_one(table, fit_moments(table), SEED_FEATURES))


def sweep_drop_one_query(spark, sf_dir):
    with kept(B.text_samples(spark, sf_dir)) as table:
        return _round(sweep_drop_one(table, fit_moments(table), table.features))


def _forward(spark, sf_dir):
    source = B.text_samples(spark, sf_dir)
    with kept(source) as table:
        moments = fit_moments(table)
        return source, moments, forward_selection(table, init_features=SEED_FEATURES, moments=moments)


def _backward(spark, sf_dir):
    source = B.text_samples(spark, sf_dir)
    with kept(source) as table:
        moments = fit_moments(table)
        return source, moments, backward_elimination(table, min_features=2, moments=moments)


def forward_selection_query(spark, sf_dir):
    return _round(H.with_joined_names(_forward(spark, sf_dir)[2]))


def backward_elimination_query(spark, sf_dir):
    return _round(_backward(spark, sf_dir)[2])


def replay_forward(spark, sf_dir):
    return H.replay_forward(_forward(spark, sf_dir)[2], REPLAY_SIZE)


def replay_forward_every(spark, sf_dir):
    """The forward set at every size it reached, for a size slider."""
    return H.replay_forward_every(_forward(spark, sf_dir)[2])


def replay_backward(spark, sf_dir):
    table, _, history = _backward(spark, sf_dir)
    return H.replay_backward(history, H.feature_list(spark, table.features), REPLAY_SIZE)


def final_features(spark, sf_dir):
    table, _, history = _backward(spark, sf_dir)
    return H.final_features(history, H.feature_list(spark, table.features))


def scores_at_step(spark, sf_dir):
    table, moments, history = _forward(spark, sf_dir)
    replayed = H.replay_forward(history, REPLAY_SIZE).orderBy("step", "pos").collect()
    names = [r["feature"] for r in replayed]
    return _round(scores_at(table, moments, names, ["doc_id", "quality"]), ROWS)


def scores_at_backward_step(spark, sf_dir):
    table, moments, history = _backward(spark, sf_dir)
    left = H.replay_backward(history, H.feature_list(spark, table.features), REPLAY_SIZE)
    names = [r["feature"] for r in left.orderBy("ord").collect()]
    return _round(scores_at(table, moments, names, ["doc_id", "quality"]), ROWS)


def selection_curve(spark, sf_dir):
    return _round(H.selection_curve(_forward(spark, sf_dir)[2]))


# --- scalar functions ----------------------------------------------------------------


def safe_division_query(spark, sf_dir):
    line = B.table(spark, sf_dir, "lineitem")
    ratio = safe_division(F.col("l_tax"), F.col("l_discount"), default=-1.0)
    return _round(line.select(*B.LINE_KEYS, ratio.alias("ratio")))


def text_symbols(spark, sf_dir):
    """Symbols found in every document, counted over all of them."""
    tokens = B.table(spark, sf_dir, "documents").select(F.explode(formula_tokens(F.col("text"))).alias("symbol"))
    return tokens.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


@cache
def registered() -> dict[str, Query]:
    return {
        "scan_samples": scan_samples,
        "scan_entities": scan_entities,
        "scan_pairs": scan_pairs,
        "catalog_group_sizes": catalog_group_sizes,
        "catalog_on_vectors": catalog_on_vectors,
        "select_feature_group": select_feature_group,
        "column_profile": column_profile,
        "drop_nan_columns": drop_nan_columns,
        "drop_zero_variance": drop_zero_variance,
        "clean_values": clean_values,
        "standardize": standardize,
        "standardize_impute": standardize_impute,
        "category_lookup": category_lookup,
        "invert_categories": invert_category_lists,
        "split_formula": split_formula,
        "text_symbols": text_symbols,
        "pair_rejects": pair_rejects,
        "pair_links": pair_links_query,
        "pair_link_counts": pair_link_counts,
        "class_dictionary": class_dictionary_query,
        "one_hot": one_hot_query,
        "correlation_matrix": correlation_matrix,
        "correlation_matrix_wide": correlation_matrix_wide,
        "correlation_merged": correlation_merged,
        "feature_guard": feature_guard,
        "pca_of_feature_pairs": pca_of_feature_pairs,
        "class_feature_sums_merged": class_feature_sums_merged,
        "class_feature_sums": class_feature_sums,
        "class_feature_sums_wide": class_feature_sums_wide,
        "pca_fit": pca_fit,
        "pca_scores": pca_scores,
        "pca_explained_variance": pca_explained_variance,
        "pca_top_loadings": pca_top_loadings,
        "pca_by_feature_group": pca_by_feature_group,
        "plsda_fit": plsda_fit,
        "plsda_fit_unscaled": plsda_fit_unscaled,
        "plsda_scores": plsda_scores,
        "plsda_variance": plsda_variance,
        "plsda_predict": plsda_predict,
        "plsda_predict_gaps": plsda_predict_gaps,
        "plsda_scores_wide": plsda_scores_wide,
        "plsda_predict_wide": plsda_predict_wide,
        "plsda_top_weights_wide": plsda_top_weights_wide,
        "plsda_vip_wide": plsda_vip_wide,
        "plsda_top_weights": plsda_top_weights,
        "plsda_vip": plsda_vip,
        "confusion_matrix": confusion_matrix,
        "accuracy": accuracy,
        "macro_f1": macro_f1,
        "silhouette_exact": silhouette_exact,
        "silhouette_orders": silhouette_orders,
        "silhouette_lines": silhouette_lines,
        "silhouette_adaptive_orders": silhouette_adaptive_orders,
        "silhouette_sampled_orders": silhouette_sampled_orders,
        "fisher_ratio": fisher_ratio,
        "metrics_table": metrics_table,
        "metrics_unlabelled": metrics_unlabelled,
        "evaluate_subset": evaluate_subset,
        "sweep_add_one": sweep_add_one_query,
        "sweep_drop_one": sweep_drop_one_query,
        "forward_selection": forward_selection_query,
        "backward_elimination": backward_elimination_query,
        "replay_forward": replay_forward,
        "replay_forward_every": replay_forward_every,
        "replay_backward": replay_backward,
        "final_features": final_features,
        "scores_at_step": scores_at_step,
        "scores_at_backward_step": scores_at_backward_step,
        "selection_curve": selection_curve,
        "safe_division": safe_division_query,
    }
