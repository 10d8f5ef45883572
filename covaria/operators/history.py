"""Replay of selection histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from covaria.functions import join_names, split_names

FORWARD_SCHEMA = "step int, accuracy double, feature_added array<string>, total_features int"
BACKWARD_SCHEMA = "step int, accuracy double, feature_removed string, total_features int"


def feature_list(spark: SparkSession, features: Sequence[str]) -> DataFrame:
    """``ord, feature``."""
    return spark.createDataFrame(list(enumerate(features)), "ord int, feature string")


def with_joined_names(history: DataFrame) -> DataFrame:
    """Forward history with its array of names as comma-joined text."""
    return history.withColumn("feature_added", join_names(F.col("feature_added")))


def with_split_names(history: DataFrame) -> DataFrame:
    """Forward history read from text, its comma-joined names as an array again."""
    return history.withColumn("feature_added", split_names(F.col("feature_added")))


def replay_forward(history: DataFrame, total_features: int) -> DataFrame:
    """``step, pos, feature``: the set when it first had this size, in order of arrival.

    No row if no step had this size.
    """
    reached = history.where(F.col("total_features") == total_features).agg(F.min("step"))
    upto = history.where(F.col("step") <= reached.scalar())
    return upto.select("step", F.posexplode("feature_added").alias("pos", "feature"))


def replay_forward_every(history: DataFrame, run: str | None = None) -> DataFrame:
    """``[run,] step, total_features, features``: the set at every size it reached, in order of arrival.

    One row per run and size, from the first step that reached it. The set is a running frame
    over the steps' arrays, flattened; a history holds a step per feature at most, so a frame
    is bounded by the number of features. Without ``run`` the history is one run.
    """
    keys = [] if run is None else [F.col(run)]
    running = Window.partitionBy(*keys).orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sets = history.select(
        *keys, "step", "total_features", F.flatten(F.collect_list("feature_added").over(running)).alias("features")
    )
    first = Window.partitionBy(*keys, "total_features").orderBy("step")
    return (
        sets.withColumn("r", F.row_number().over(first))
        .where(F.col("r") == 1)
        .select(*keys, "step", "total_features", join_names(F.col("features")).alias("features"))
    )


def replay_backward(history: DataFrame, features: DataFrame, total_features: int) -> DataFrame:
    """``ord, feature``: what is left of ``features`` once the set is this small.

    A size never reached leaves the smallest set on record.
    """
    gone = history.where(
        (F.col("feature_removed") != "") & (F.col("total_features") >= total_features)
    ).select(F.col("feature_removed").alias("feature"))
    return features.join(gone, "feature", "left_anti").select("ord", "feature")


def final_features(history: DataFrame, features: DataFrame) -> DataFrame:
    """One row ``n_features, features, summary``: what elimination kept, in order."""
    left = replay_backward(history, features, 0)
    listed = left.agg(
        F.count(F.lit(1)).alias("n_features"),
        F.array_sort(F.collect_list(F.struct("ord", "feature"))).alias("kept"),
    )
    text = F.array_join(F.transform("kept", lambda k: k["feature"]), ", ")
    return listed.select("n_features", text.alias("features")).withColumn(
        "summary", F.format_string("Final %d features: %s", F.col("n_features"), F.col("features"))
    )


def size_bounds(history: DataFrame) -> DataFrame:
    """One row ``low, high``: smallest and largest set on record."""
    return history.agg(F.min("total_features").alias("low"), F.max("total_features").alias("high"))


def selection_curve(history: DataFrame) -> DataFrame:
    """``step, total_features, accuracy`` and the axis range, one beyond the sizes seen."""
    bounds = size_bounds(history)
    return history.select(
        "step",
        "total_features",
        "accuracy",
        (bounds.select("low").scalar() - 1).alias("axis_low"),
        (bounds.select("high").scalar() + 1).alias("axis_high"),
    )
