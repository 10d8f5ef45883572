"""Quality of a classification and separation of classes in score space."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covaria.functions import column, display_number, total


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``label, prediction, n`` for every combination that occurs; rows without a label are left out.

    A row without a prediction counts as one that was not recognised.
    """
    return df.where(column(label).isNotNull()).groupBy(
        column(label).alias("label"), column(prediction).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def accuracy(confusion: DataFrame) -> DataFrame:
    """One row ``accuracy`` from confusion counts; a missing prediction is never a hit."""
    hit = F.coalesce(F.col("label") == F.col("prediction"), F.lit(False))
    return confusion.agg((F.sum(F.when(hit, F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))


def class_f1(confusion: DataFrame) -> DataFrame:
    """``label, tp, fp, fn, f1`` of every class seen as label or as prediction."""
    n, hit = F.col("n"), F.coalesce(F.col("label") == F.col("prediction"), F.lit(False))
    zero = F.lit(0).cast("long")
    sides = confusion.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("label").alias("label"),
                    F.when(hit, n).otherwise(zero).alias("tp"),
                    zero.alias("fp"),
                    F.when(hit, zero).otherwise(n).alias("fn"),
                ),
                F.struct(
                    F.col("prediction").alias("label"),
                    zero.alias("tp"),
                    F.when(hit, zero).otherwise(n).alias("fp"),
                    zero.alias("fn"),
                ),
            )
        )
    )
    summed = sides.where(F.col("label").isNotNull()).groupBy("label").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    denominator = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return summed.withColumn("f1", F.when(denominator > 0, 2 * F.col("tp") / denominator).otherwise(0.0))


def macro_f1(confusion: DataFrame) -> DataFrame:
    """One row ``macro_f1``: the unweighted mean of the class F1 values."""
    return class_f1(confusion).agg(F.avg("f1").alias("macro_f1"))


def hits_and_f1(confusion: DataFrame) -> DataFrame:
    """One row ``accuracy, macro_f1``, from one pass over the counts."""
    summed = class_f1(confusion)
    rows = F.sum(F.col("tp") + F.col("fn"))
    return summed.agg((F.sum("tp") / rows).alias("accuracy"), F.avg("f1").alias("macro_f1"))


def fisher_ratio(df: DataFrame, coordinates: Sequence[str], label: str) -> DataFrame:
    """One row ``between, within, fisher_ratio`` (NULL if within-class scatter vanishes).

    Rows without a label or with a missing coordinate are left out.

    One pass to per-class counts, means and variances; the rest works on one small
    struct per class.
    """
    dims = range(len(coordinates))
    for name in (label, *coordinates):
        df = df.where(column(name).isNotNull())
    for name in coordinates:
        df = df.where(~F.isnan(column(name)))
    per_class = df.groupBy(column(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(column(c)).alias(f"m{d}") for d, c in enumerate(coordinates)],
        *[F.var_pop(column(c)).alias(f"v{d}") for d, c in enumerate(coordinates)],
    )
    overall = per_class.agg(
        F.sum(F.col("n") * total([F.col(f"v{d}") for d in dims])).alias("within"),
        F.collect_list(F.struct("n", *[f"m{d}" for d in dims])).alias("classes"),
        *[(F.sum(F.col("n") * F.col(f"m{d}")) / F.sum("n")).alias(f"o{d}") for d in dims],
    )

    def add(acc, c):
        away = total([(c[f"m{d}"] - F.col(f"o{d}")) * (c[f"m{d}"] - F.col(f"o{d}")) for d in dims])
        return acc + c["n"] * away

    between = F.aggregate("classes", F.lit(0.0), add)
    ratio = F.when(F.col("within") > 1e-6, F.col("between") / F.col("within"))
    return (
        overall.select(between.alias("between"), "within")
        .select("between", "within", ratio.alias("fisher_ratio"))
    )


# Names of the measures, in their order.
METRIC_NAMES = ("Accuracy", "F1 Score", "Silhouette", "Fisher Ratio")


def metrics_table(values: DataFrame) -> DataFrame:
    """``ord, metric, value, value_text`` from one row ``accuracy, macro_f1, silhouette, fisher_ratio``."""
    columns = ("accuracy", "macro_f1", "silhouette", "fisher_ratio")
    entries = [
        F.struct(F.lit(i).alias("ord"), F.lit(name).alias("metric"), F.col(c).cast("double").alias("value"))
        for i, (name, c) in enumerate(zip(METRIC_NAMES, columns))
    ]
    long = values.select(F.inline(F.array(*entries)))
    return long.withColumn("value_text", display_number(F.col("value")))
