"""Class labels: dictionary and one-hot columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covaria.functions import column
from covaria.operators.moments import MAX_CLASSES


def class_labels(df: DataFrame, label: str) -> list:
    """Distinct labels in ascending order; a missing label is not a class."""
    found = df.select(column(label).alias("label")).where(F.col("label").isNotNull()).distinct()
    labels = sorted(r["label"] for r in found.limit(MAX_CLASSES + 1).collect())
    if len(labels) > MAX_CLASSES:
        raise ValueError(f"label {label!r} has more than {MAX_CLASSES} distinct values")
    return labels


def class_dictionary(df: DataFrame, label: str) -> DataFrame:
    """``class_index, label``: indices count from 0 in label order."""
    type_ = df.schema[label].dataType.simpleString()
    rows = list(enumerate(class_labels(df, label)))
    return df.sparkSession.createDataFrame(rows, f"class_index int, label {type_}")


def one_hot(
    df: DataFrame, label: str, classes: Sequence | None = None, keep: Sequence[str] = (), prefix: str = "is_"
) -> DataFrame:
    """``keep`` columns and a 0/1 double column per class; a missing label is all zero."""
    classes = class_labels(df, label) if classes is None else classes
    flags = [
        F.coalesce((column(label) == F.lit(c)).cast("double"), F.lit(0.0)).alias(f"{prefix}{c}")
        for c in classes
    ]
    return df.select(*[column(k) for k in keep], *flags)
