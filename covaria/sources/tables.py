"""Readers for the three table shapes. Any built-in Spark format works.

Readers project to the wanted columns at once, so columnar formats read nothing else.
Give text formats an explicit schema; without one every column is a string there and
the readers cast the features to double.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covaria.functions import column


# Columns that tell where a row was read.
POSITION = ("source_file", "source_row")


def _load(spark: SparkSession, path, fmt: str, schema: T.StructType | None, options: dict) -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path)


def _doubles(df: DataFrame, names: Sequence[str]):
    return [column(n).cast("double").alias(n) for n in names]


def read_samples(
    spark: SparkSession,
    path,
    label: str = "Class",
    features: Sequence[str] | None = None,
    keys: Sequence[str] = (),
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options,
) -> DataFrame:
    """Labelled samples: keys, label, then features as doubles.

    Without ``features`` every column but the label and the keys is a feature.
    """
    df = _load(spark, path, fmt, schema, options)
    if features is None:
        features = [c for c in df.columns if c != label and c not in keys]
    return df.select(*[column(k) for k in keys], column(label), *_doubles(df, features))


def read_entities(
    spark: SparkSession,
    path,
    key: str = "Symbol",
    features: Sequence[str] | None = None,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    with_position: bool = False,
    **options,
) -> DataFrame:
    """Entities: key as string, then features as doubles.

    ``with_position`` (Parquet only) adds ``POSITION``, the file and the row in it: the
    order in which the first of several rows with one key is meant.
    """
    df = _load(spark, path, fmt, schema, options)
    if features is None:
        features = [c for c in df.columns if c != key]
    position = []
    if with_position:
        file, row = POSITION
        position = [F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row)]
    return df.select(column(key).cast("string").alias(key), *_doubles(df, features), *position)


def read_pairs(
    spark: SparkSession,
    path,
    formula: str = "Formula",
    structure: str = "Structure type",
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options,
) -> DataFrame:
    """Pairs as ``formula, structure``; no other column is read."""
    df = _load(spark, path, fmt, schema, options)
    return df.select(column(formula).alias("formula"), column(structure).alias("structure"))


def read_table(
    spark: SparkSession, path, fmt: str = "parquet", schema: T.StructType | None = None, **options
) -> DataFrame:
    """The whole table, all columns."""
    return _load(spark, path, fmt, schema, options)


def split_label(df: DataFrame, label: str) -> tuple[list[str], str]:
    """Feature names (every column but the label, in table order) and the label name."""
    if label not in df.columns:
        raise ValueError(f"no label column {label!r}")
    return [c for c in df.columns if c != label], label
