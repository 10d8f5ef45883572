"""The input of every numeric operator: a DataFrame and the features in it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covaria.functions import column

# Up to this many features, aggregates are written as one JVM expression per column or
# column pair. Beyond it the generated code outgrows what the JIT compiles well: measured
# on 2 million rows, batches win from 8 features on, and by six times at 24.
NARROW_LIMIT = 6


@dataclass(frozen=True)
class FeatureTable:
    """``features`` name either columns of ``df`` or the entries of its ``array`` column.

    The array form suits tables with hundreds or thousands of features. Row identity
    travels in ``df`` itself: operators carry whichever columns the caller keeps, so
    results never have to be joined back by position or key.
    """

    df: DataFrame
    features: tuple[str, ...]
    label: str | None = None
    array: str | None = None

    def __post_init__(self):
        if len(set(self.features)) != len(self.features):
            raise ValueError("feature names must be unique")
        if self.array is None:
            absent = [f for f in self.features if f not in self.df.columns]
            if absent:
                raise ValueError(f"table lacks features {absent}")

    @classmethod
    def of(
        cls,
        df: DataFrame,
        features: Sequence[str],
        label: str | None = None,
        array: str | None = None,
    ) -> FeatureTable:
        return cls(df, tuple(features), label, array)

    @property
    def narrow(self) -> bool:
        return self.array is None and len(self.features) <= NARROW_LIMIT

    def value(self, name: str) -> Column:
        """One feature as a double column."""
        if self.array is None:
            return column(name).cast("double")
        return F.get(column(self.array), F.lit(self.features.index(name))).cast("double")

    def vector(self) -> Column:
        """All features as one ``ARRAY<DOUBLE>`` column."""
        if self.array is not None:
            return column(self.array).cast("array<double>")
        return F.array(*[self.value(f) for f in self.features])

    def labelled(self) -> FeatureTable:
        """The rows that have a label; without a label column all of them.

        Fits and measures of a classification leave out rows without a label.
        """
        return self if self.label is None else self.with_df(self.df.where(column(self.label).isNotNull()))

    def with_df(self, df: DataFrame) -> FeatureTable:
        return replace(self, df=df)


@contextmanager
def kept(table: FeatureTable) -> Iterator[FeatureTable]:
    """The table with its rows stored while the block runs.

    Worth it where many passes follow and rows are costly to derive (joins, text). A table
    that is a plain scan is better read again: column pruning makes that cheap.
    """
    if table.df.is_cached:  # the caller's to release
        yield table
        return
    stored = table.df.persist()
    try:
        yield table.with_df(stored)
    finally:
        stored.unpersist()


def matrix(batch_column: pa.Array, width: int) -> np.ndarray:
    """Rows x ``width`` matrix of an Arrow list column; NULL entries become NaN."""
    if isinstance(batch_column, pa.ChunkedArray):
        batch_column = batch_column.combine_chunks()
    flat = batch_column.flatten().to_numpy(zero_copy_only=False)
    rows = len(batch_column)
    if batch_column.null_count or flat.size != rows * width:
        raise ValueError(f"every row needs an array of exactly {width} numbers")
    return flat.astype(np.float64, copy=False).reshape(rows, width)
