"""Linear combinations of standardised features, row by row."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covaria.functions import argmax_first, column, total
from covaria.operators.features import FeatureTable, matrix
from covaria.operators.profile import Scaling, standardize_finite_block, standardized_finite

# Up to this many terms the combinations are column expressions; beyond, one matrix
# product per Arrow batch. Measured on 2 million rows, expressions win up to 64 terms and
# fall far behind soon after, when generated code outgrows the JIT.
EXPRESSION_LIMIT = 64


MISSING = ("null", "impute")


def _imputes(scaling: Scaling, missing: str | None) -> bool:
    """Whether missing values count as the mean; by default as the scaling's own rows did."""
    if missing is None:
        return not scaling.complete
    if missing not in MISSING:
        raise ValueError(f"missing must be one of {MISSING}, got {missing!r}")
    return missing == "impute"


def project(
    table: FeatureTable,
    scaling: Scaling,
    weights: np.ndarray,
    names: Sequence[str],
    keep: Sequence[str] = (),
    offset: np.ndarray | None = None,
    missing: str | None = None,
) -> DataFrame:
    """``keep`` columns, then ``names[a] = offset[a] + sum_j z_j * weights[j, a]``.

    ``scaling`` may cover only some of the table's features; the rest are not read. A row
    with a NULL, NaN or infinite feature gets NULLs (``missing="null"``), or such values
    count as the mean (``"impute"``). The default imputes if the model was fitted on rows
    with missing values.
    """
    offset = np.zeros(len(names)) if offset is None else offset
    impute = _imputes(scaling, missing)
    if table.array is None and weights.size <= EXPRESSION_LIMIT:
        kept = [column(k) for k in keep]
        # Standardise once, then combine: both steps end up in one generated loop.
        z = table.df.select(
            *kept,
            *[standardized_finite(table, scaling, f, impute).alias(f"__z{j}") for j, f in enumerate(scaling.features)],
        )
        combined = [
            (
                total([F.col(f"__z{j}") * F.lit(float(weights[j, a])) for j in range(len(scaling.features))])
                + F.lit(float(offset[a]))
            ).alias(name)
            for a, name in enumerate(names)
        ]
        return z.select(*kept, *combined)

    def append(x: np.ndarray):
        z, absent = standardize_finite_block(x, scaling, impute)
        scores = z @ weights + offset
        return [pa.array(np.ascontiguousarray(scores[:, a]), mask=absent) for a in range(scores.shape[1])]

    fields = [T.StructField(n, T.DoubleType()) for n in names]
    return _append_in_arrow(table, scaling, keep, fields, append)


def class_type(table: FeatureTable, classes: Sequence) -> T.DataType:
    """Type of predictions: the label's, or what the classes themselves say."""
    if table.label is not None and table.label in table.df.columns:
        return table.df.schema[table.label].dataType
    if all(isinstance(c, bool) for c in classes):
        return T.BooleanType()
    if all(isinstance(c, int) for c in classes):
        return T.LongType()
    if all(isinstance(c, float) for c in classes):
        return T.DoubleType()
    return T.StringType()


def classify(
    table: FeatureTable,
    scaling: Scaling,
    weights: np.ndarray,
    offset: np.ndarray,
    classes: Sequence[str],
    keep: Sequence[str] = (),
    name: str = "prediction",
    missing: str | None = None,
) -> DataFrame:
    """``keep`` columns, then the class with the largest response (the first on a tie).

    A row that cannot be scored has no class (see ``project``).
    """
    k = len(classes)
    type_ = class_type(table, classes)
    lookup = F.array(*[F.lit(c).cast(type_) for c in classes])
    kept = [column(c) for c in keep]
    if table.array is None and weights.size <= EXPRESSION_LIMIT:
        names = [f"__y{c}" for c in range(k)]
        scored = project(table, scaling, weights, names, keep, offset, missing)
        # Rows without responses are told apart first: a position in an array of literals
        # is never NULL to the optimiser.
        responses = scored.select(
            *kept, F.col(names[0]).isNotNull().alias("__known"), F.array(*[F.col(n) for n in names]).alias("__responses")
        )
        best = F.element_at(lookup, F.coalesce(argmax_first(F.col("__responses")), F.lit(1)))
        return responses.select(*kept, F.when(F.col("__known"), best).alias(name))
    impute = _imputes(scaling, missing)

    def append(x: np.ndarray):
        z, absent = standardize_finite_block(x, scaling, impute)
        best = np.argmax(z @ weights + offset, axis=1) + 1
        return [pa.array(best.astype(np.int32), mask=absent)]

    predicted = _append_in_arrow(table, scaling, keep, [T.StructField("__class", T.IntegerType())], append)
    best = F.element_at(lookup, F.coalesce(F.col("__class"), F.lit(1)))
    return predicted.select(*kept, F.when(F.col("__class").isNotNull(), best).alias(name))


def _append_in_arrow(table: FeatureTable, scaling: Scaling, keep, fields, append) -> DataFrame:
    """Carry ``keep`` through Arrow batches and append what ``append`` computes."""
    schema = T.StructType([table.df.schema[k] for k in keep] + list(fields))
    names = [f.name for f in schema.fields]
    width = len(scaling.features)
    if table.array is None:
        x = F.array(*[table.value(f) for f in scaling.features])
        pick = None
    else:
        x, width = table.vector(), len(table.features)
        at = {f: i for i, f in enumerate(table.features)}
        pick = [at[f] for f in scaling.features]
        if pick == list(range(width)):
            pick = None

    def run(batches):
        for batch in batches:
            block = matrix(batch.column(batch.num_columns - 1), width)
            if pick is not None:
                block = block[:, pick]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(kept + append(block), names=names)

    return table.df.select(*[column(k) for k in keep], x.alias("__x")).mapInArrow(run, schema)
