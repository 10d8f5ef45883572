"""Second moments of standardised features, and their cross moments with class labels.

Every model here depends on the rows only through these sums. They are additive, so a
pass with partial aggregation gives them, and a model of any subset of the features is
fitted from a submatrix without touching the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covaria.functions import INFINITY, column, finite
from covaria.operators.features import FeatureTable, matrix
from covaria.operators.profile import Scaling

# A class label needs a model column; more distinct labels than this is a mistake such as
# a key column passed as label, and is refused rather than collected.
MAX_CLASSES = 10_000

# Moments above this many features would not fit the driver comfortably (p * p doubles).
MAX_FEATURES = 8_192


@dataclass(frozen=True)
class Moments:
    scaling: Scaling
    gram: np.ndarray  # Z'Z, features x features
    classes: tuple = ()  # distinct labels, ascending
    class_counts: np.ndarray | None = None  # rows of each class
    class_sums: np.ndarray | None = None  # Z'Y transposed, classes x features

    @property
    def features(self) -> tuple[str, ...]:
        return self.scaling.features

    @property
    def n_rows(self) -> int:
        return self.scaling.n_rows

    def subset(self, names: Sequence[str]) -> Moments:
        ix = self.scaling.position(names)
        return Moments(
            self.scaling.subset(names),
            self.gram[np.ix_(ix, ix)],
            self.classes,
            self.class_counts,
            None if self.class_sums is None else self.class_sums[:, ix],
        )

    def correlation(self) -> np.ndarray:
        return self.gram / max(self.n_rows, 1)

    def correlation_df(self, spark: SparkSession) -> DataFrame:
        """Upper triangle as ``feature_i, feature_j, correlation``."""
        r, names = self.correlation(), self.features
        rows = [
            (names[i], names[j], float(r[i, j]))
            for i in range(len(names))
            for j in range(i, len(names))
        ]
        return spark.createDataFrame(rows, "feature_i string, feature_j string, correlation double")

    def class_sums_df(self, spark: SparkSession) -> DataFrame:
        """Sums of standardised values as ``label, n_rows, feature, z_sum``."""
        rows = [
            (str(c), int(self.class_counts[k]), f, float(self.class_sums[k, j]))
            for k, c in enumerate(self.classes)
            for j, f in enumerate(self.features)
        ]
        return spark.createDataFrame(rows, "label string, n_rows long, feature string, z_sum double")


def fit_moments(table: FeatureTable, scaling: Scaling | None = None) -> Moments:
    """Moments of all features of the table's labelled rows; missing values count as the mean.

    One pass as a rule. It adds up products of values shifted by a rough mean, and the
    profile along with them; the exact mean is put in afterwards. A second pass over
    values standardised exactly follows only where that is not enough: with missing or
    infinite values, or where the rough mean was so far off that digits would be lost.
    With ``scaling`` given there is just the pass over standardised values.
    """
    table = table.labelled()
    if len(table.features) > MAX_FEATURES:
        raise ValueError(f"{len(table.features)} features; moments are kept for at most {MAX_FEATURES}")
    if scaling is not None:
        if scaling.features != table.features:
            raise ValueError("the scaling was fitted on other features")
        sums = _add_up(table, scaling.mean, scaling.scale, measure=False)
        return _moments(table, scaling, sums.gram, sums.by_class)
    centre = _rough_mean(table)
    scale = np.ones(len(centre))
    sums = _add_up(table, centre, scale, measure=True)
    scaling = _scaling(table.features, centre, scale, sums)
    if not scaling.complete or _digits_lost(centre, scaling):
        centre, scale = scaling.mean, scaling.scale
        exact = _add_up(table, centre, scale, measure=False)
        sums = replace(sums, gram=exact.gram, by_class=exact.by_class)
        scaling = _scaling(table.features, centre, scale, sums)
    return _centred(table, centre, scale, sums, scaling)


# The shift may miss the mean by this many deviations; products then lose two digits.
SHIFT_TOLERANCE = 10.0

# Rows the rough mean is taken from. It decides how well sums are conditioned, not what
# they amount to.
ROUGH_ROWS = 64


@dataclass(frozen=True)
class _Sums:
    """What one pass adds up, for values shifted and scaled by known constants."""

    n_rows: int
    gram: np.ndarray
    by_class: dict  # label -> rows, sums of values; all rows under None without a label
    n_missing: np.ndarray | None = None
    n_inf: np.ndarray | None = None
    low: np.ndarray | None = None  # smallest finite value, before shifting
    high: np.ndarray | None = None


def _rough_mean(table: FeatureTable) -> np.ndarray:
    rows = table.df.select(table.vector().alias("x")).limit(ROUGH_ROWS).collect()
    mean = np.zeros(len(table.features))
    if rows:
        x = np.array([[np.nan if v is None else v for v in r["x"] or ()] for r in rows], dtype=np.float64)
        ok = np.isfinite(x)
        count = ok.sum(axis=0)
        mean = np.where(ok, x, 0.0).sum(axis=0) / np.maximum(count, 1)
    return mean


def _scaling(features: tuple[str, ...], centre: np.ndarray, scale: np.ndarray, sums: _Sums) -> Scaling:
    """Profile from sums over values shifted by ``centre`` and divided by ``scale``."""
    valid = sums.n_rows - sums.n_missing - sums.n_inf
    off = _off_centre(sums)
    spread = np.maximum(np.diag(sums.gram) / np.maximum(valid, 1) - off**2, 0.0)
    constant = (sums.low == sums.high) & (valid > 1)
    return Scaling(
        features,
        sums.n_rows,
        sums.n_missing,
        sums.n_inf,
        np.where(valid > 0, centre + off * scale, 0.0),
        np.where(constant | (valid == 0), 0.0, np.sqrt(spread) * scale),
        constant,
    )


def _off_centre(sums: _Sums) -> np.ndarray:
    """Mean of the shifted and scaled values that are present."""
    count = np.maximum(sums.n_rows - sums.n_missing - sums.n_inf, 1)
    return sum((np.asarray(s) for _, s in sums.by_class.values()), np.zeros(len(count))) / count


def _digits_lost(centre: np.ndarray, scaling: Scaling) -> bool:
    far = np.abs(scaling.mean - centre) > SHIFT_TOLERANCE * scaling.std_pop
    return bool((far & ~scaling.constant & (scaling.n_valid > 1)).any())


def _centred(
    table: FeatureTable, centre: np.ndarray, scale: np.ndarray, sums: _Sums, scaling: Scaling
) -> Moments:
    """Moments of standardised values from sums over nearly standardised ones.

    With values missing the sums were taken around the exact mean, where the correction
    made here is no more than rounding.
    """
    live = np.where(scaling.constant, 0.0, scale / scaling.scale)
    off = np.where(scaling.constant, 0.0, _off_centre(sums))
    gram = (sums.gram - sums.n_rows * np.outer(off, off)) * np.outer(live, live)
    by_class = {c: (n, (np.asarray(s) - n * off) * live) for c, (n, s) in sums.by_class.items()}
    return _moments(table, scaling, gram, by_class)


def _moments(table: FeatureTable, scaling: Scaling, gram: np.ndarray, by_class: dict) -> Moments:
    if table.label is None:
        return Moments(scaling, gram)
    if len(by_class) > MAX_CLASSES:
        raise ValueError(f"label {table.label!r} has more than {MAX_CLASSES} distinct values")
    classes = tuple(sorted(c for c in by_class if c is not None))
    return Moments(
        scaling,
        gram,
        classes,
        np.array([by_class[c][0] for c in classes], dtype=np.int64),
        np.array([by_class[c][1] for c in classes], dtype=np.float64).reshape(len(classes), len(table.features)),
    )


def _add_up(table: FeatureTable, mean: np.ndarray, scale: np.ndarray, measure: bool) -> _Sums:
    if table.narrow:
        return _add_up_columns(table, mean, scale, measure)
    return _add_up_batches(table, mean, scale, measure)


def _add_up_columns(table: FeatureTable, mean: np.ndarray, scale: np.ndarray, measure: bool) -> _Sums:
    """JVM aggregates, grouped by the label (few groups, combined before the shuffle)."""
    p = len(table.features)
    upper = [(i, j) for i in range(p) for j in range(i, p)]
    label = F.lit(None) if table.label is None else column(table.label)
    values = [label.alias("label")]
    for j, name in enumerate(table.features):
        x = table.value(name)
        z = (finite(x) - F.lit(float(mean[j]))) / F.lit(float(scale[j]))
        values.append(F.coalesce(z, F.lit(0.0)).alias(f"z{j}"))
        if measure:
            values.append(x.alias(f"x{j}"))
    z = table.df.select(*values)
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [F.sum(f"z{i}").alias(f"s{i}") for i in range(p)]
    sums += [F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"g{i}_{j}") for i, j in upper]
    if measure:
        for j in range(p):
            x = F.col(f"x{j}")
            sums += [
                F.count(F.when(x.isNull() | F.isnan(x), 1)).alias(f"m{j}"),
                F.count(F.when(F.abs(x) == F.lit(INFINITY), 1)).alias(f"i{j}"),
                F.min(finite(x)).alias(f"a{j}"),
                F.max(finite(x)).alias(f"b{j}"),
            ]
    grouped = z.agg(*sums) if table.label is None else z.groupBy("label").agg(*sums)
    gram, by_class, n_rows = np.zeros((p, p)), {}, 0
    missing, infinite = np.zeros(p), np.zeros(p)
    low, high = np.full(p, np.inf), np.full(p, -np.inf)
    for row in grouped.limit(MAX_CLASSES + 2).collect():
        if not row["n"]:
            continue
        n_rows += row["n"]
        for i, j in upper:
            gram[i, j] += row[f"g{i}_{j}"]
        by_class[None if table.label is None else row["label"]] = (row["n"], [row[f"s{i}"] for i in range(p)])
        if measure:
            missing += [row[f"m{j}"] for j in range(p)]
            infinite += [row[f"i{j}"] for j in range(p)]
            low = np.minimum(low, [np.inf if row[f"a{j}"] is None else row[f"a{j}"] for j in range(p)])
            high = np.maximum(high, [-np.inf if row[f"b{j}"] is None else row[f"b{j}"] for j in range(p)])
    return _Sums(n_rows, gram + np.triu(gram, 1).T, by_class, missing, infinite, low, high)


# Gram matrices all tasks of a pass may emit together. Tasks are never merged to fewer
# than MIN_TASKS for it; more than MANY_TASKS would be allowed for moderate widths, where
# nothing needs merging.
EMITTED_BYTES = 2**40
MIN_TASKS = 8_192
MANY_TASKS = 200_000

# Rows a task emits besides one for each feature, told apart by a negative number.
_CLASS, _MISSING, _INFINITE, _LOW, _HIGH = -1, -2, -3, -4, -5


def _add_up_batches(table: FeatureTable, mean: np.ndarray, scale: np.ndarray, measure: bool) -> _Sums:
    """Arrow batches: each task adds up its own Gram matrix and class sums.

    A task emits one row per feature and per class it met; Spark adds the rows up. Where
    many features meet many input splits, splits are first merged without a shuffle into
    as many tasks as keep the emitted volume within ``EMITTED_BYTES``.
    """
    p = len(table.features)
    label_type = T.StringType() if table.label is None else table.df.schema[table.label].dataType
    label = F.lit(None).cast(label_type) if table.label is None else column(table.label)
    schema = T.StructType(
        [
            T.StructField("ord", T.IntegerType()),
            T.StructField("label", label_type),
            T.StructField("n", T.LongType()),
            T.StructField("sums", T.ArrayType(T.DoubleType())),
        ]
    )

    def partial(batches):
        gram = np.zeros((p, p))
        missing, infinite = np.zeros(p), np.zeros(p)
        low, high = np.full(p, np.inf), np.full(p, -np.inf)
        classes: dict = {}
        arrow_label = None
        for batch in batches:
            if not batch.num_rows:
                continue
            arrow_label = batch.column(0).type
            x = matrix(batch.column(1), p)
            usable = np.isfinite(x)
            whole = usable.all()
            if measure:
                if not whole:
                    missing += np.isnan(x).sum(axis=0)
                    infinite += np.isinf(x).sum(axis=0)
                low = np.minimum(low, (x if whole else np.where(usable, x, np.inf)).min(axis=0))
                high = np.maximum(high, (x if whole else np.where(usable, x, -np.inf)).max(axis=0))
            z = (x - mean) / scale
            if not whole:
                z[~usable] = 0.0
            gram += z.T @ z
            _add_class_sums(classes, batch.column(0), z)
            if len(classes) > MAX_CLASSES:  # a key passed as label: stop before vectors pile up
                raise ValueError(f"label has more than {MAX_CLASSES} distinct values in one task")
        if arrow_label is not None:
            extra = [(_MISSING, missing), (_INFINITE, infinite), (_LOW, -low), (_HIGH, high)] if measure else []
            yield _partial_rows(gram, classes, extra, arrow_label)

    source = table.df.select(label.alias("label"), table.vector().alias("x"))
    tasks = max(MIN_TASKS, EMITTED_BYTES // (8 * p * p))
    if tasks < MANY_TASKS:
        source = source.coalesce(tasks)
    both = Summarizer.metrics("sum", "max").summary(array_to_vector(F.col("sums"))).alias("both")
    added = (
        source.mapInArrow(partial, schema)
        .groupBy("ord", "label")
        .agg(F.sum("n").alias("n"), both)
        .select("ord", "label", "n", *[vector_to_array(F.col(f"both.{m}")).alias(m) for m in ("sum", "max")])
    )
    gram, by_class, extra = np.zeros((p, p)), {}, {}
    for row in added.limit(p + MAX_CLASSES + 6).collect():
        if row["ord"] >= 0:
            gram[row["ord"]] = row["sum"]
        elif row["ord"] == _CLASS:
            by_class[row["label"]] = (row["n"], row["sum"])
        else:
            extra[row["ord"]] = np.array(row["max" if row["ord"] in (_LOW, _HIGH) else "sum"])
    n_rows = sum(n for n, _ in by_class.values())
    zero = np.zeros(p)
    return _Sums(
        n_rows,
        (gram + gram.T) / 2,
        by_class,
        extra.get(_MISSING, zero),
        extra.get(_INFINITE, zero),
        -extra.get(_LOW, zero),
        extra.get(_HIGH, zero),
    )


def _add_class_sums(classes: dict, labels: pa.Array, z: np.ndarray) -> None:
    coded = labels.dictionary_encode(null_encoding="encode")
    codes = coded.indices.to_numpy(zero_copy_only=False)
    names = coded.dictionary.to_pylist()
    order = np.argsort(codes, kind="stable")
    met, starts, counts = np.unique(codes[order], return_index=True, return_counts=True)
    sums = np.add.reduceat(z[order], starts, axis=0)
    for k, name in enumerate(names[i] for i in met):
        n, s = classes.get(name, (0, 0.0))
        classes[name] = (n + int(counts[k]), s + sums[k])


def _partial_rows(gram: np.ndarray, classes: dict, extra: list, label_type: pa.DataType) -> pa.RecordBatch:
    p = len(gram)
    ords = [*range(p), *[_CLASS] * len(classes), *[kind for kind, _ in extra]]
    labels = [*[None] * p, *classes, *[None] * len(extra)]
    counts = [*[0] * p, *[n for n, _ in classes.values()], *[0] * len(extra)]
    sums = np.concatenate([gram.ravel(), *[s for _, s in classes.values()], *[v for _, v in extra]])
    offsets = np.arange(0, sums.size + 1, p, dtype=np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ords, pa.int32()),
            pa.array(labels, label_type),
            pa.array(counts, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(sums)),
        ],
        names=["ord", "label", "n", "sums"],
    )
