"""Column profile, column cleaning and standardisation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covaria.functions import INFINITY, clean_value, column, finite
from covaria.operators.features import FeatureTable, matrix

NAN_POLICIES = ("drop_column", "error", "impute")

PROFILE_COLUMNS = (
    "n_rows", "n_null", "n_nan", "n_inf", "mean", "std_samp", "std_pop", "min_value", "max_value",
)


def _measures(value: Column) -> list[Column]:
    number = finite(value)
    return [
        F.count(F.lit(1)),
        F.count(F.when(value.isNull(), 1)),
        F.count(F.when(F.isnan(value), 1)),
        F.count(F.when(F.abs(value) == F.lit(INFINITY), 1)),
        F.avg(number),
        F.stddev_samp(number),
        F.stddev_pop(number),
        F.min(number),
        F.max(number),
    ]


def profile(table: FeatureTable) -> DataFrame:
    """One row per feature: counts of rows and of missing values, moments, extremes.

    Mean, deviations and extremes are over the finite values. One pass; what crosses the
    network is one row of partial results per task. An array column must hold as many
    entries as there are features in every row; anything else is an error.
    """
    names = table.features
    if table.narrow:
        measured = table.df.agg(
            *[
                m.alias(f"m{j}_{i}")
                for j, name in enumerate(names)
                for i, m in enumerate(_measures(table.value(name)))
            ]
        )
        entries = [
            F.struct(
                F.lit(name).alias("column"),
                F.lit(j).alias("ord"),
                *[F.col(f"m{j}_{i}").alias(c) for i, c in enumerate(PROFILE_COLUMNS)],
            )
            for j, name in enumerate(names)
        ]
        return measured.select(F.inline(F.array(*entries)))
    whole = _merged(table)
    lookup = F.array(*[F.lit(n) for n in names])
    each = whole.select("n_rows", F.posexplode(F.arrays_zip(*_PARTS)).alias("ord", "v"))
    n = F.col("v.n")
    known = lambda value, least=1: F.when(n >= least, value)
    return each.select(
        F.get(lookup, F.col("ord")).alias("column"),
        "ord",
        "n_rows",
        *[F.col(f"v.{c}").cast("long").alias(c) for c in ("n_null", "n_nan", "n_inf")],
        known(F.col("v.mean")).alias("mean"),
        known(F.sqrt(F.col("v.squares") / (n - 1)), 2).alias("std_samp"),
        known(F.sqrt(F.col("v.squares") / n)).alias("std_pop"),
        known(F.col("v.low")).alias("min_value"),
        known(F.col("v.high")).alias("max_value"),
    )


# Partial results of a task, one entry per feature; ``squares`` are about the task's own mean.
_PARTS = ("n_null", "n_nan", "n_inf", "n", "mean", "squares", "low", "high")

# Partial rows are first merged in so many groups.
MERGE_GROUPS = 64


def _merge(a: dict, b: dict) -> dict:
    """Partial results of two sets of rows put together (Chan, Golub and LeVeque 1979)."""
    n = a["n"] + b["n"]
    share = b["n"] / np.maximum(n, 1)
    away = np.where((a["n"] > 0) & (b["n"] > 0), b["mean"] - a["mean"], 0.0)
    only_b = (a["n"] == 0) & (b["n"] > 0)
    return {
        **{c: a[c] + b[c] for c in ("n_rows", "n_null", "n_nan", "n_inf")},
        "n": n,
        "mean": np.where(only_b, b["mean"], a["mean"] + away * share),
        "squares": a["squares"] + b["squares"] + away * away * a["n"] * share,
        "low": np.minimum(a["low"], b["low"]),
        "high": np.maximum(a["high"], b["high"]),
    }


def _merged(table: FeatureTable) -> DataFrame:
    """One row of arrays over the whole table: Arrow batches, then merging in two steps."""
    p = len(table.features)

    def measured(x: np.ndarray, absent: np.ndarray) -> dict:
        ok = np.isfinite(x)
        n = ok.sum(axis=0).astype(float)
        mean = np.where(ok, x, 0.0).sum(axis=0) / np.maximum(n, 1)
        off = np.where(ok, x - mean, 0.0)
        rest = off.sum(axis=0) / np.maximum(n, 1)  # what rounding left in the mean
        return {
            "n_rows": len(x),
            "n_null": absent.sum(axis=0).astype(float),
            "n_nan": (np.isnan(x) & ~absent).sum(axis=0).astype(float),
            "n_inf": np.isinf(x).sum(axis=0).astype(float),
            "n": n,
            "mean": mean + rest,
            "squares": (off * off).sum(axis=0) - n * rest * rest,
            "low": np.where(ok, x, np.inf).min(axis=0),
            "high": np.where(ok, x, -np.inf).max(axis=0),
        }

    def partial(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            column_ = batch.column(0)
            x = matrix(column_, p)
            absent = column_.flatten().is_null().to_numpy(zero_copy_only=False).reshape(x.shape)
            own = measured(x, absent)
            total = own if total is None else _merge(total, own)
        if total is not None:
            yield pa.RecordBatch.from_pydict(
                {"n_rows": [total["n_rows"]], **{c: pa.array([total[c]], pa.list_(pa.float64())) for c in _PARTS}}
            )

    def merge(rows):
        total = None
        for row in rows.to_dict("records"):
            row.pop("part")
            own = {c: v if c == "n_rows" else np.asarray(v) for c, v in row.items()}
            total = own if total is None else _merge(total, own)
        return pd.DataFrame([{"n_rows": int(total["n_rows"]), **{c: total[c] for c in _PARTS}}])

    schema = "n_rows long, " + ", ".join(f"{c} array<double>" for c in _PARTS)
    rows = table.df.select(table.vector().alias("x")).mapInArrow(partial, schema)
    part = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
    rows = rows.withColumn("part", part).groupBy("part").applyInPandas(merge, schema)
    return rows.withColumn("part", F.lit(0)).groupBy("part").applyInPandas(merge, schema)


@dataclass(frozen=True)
class Scaling:
    """Profile of a feature set, held on the driver (a few numbers per feature)."""

    features: tuple[str, ...]
    n_rows: int
    n_missing: np.ndarray  # NULL and NaN
    n_inf: np.ndarray
    mean: np.ndarray  # 0 where a feature has no finite value
    std_pop: np.ndarray
    constant: np.ndarray  # at least two finite values, all equal

    @property
    def scale(self) -> np.ndarray:
        """Divisor of each feature; 1 where the deviation is zero or undefined."""
        usable = (self.std_pop > 0) & ~self.constant
        return np.where(usable, self.std_pop, 1.0)

    @property
    def n_valid(self) -> np.ndarray:
        return self.n_rows - self.n_missing - self.n_inf

    @property
    def complete(self) -> bool:
        return not (self.n_missing.any() or self.n_inf.any())

    def position(self, names: Sequence[str]) -> list[int]:
        at = {f: i for i, f in enumerate(self.features)}
        return [at[n] for n in names]

    def subset(self, names: Sequence[str]) -> Scaling:
        ix = self.position(names)
        return Scaling(
            tuple(names), self.n_rows, self.n_missing[ix], self.n_inf[ix],
            self.mean[ix], self.std_pop[ix], self.constant[ix],
        )


def fit_scaling(table: FeatureTable) -> Scaling:
    """Run the profile and keep what standardisation needs."""
    if not table.features:
        empty = np.zeros(0)
        return Scaling((), table.df.count(), empty, empty, empty, empty, empty.astype(bool))
    rows = {r["ord"]: r for r in profile(table).collect()}
    if not rows:  # wide form of an empty table
        zero = np.zeros(len(table.features))
        return Scaling(table.features, 0, zero, zero, zero, zero, zero.astype(bool))
    if len(rows) != len(table.features):
        raise ValueError(f"the array column holds {len(rows)} entries, expected {len(table.features)}")
    ordered = [rows[j] for j in range(len(table.features))]

    def numbers(pick):
        return np.array([pick(r) for r in ordered], dtype=np.float64)

    return Scaling(
        table.features,
        int(ordered[0]["n_rows"]),
        numbers(lambda r: r["n_null"] + r["n_nan"]),
        numbers(lambda r: r["n_inf"]),
        numbers(lambda r: 0.0 if r["mean"] is None else r["mean"]),
        numbers(lambda r: 0.0 if r["std_pop"] is None else r["std_pop"]),
        np.array(
            [
                r["min_value"] is not None
                and r["min_value"] == r["max_value"]
                and r["n_rows"] - r["n_null"] - r["n_nan"] - r["n_inf"] > 1
                for r in ordered
            ]
        ),
    )


def usable_features(
    scaling: Scaling, nan_policy: str = "drop_column", drop_constant: bool = True
) -> tuple[str, ...]:
    """Features an analysis may use under a policy for missing values.

    ``drop_column``  features with a NULL or NaN are left out, an infinity is an error
    ``error``        a NULL, NaN or infinity is an error
    ``impute``       all stay; a missing or infinite value counts as the feature's mean

    Constant features are left out afterwards if asked. A feature without any finite
    value has no deviation at all and is not constant in this sense.
    """
    if nan_policy not in NAN_POLICIES:
        raise ValueError(f"nan_policy must be one of {NAN_POLICIES}, got {nan_policy!r}")
    keep = np.ones(len(scaling.features), dtype=bool)
    if nan_policy == "drop_column":
        keep &= scaling.n_missing == 0
    elif nan_policy == "error":
        _refuse(scaling, scaling.n_missing > 0, "missing values")
    if drop_constant:
        keep &= ~scaling.constant
    if nan_policy != "impute":
        _refuse(scaling, keep & (scaling.n_inf > 0), "infinite values")
    return tuple(f for f, k in zip(scaling.features, keep) if k)


def _refuse(scaling: Scaling, at: np.ndarray, what: str) -> None:
    if at.any():
        raise ValueError(f"{what} in {[f for f, a in zip(scaling.features, at) if a]}")


def drop_nan_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` without those of ``columns`` that hold a NULL or NaN."""
    scaling = fit_scaling(FeatureTable.of(df, columns))
    bad = {f for f, n in zip(scaling.features, scaling.n_missing) if n}
    return df.select(*[column(c) for c in df.columns if c not in bad])


def drop_zero_variance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` without those of ``columns`` whose present values are all the same."""
    scaling = fit_scaling(FeatureTable.of(df, columns))
    bad = {f for f, c in zip(scaling.features, scaling.constant) if c}
    return df.select(*[column(c) for c in df.columns if c not in bad])


def clean_columns(
    df: DataFrame, columns: Sequence[str], nan_value: float = 0.0, inf_value: float = 0.0
) -> DataFrame:
    """Replace missing and infinite values in ``columns`` by constants."""
    wanted = set(columns)
    return df.select(
        *[
            clean_value(column(c), nan_value, inf_value).alias(c) if c in wanted else column(c)
            for c in df.columns
        ]
    )


def standardized(table: FeatureTable, scaling: Scaling, name: str, impute: bool = False) -> Column:
    """``(x - mean) / std_pop`` of one feature.

    Missing values stay as they are, unless imputed: then they, and infinities, become 0,
    the standardised mean.
    """
    j = scaling.position([name])[0]
    value = table.value(name)
    if impute and (scaling.n_missing[j] or scaling.n_inf[j]):
        value = finite(value)
    z = (value - F.lit(float(scaling.mean[j]))) / F.lit(float(scaling.scale[j]))
    if impute and (scaling.n_missing[j] or scaling.n_inf[j]):
        z = F.coalesce(z, F.lit(0.0))
    return z


def standardized_finite(table: FeatureTable, scaling: Scaling, name: str, impute: bool) -> Column:
    """One standardised feature; where it is not a finite number NULL, or 0 if imputed."""
    j = scaling.position([name])[0]
    z = (finite(table.value(name)) - F.lit(float(scaling.mean[j]))) / F.lit(float(scaling.scale[j]))
    return F.coalesce(z, F.lit(0.0)) if impute else z


def standardize(
    table: FeatureTable,
    scaling: Scaling | None = None,
    keep: Sequence[str] = (),
    impute: bool = False,
) -> DataFrame:
    """``keep`` columns, then every feature standardised (an array stays an array)."""
    scaling = scaling or fit_scaling(table)
    kept = [column(k) for k in keep]
    if table.array is None:
        z = [standardized(table, scaling, f, impute).alias(f) for f in table.features]
        return table.df.select(*kept, *z)
    mean = F.array(*[F.lit(float(m)) for m in scaling.mean])
    scale = F.array(*[F.lit(float(s)) for s in scaling.scale])
    centred = F.zip_with(table.vector(), mean, lambda x, m: (finite(x) if impute else x) - m)
    z = F.zip_with(centred, scale, lambda x, s: F.coalesce(x / s, F.lit(0.0)) if impute else x / s)
    return table.df.select(*kept, z.alias(table.array))


def standardize_block(x: np.ndarray, scaling: Scaling) -> np.ndarray:
    """The same on a block of rows inside a task, missing and infinite values imputed."""
    z = (x - scaling.mean) / scaling.scale
    if not scaling.complete:
        z[~np.isfinite(z)] = 0.0
    return z


def standardize_finite_block(x: np.ndarray, scaling: Scaling, impute: bool) -> tuple[np.ndarray, np.ndarray]:
    """The same on a block of rows inside a task, and which rows cannot be scored."""
    z = (x - scaling.mean) / scaling.scale
    bad = ~np.isfinite(z)
    z[bad] = 0.0
    absent = np.zeros(len(z), dtype=bool) if impute else bad.any(axis=1)
    return z, absent


def sample_deviation(sum_of_squares: np.ndarray, n: int) -> np.ndarray:
    """Sample deviations from centred sums of squares, 1 where they vanish."""
    if n < 2:
        return np.ones_like(sum_of_squares)
    s = np.sqrt(np.maximum(sum_of_squares, 0.0) / (n - 1))
    return np.where(s > sqrt(np.finfo(float).eps) * 1e-4, s, 1.0)
