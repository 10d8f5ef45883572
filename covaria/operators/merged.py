"""Second moments in one pass, from partial states that merge pairwise.

Each batch of rows becomes a state: per feature a reference (the mean of its finite values in
the batch), and per pair of features the number of rows where both are finite, the sum of
products of deviations from the references over those rows, and the sums of deviations over
them. Two states merge by moving both to a common reference (the mean of their references,
weighted by counts) and adding: deviations stay small, so no digits are lost to a large mean,
and no rough mean has to be read first. Tasks merge their batches, then states of tasks merge
in rounds of ``FAN_IN`` until few are left for the driver.

Missing and infinite values count as the mean, as in ``moments.fit_moments``: a pair's sums run
over the rows where both are finite, and the merged reference of a feature is its exact mean.
Class sums, row counts, missing and infinite counts and the value range merge alongside.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from covaria.functions import column
from covaria.operators.features import FeatureTable, matrix
from covaria.operators.moments import MAX_CLASSES, MAX_FEATURES, Moments, _centred, _scaling, _Sums

#: States merged by one task in a round.
FAN_IN = 16


@dataclass
class State:
    rows: int
    ref: np.ndarray  # p
    n: np.ndarray  # p x p, rows where both features are finite
    c: np.ndarray  # p x p, sum of (x_i - ref_i)(x_j - ref_j) over those rows
    s: np.ndarray  # p x p, s[i, j]: sum of (x_i - ref_i) over the rows where i and j are finite
    classes: dict  # label -> (rows, finite counts p, sums of x - ref p)
    missing: np.ndarray
    infinite: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def moved(self, to: np.ndarray) -> State:
        """The same sums around another reference."""
        d = to - self.ref
        sd = self.s * d[None, :]
        return State(
            self.rows, to, self.n, self.c - sd - sd.T + self.n * np.outer(d, d), self.s - self.n * d[:, None],
            {k: (r, n, v - n * d) for k, (r, n, v) in self.classes.items()},
            self.missing, self.infinite, self.low, self.high,
        )


def merged(a: State, b: State) -> State:
    na, nb = np.diag(a.n), np.diag(b.n)
    total = na + nb
    ref = np.where(total > 0, (na * a.ref + nb * b.ref) / np.maximum(total, 1), 0.0)
    a, b = a.moved(ref), b.moved(ref)
    classes = dict(a.classes)
    for k, (r, n, v) in b.classes.items():
        if k in classes:
            r0, n0, v0 = classes[k]
            classes[k] = (r0 + r, n0 + n, v0 + v)
        else:
            classes[k] = (r, n, v)
    return State(
        a.rows + b.rows, ref, a.n + b.n, a.c + b.c, a.s + b.s, classes,
        a.missing + b.missing, a.infinite + b.infinite, np.minimum(a.low, b.low), np.maximum(a.high, b.high),
    )


def of_batch(x: np.ndarray, labels: list) -> State:
    finite = np.isfinite(x)
    f = finite.astype(np.float64)
    count = f.sum(axis=0)
    ref = np.where(count > 0, np.where(finite, x, 0.0).sum(axis=0) / np.maximum(count, 1), 0.0)
    a = np.where(finite, x - ref, 0.0)
    classes = {}
    codes = {}
    for row, label in enumerate(labels):
        codes.setdefault(label, []).append(row)
    for label, rows in codes.items():
        classes[label] = (len(rows), f[rows].sum(axis=0), a[rows].sum(axis=0))
    return State(
        len(x), ref, f.T @ f, a.T @ a, a.T @ f, classes,
        np.isnan(x).sum(axis=0).astype(np.float64), np.isinf(x).sum(axis=0).astype(np.float64),
        np.where(finite, x, np.inf).min(axis=0), np.where(finite, x, -np.inf).max(axis=0),
    )


def _dump(state: State) -> bytes:
    """A state as plain data, which any worker reads whatever copy of this module it runs."""
    return pickle.dumps(dict(vars(state)))


def _load(data: bytes) -> State:
    return State(**pickle.loads(data))


def _all(states) -> State | None:
    out = None
    for state in states:
        out = state if out is None else merged(out, state)
    return out


def merged_moments(table: FeatureTable) -> Moments:
    """Moments of all features of the table's labelled rows in one pass; missing values count as the mean."""
    table = table.labelled()
    p = len(table.features)
    if p > MAX_FEATURES:
        raise ValueError(f"{p} features; moments are kept for at most {MAX_FEATURES}")
    label = F.lit(None).cast("string") if table.label is None else column(table.label)
    name = table.label

    def partial(batches):
        state = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1), p)
            one = of_batch(x, batch.column(0).to_pylist())
            state = one if state is None else merged(state, one)
            if len(state.classes) > MAX_CLASSES:
                raise ValueError(f"label {name!r} has more than {MAX_CLASSES} distinct values in one task")
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([_dump(state)], pa.binary())],
                                             names=["g", "state"])

    states = table.df.select(label.alias("label"), table.vector().alias("x")).mapInArrow(partial, "g long, state binary")
    states = states.withColumn("g", F.spark_partition_id().cast("long"))
    count = states.count()
    while count > FAN_IN:
        groups = math.ceil(count / FAN_IN)

        def merge_group(frame: pd.DataFrame) -> pd.DataFrame:
            state = _all(_load(b) for b in frame["state"])
            return pd.DataFrame({"g": [int(frame["g"].iloc[0])], "state": [_dump(state)]})

        states = (
            states.withColumn("g", F.floor(F.col("g") / FAN_IN).cast("long"))
            .groupBy("g")
            .applyInPandas(merge_group, "g long, state binary")
        )
        count = groups
    state = _all(_load(r["state"]) for r in states.collect())
    return _moments_of(table, state, p)


def _moments_of(table: FeatureTable, state: State | None, p: int) -> Moments:
    zero = np.zeros(p)
    if state is None:
        sums = _Sums(0, np.zeros((p, p)), {}, zero, zero, np.full(p, np.inf), np.full(p, -np.inf))
        centre = zero
    else:
        by_class = {(None if table.label is None else k): (r, v) for k, (r, _, v) in state.classes.items()}
        gram = (state.c + state.c.T) / 2
        sums = _Sums(state.rows, gram, by_class, state.missing, state.infinite, state.low, state.high)
        centre = state.ref
    scale = np.ones(p)
    scaling = _scaling(table.features, centre, scale, sums)
    return _centred(table, centre, scale, sums, scaling)

