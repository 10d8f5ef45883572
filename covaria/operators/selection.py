"""Greedy feature selection around PLS-DA.

A greedy step fits all candidates side by side from moments on the driver, with a few matrix
products, and scores them in one pass: each task counts their hits batch by batch. Features
that most candidates share take part in one product; a feature that only some have, such as
the one a candidate adds, is added to their responses alone.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covaria.functions import column
from covaria.operators.features import FeatureTable, matrix
from covaria.operators.history import BACKWARD_SCHEMA, FORWARD_SCHEMA
from covaria.operators.moments import Moments, fit_moments
from covaria.operators.pca import empty_scores
from covaria.operators.plsda import coefficients_of_subsets, plsda_from_moments
from covaria.operators.profile import standardize_block, usable_features

SCORINGS = ("accuracy", "f1")

# Coefficients sent to the tasks of one pass; more candidates take several passes.
COEFFICIENT_BYTES = 64 * 1024 * 1024

# Responses held at once inside a task.
RESPONSE_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Score:
    """Score of one subset. ``rank`` is what scores are compared by: exact hit counts."""

    value: float | None
    rank: float | None

    @property
    def defined(self) -> bool:
        return self.rank is not None


UNDEFINED = Score(None, None)


def evaluate_subsets(
    table: FeatureTable,
    moments: Moments,
    subsets: Sequence[Sequence[str]],
    n_components: int = 2,
    scoring: str = "accuracy",
) -> list[Score]:
    """Score every subset on the rows it was fitted on, all in one pass.

    Constant features are left out of a subset first; one left with fewer features than
    components has no score.
    """
    if scoring not in SCORINGS:
        raise ValueError(f"scoring must be one of {SCORINGS}, got {scoring!r}")
    k, p = len(moments.classes), len(moments.features)
    at = {f: j for j, f in enumerate(moments.features)}
    live = ~moments.scaling.constant
    used = np.zeros((p, len(subsets)), dtype=bool)
    for c, subset in enumerate(subsets):
        used[[at[f] for f in subset], c] = True
    used &= live[:, None]
    fits = np.flatnonzero((used.sum(axis=0) >= max(n_components, 1)) & (k > 0))
    at_once = max(1, COEFFICIENT_BYTES // (8 * max(k * p, 1)))
    scores = [UNDEFINED] * len(subsets)
    share = moments.class_counts / max(moments.n_rows, 1)
    for start in range(0, len(fits), at_once):
        chunk = fits[start : start + at_once]
        coefficients = coefficients_of_subsets(moments, used[:, chunk], n_components)
        hits, predicted = _count(table, moments, coefficients, share)
        for m, c in enumerate(chunk):
            scores[c] = _score(hits[m], predicted[m], moments, scoring)
    return scores


def _score(hits: np.ndarray, predicted: np.ndarray, moments: Moments, scoring: str) -> Score:
    if scoring == "accuracy":
        correct = int(hits.sum())
        return Score(correct / moments.n_rows, correct)
    f1 = float(np.mean(2.0 * hits / (moments.class_counts + predicted)))
    return Score(f1, round(f1, 12))


def _split(coefficients: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Features that many candidates use, and the others in rounds of one for each candidate.

    A round holds a feature per candidate and its coefficients (zero where there is none).
    """
    uses = np.abs(coefficients).sum(axis=2) > 0
    many = uses.sum(axis=1) * 4 > uses.shape[1]
    alone = uses & ~many[:, None]
    rounds = int(alone.sum(axis=0).max(initial=0))
    if rounds > max(4, len(uses) // 8):  # no gain over one product
        return np.arange(len(uses)), []
    order = np.argsort(~alone, axis=0, kind="stable")
    candidates, rest = np.arange(uses.shape[1]), []
    for k in range(rounds):
        feature = order[k]
        rest.append((feature, coefficients[feature, candidates] * alone[feature, candidates][:, None]))
    return np.flatnonzero(many), rest


def _count(table: FeatureTable, moments: Moments, coefficients: np.ndarray, share: np.ndarray):
    """Hits and predictions per candidate and class: two candidates x classes arrays."""
    table = table.labelled()
    p, m, k = coefficients.shape
    used = np.flatnonzero(np.abs(coefficients).sum(axis=(1, 2)) > 0)
    if table.array is None:  # read only the columns some candidate uses
        names = [moments.features[j] for j in used]
        vector = F.array(*[table.value(f) for f in names]) if names else F.array(F.lit(0.0))
        scaling, stacked = moments.scaling.subset(names), coefficients[used]
        width, pick = max(len(names), 1), None
    else:
        at = {f: j for j, f in enumerate(table.features)}
        vector, width = table.vector(), len(table.features)
        scaling, stacked = moments.scaling, coefficients
        pick = [at[f] for f in moments.features]
    if not len(used):
        scaling, stacked = moments.scaling.subset(()), np.zeros((0, m, k))
    shared, rest = _split(stacked)
    common = np.ascontiguousarray(stacked[shared]).reshape(-1, m * k)
    classes = list(moments.classes)
    block_rows = max(1, RESPONSE_BYTES // (8 * m * k))

    def count(batches):
        hits = np.zeros((m, k), dtype=np.int64)
        predicted = np.zeros((m, k), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            actual = pc.index_in(batch.column(0), value_set=pa.array(classes, batch.column(0).type))
            actual = actual.fill_null(-1).to_numpy(zero_copy_only=False)
            x = matrix(batch.column(1), width)
            if not len(stacked):
                x = x[:, :0]
            elif pick is not None:
                x = x[:, pick]
            for start in range(0, len(x), block_rows):
                part = slice(start, start + block_rows)
                z = standardize_block(x[part], scaling)
                responses = (z[:, shared] @ common).reshape(-1, m, k) + share
                for feature, own in rest:
                    responses += z[:, feature][:, :, None] * own
                best = np.argmax(responses, axis=2)
                truth = actual[part, None]
                cell = best + k * np.arange(m)
                predicted += np.bincount(cell[actual[part] >= 0].ravel(), minlength=m * k).reshape(m, k)
                hits += np.bincount(cell[best == truth], minlength=m * k).reshape(m, k)
        cells = np.argwhere(predicted > 0)
        if len(cells):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cells[:, 0].astype(np.int32)),
                    pa.array(cells[:, 1].astype(np.int32)),
                    pa.array(hits[cells[:, 0], cells[:, 1]]),
                    pa.array(predicted[cells[:, 0], cells[:, 1]]),
                ],
                names=["candidate", "class", "hits", "predicted"],
            )

    counted = (
        table.df.select(column(table.label).alias("label"), vector.alias("x"))
        .mapInArrow(count, "candidate int, class int, hits long, predicted long")
        .groupBy("candidate", "class")
        .agg(F.sum("hits").alias("hits"), F.sum("predicted").alias("predicted"))
    )
    hits, predicted = np.zeros((m, k), dtype=np.int64), np.zeros((m, k), dtype=np.int64)
    for row in counted.collect():
        hits[row["candidate"], row["class"]] = row["hits"]
        predicted[row["candidate"], row["class"]] = row["predicted"]
    return hits, predicted


def evaluate_subset(
    table: FeatureTable,
    subset: Sequence[str],
    n_components: int = 2,
    scoring: str = "accuracy",
    moments: Moments | None = None,
) -> Score:
    moments = moments or fit_moments(FeatureTable.of(table.df, subset, table.label))
    return evaluate_subsets(table, moments, [subset], n_components, scoring)[0]


def sweep(
    table: FeatureTable,
    moments: Moments,
    subsets: dict[str, Sequence[str]],
    n_components: int = 2,
    scoring: str = "accuracy",
) -> DataFrame:
    """``candidate, n_features, score`` for named subsets."""
    scores = evaluate_subsets(table, moments, list(subsets.values()), n_components, scoring)
    rows = [(name, len(s), score.value) for (name, s), score in zip(subsets.items(), scores)]
    return table.df.sparkSession.createDataFrame(rows, "candidate string, n_features int, score double")


def sweep_add_one(
    table: FeatureTable, moments: Moments, selected: Sequence[str], n_components: int = 2, scoring: str = "accuracy"
) -> DataFrame:
    """Score of ``selected`` plus each remaining feature."""
    rest = [f for f in moments.features if f not in set(selected)]
    return sweep(table, moments, {f: [*selected, f] for f in rest}, n_components, scoring)


def sweep_drop_one(
    table: FeatureTable, moments: Moments, selected: Sequence[str], n_components: int = 2, scoring: str = "accuracy"
) -> DataFrame:
    """Score of ``selected`` without each of its features."""
    trials = {f: [g for g in selected if g != f] for f in selected}
    return sweep(table, moments, trials, n_components, scoring)


def _visiting_order(seed: int | None) -> Callable[[Sequence[str]], list[str]]:
    """Order candidates are compared in; the first of equal ones wins."""
    if seed is None:
        return list
    generator = random.Random(seed)
    return lambda names: generator.sample(list(names), len(names))


class _Search:
    """Greedy search over subsets, one pass over the rows for each step.

    The score of the set it starts from is counted in the pass of the first step.
    """

    def __init__(self, table: FeatureTable, moments: Moments, n_components: int, scoring: str):
        self.table, self.moments = table, moments
        self.n_components, self.scoring = n_components, scoring

    def best(self, trials: dict[str, list[str]], start: Sequence[str] = ()) -> tuple[str | None, Score, Score]:
        """Name and score of the first best trial, and the score of ``start``.

        Trials with fewer features than components are not made.
        """
        made = {f: s for f, s in trials.items() if len(s) >= self.n_components}
        subsets = [*made.values(), *([list(start)] if start else [])]
        scores = evaluate_subsets(self.table, self.moments, subsets, self.n_components, self.scoring)
        name, best = None, UNDEFINED
        for feature, score in zip(made, scores):
            if score.defined and (not best.defined or score.rank > best.rank):
                name, best = feature, score
        return name, best, scores[-1] if start else UNDEFINED


def forward_selection(
    table: FeatureTable,
    n_components: int = 2,
    plateau_steps: int = 10,
    init_features: Sequence[str] | None = None,
    scoring: str = "accuracy",
    seed: int | None = None,
    moments: Moments | None = None,
) -> DataFrame:
    """History of adding, step by step, the feature that scores best.

    Starts from ``init_features``; without them from ``n_components`` features drawn with
    ``seed`` if more than one component is asked for, and from nothing otherwise. Ends
    when every addition lowers the score, when ``plateau_steps`` additions in a row
    brought no gain, or when no feature is left. Candidates that score the same are taken
    in feature order, or in a shuffled order if a ``seed`` is given.
    """
    remaining = list(table.features)
    start = list(init_features or ())
    for f in start:
        if f not in remaining:
            raise ValueError(f"initial feature {f!r} is unknown or repeated")
        remaining.remove(f)
    order = _visiting_order(seed)
    if not start and n_components > 1:
        start = random.Random(0 if seed is None else seed).sample(remaining, min(n_components, len(remaining)))
        remaining = [f for f in remaining if f not in set(start)]
    search = _Search(table, moments or fit_moments(table), n_components, scoring)
    selected, best, history, flat = list(start), UNDEFINED, [], 0
    while remaining or not history:
        trials = {f: [*selected, f] for f in order(remaining)}
        name, score, started = search.best(trials, () if history else start)
        if start and not history:
            best = started
            history.append((1, best.value, start, len(start)))
        if name is None or (best.defined and score.rank < best.rank):
            break
        flat = flat + 1 if best.defined and score.rank == best.rank else 0
        best = score
        remaining.remove(name)
        selected.append(name)
        history.append((len(history) + 1, score.value, [name], len(selected)))
        if flat >= plateau_steps:
            break
    return table.df.sparkSession.createDataFrame(history, FORWARD_SCHEMA)


def backward_elimination(
    table: FeatureTable,
    min_features: int = 1,
    n_components: int = 2,
    scoring: str = "accuracy",
    seed: int | None = None,
    moments: Moments | None = None,
) -> DataFrame:
    """History of removing, step by step, the feature whose loss scores best.

    Step 0 is the full set. Ends at ``min_features`` or when every removal lowers the
    score.
    """
    search = _Search(table, moments or fit_moments(table), n_components, scoring)
    order = _visiting_order(seed)
    current, best, history = list(table.features), UNDEFINED, []
    while not history or len(current) > min_features:
        may_shrink = len(current) > min_features
        trials = {f: [g for g in current if g != f] for f in order(current)} if may_shrink else {}
        name, score, started = search.best(trials, () if history else current)
        if not history:
            best = started
            history.append((0, best.value, "", len(current)))
        if name is None or (best.defined and score.rank < best.rank):
            break
        best = score
        current.remove(name)
        history.append((len(history), score.value, name, len(current)))
    return table.df.sparkSession.createDataFrame(history, BACKWARD_SCHEMA)


def scores_at(
    table: FeatureTable, moments: Moments, features: Sequence[str], keep: Sequence[str] = (), n_components: int = 2
) -> DataFrame:
    """Latent scores of every row under the unscaled model of a replayed feature set.

    Fewer features than components, or than two, give no map and so no rows.
    """
    if len(features) < max(n_components, 2):
        return empty_scores(table, keep, [f"LV{a + 1}" for a in range(n_components)])
    model = plsda_from_moments(moments.subset(features), n_components, scale=False)
    return model.scores(table, keep)
