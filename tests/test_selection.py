import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from covaria.operators import history as H
from covaria.operators import selection as S
from covaria.operators.features import FeatureTable, kept
from covaria.operators.moments import fit_moments
from tests import plain


@pytest.fixture(scope="module")
def data(spark):
    x, y = plain.samples(n=180, p=6, seed=4)
    names = [f"f{j}" for j in range(6)]
    frame = pd.DataFrame(x, columns=names)
    frame["id"], frame["y"] = range(len(x)), y
    df = spark.createDataFrame(frame).repartition(3).persist()
    array = df.select("id", "y", F.array(*names).alias("x"))
    return x, y, FeatureTable.of(df, names, "y"), FeatureTable.of(array, names, "y", array="x")


def _brute_forward(x, y, selected, plateau):
    selected, rest = list(selected), [j for j in range(x.shape[1]) if j not in selected]
    best = plain.hits(x[:, selected], y)
    steps, flat = [(best, list(selected))], 0
    while rest:
        scores = [plain.hits(x[:, [*selected, j]], y) for j in rest]
        top = max(scores)
        if top < best:
            break
        flat = flat + 1 if top == best else 0
        best, j = top, rest[scores.index(top)]
        selected.append(j)
        rest.remove(j)
        steps.append((best, [j]))
        if flat >= plateau:
            break
    return steps


def _brute_backward(x, y, least):
    current = list(range(x.shape[1]))
    best = plain.hits(x, y)
    steps = [(best, None)]
    while len(current) > least:
        trials = [[k for k in current if k != j] for j in current]
        scores = [plain.hits(x[:, t], y) if len(t) >= 2 else None for t in trials]
        defined = [s for s in scores if s is not None]
        if not defined or max(defined) < best:
            break
        best = max(defined)
        steps.append((best, current.pop(scores.index(best))))
    return steps


@pytest.mark.parametrize("form", [2, 3])
def test_sweeps(data, form):
    x, y, table = data[0], data[1], data[form]
    m = fit_moments(table)
    added = {r["candidate"]: r["score"] for r in S.sweep_add_one(table, m, ["f4", "f5"]).collect()}
    assert added == {f"f{j}": pytest.approx(plain.hits(x[:, [4, 5, j]], y) / 180) for j in range(4)}
    dropped = {r["candidate"]: r["score"] for r in S.sweep_drop_one(table, m, table.features).collect()}
    assert dropped == {
        f"f{j}": pytest.approx(plain.hits(np.delete(x, j, axis=1), y) / 180) for j in range(6)
    }


def test_sweep_in_several_passes(data, monkeypatch):
    x, y, table = data[:3]
    m = fit_moments(table)
    whole = S.sweep_add_one(table, m, ["f0"]).collect()
    monkeypatch.setattr(S, "COEFFICIENT_BYTES", 1)
    monkeypatch.setattr(S, "RESPONSE_BYTES", 1)
    assert S.sweep_add_one(table, m, ["f0"]).collect() == whole


def test_forward(data):
    x, y, table = data[:3]
    rows = S.forward_selection(table, init_features=["f4", "f5"]).orderBy("step").collect()
    expected = _brute_forward(x, y, [4, 5], 10)
    assert [(r["accuracy"], r["feature_added"]) for r in rows] == [
        (pytest.approx(h / 180), [f"f{j}" for j in js]) for h, js in expected
    ]
    assert [r["total_features"] for r in rows] == list(range(2, 2 + len(rows)))
    assert [r["step"] for r in rows] == list(range(1, 1 + len(rows)))


def test_backward(data):
    x, y, table = data[:3]
    rows = S.backward_elimination(table, min_features=2).orderBy("step").collect()
    expected = _brute_backward(x, y, 2)
    assert [(r["accuracy"], r["feature_removed"]) for r in rows] == [
        (pytest.approx(h / 180), "" if j is None else f"f{j}") for h, j in expected
    ]
    accuracies = [r["accuracy"] for r in rows]
    assert accuracies == sorted(accuracies)


def test_wide_selection_equals_narrow(data):
    narrow, wide = data[2:]
    a = S.forward_selection(narrow, init_features=["f2", "f3"]).collect()
    assert a == S.forward_selection(wide, init_features=["f2", "f3"]).collect()


def test_one_pass_for_each_step(data, monkeypatch):
    table = data[2]
    passes = []
    count = S._count
    monkeypatch.setattr(S, "_count", lambda *a: passes.append(1) or count(*a))
    steps = S.backward_elimination(table, moments=fit_moments(table)).count()
    assert len(passes) <= steps


def test_seeds(data):
    table = data[2]
    a = S.forward_selection(table, seed=3).collect()
    assert a == S.forward_selection(table, seed=3).collect()
    assert len(a[0]["feature_added"]) == 2
    for bad in (["nope", "f0"], ["f0", "f0"]):
        with pytest.raises(ValueError):
            S.forward_selection(table, init_features=bad)


def test_one_component_starts_from_nothing(data):
    table = data[2]
    rows = S.forward_selection(table, n_components=1).orderBy("step").collect()
    assert rows[0]["total_features"] == 1 and len(rows[0]["feature_added"]) == 1


def test_plateau_ends_the_search(spark, data):
    """Constant features never change a score."""
    df = data[2].df.withColumns({f"c{i}": F.lit(1.0) for i in range(5)})
    table = FeatureTable.of(df, ["f0", "f1", *[f"c{i}" for i in range(5)]], "y")
    rows = S.forward_selection(table, plateau_steps=3, init_features=["f0", "f1"]).collect()
    assert [r["feature_added"] for r in rows[1:]] == [["c0"], ["c1"], ["c2"]]


def test_undefined_scores(data):
    table = FeatureTable.of(data[2].df.withColumn("c", F.lit(1.0)), ["f0", "c"], "y")
    assert S.evaluate_subset(table, ["f0", "c"]).value is None
    rows = S.backward_elimination(table).collect()
    assert len(rows) == 1 and rows[0]["accuracy"] is None


def test_f1_scoring(data):
    x, y, table = data[:3]
    score = S.evaluate_subset(table, ["f0", "f1", "f2"], scoring="f1")
    predicted = plain.predictions(plain.standardized(x[:, :3]), y, 2)
    assert score.value == pytest.approx(plain.macro_f1(y, predicted))
    with pytest.raises(ValueError):
        S.evaluate_subset(table, ["f0", "f1"], scoring="other")


def test_gaps_are_imputed(data):
    table = data[2]
    holed = table.with_df(table.df.withColumn("f1", F.when(F.col("id") % 9 > 0, F.col("f1"))))
    assert S.evaluate_subset(holed, ["f0", "f1", "f2"]).value > 0.4


def test_kept_rows_are_released(data):
    with kept(data[2].with_df(data[2].df.select("*", F.lit(1).alias("one")))) as table:
        assert table.df.is_cached
    assert not table.df.is_cached


FORWARD = [
    (1, 0.5, ["a, x", "b"], 2), (2, 0.6, ["c"], 3), (3, 0.6, ["d"], 4), (4, 0.7, ["e"], 5), (5, 0.7, ["f"], 6),
]
BACKWARD = [(0, 0.5, "", 5), (1, 0.6, "c", 4), (2, 0.6, "a", 3), (3, 0.7, "e", 2)]


def test_replay_forward(spark):
    history = spark.createDataFrame(FORWARD, H.FORWARD_SCHEMA)
    rows = H.replay_forward(history, 4).orderBy("step", "pos").collect()
    assert [r["feature"] for r in rows] == ["a, x", "b", "c", "d"]
    assert H.replay_forward(history, 9).count() == 0
    assert H.replay_forward(history, 2).count() == 2


def test_replay_backward(spark):
    history = spark.createDataFrame(BACKWARD, H.BACKWARD_SCHEMA)
    features = H.feature_list(spark, ["a", "b", "c", "d", "e"])

    def left(n):
        return [r["feature"] for r in H.replay_backward(history, features, n).orderBy("ord").collect()]

    assert left(5) == ["a", "b", "c", "d", "e"] and left(9) == left(5)
    assert left(4) == ["a", "b", "d", "e"]
    assert left(2) == ["b", "d"] == left(1)
    final = H.final_features(history, features).first()
    assert (final["n_features"], final["features"]) == (2, "b, d")
    assert final["summary"] == "Final 2 features: b, d"


def test_curve(spark):
    history = spark.createDataFrame(BACKWARD, H.BACKWARD_SCHEMA)
    assert tuple(H.size_bounds(history).first()) == (2, 5)
    rows = H.selection_curve(history).orderBy("step").collect()
    assert tuple(rows[1]) == (1, 4, 0.6, 1, 6)


def test_scores_at_step(data):
    x, y, table = data[:3]
    scores = S.scores_at(table, fit_moments(table), ["f2", "f0"], ["id"]).orderBy("id").collect()
    t = plain.nipals(plain.standardized(x[:, [2, 0]]), plain.dummies(y)[0], 2, False)[1]
    np.testing.assert_allclose([[r["LV1"], r["LV2"]] for r in scores], t, atol=1e-8)


def _random_moments(p, n=4000, seed=2):
    from covaria.operators.moments import Moments
    from covaria.operators.profile import Scaling

    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) @ (np.eye(p) + 0.2 * rng.normal(size=(p, p)) / np.sqrt(p))
    y = np.argmax(x[:, :3] + rng.normal(size=(n, 3)), axis=1)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    names = tuple(f"f{i}" for i in range(p))
    zero = np.zeros(p)
    scaling = Scaling(names, n, zero, zero, zero, np.ones(p), np.zeros(p, dtype=bool))
    sums = np.array([z[y == c].sum(axis=0) for c in range(3)])
    return Moments(scaling, z.T @ z, (0, 1, 2), np.bincount(y), sums)


def test_subsets_fitted_side_by_side_equal_single_fits():
    from covaria.operators.plsda import coefficients_of_subsets, plsda_from_moments

    moments = _random_moments(12)
    rng = np.random.default_rng(3)
    used = rng.random((12, 20)) < 0.5
    used[:2] = True
    got = coefficients_of_subsets(moments, used)
    for c in range(20):
        names = [f for f, u in zip(moments.features, used[:, c]) if u]
        one = plsda_from_moments(moments.subset(names), 2, scale=False)
        np.testing.assert_allclose(got[used[:, c], c], one.coefficients, atol=1e-9)
        assert not got[~used[:, c], c].any()


def test_a_backward_step_at_a_thousand_features_takes_seconds():
    import time

    from covaria.operators.plsda import coefficients_of_subsets

    moments = _random_moments(1000, n=2000)
    start = time.process_time()
    coefficients_of_subsets(moments, ~np.eye(1000, dtype=bool))
    assert time.process_time() - start < 40  # seconds of all threads; one fit at a time took about a minute


def test_split_products_equal_dense_ones():
    from covaria.operators.selection import _split

    rng = np.random.default_rng(4)
    for used in (np.eye(30, dtype=bool) | (np.arange(30) < 4)[:, None], rng.random((30, 9)) < 0.3, ~np.eye(30, dtype=bool)):
        b = rng.normal(size=(30, used.shape[1], 3)) * used[:, :, None]
        z = rng.normal(size=(7, 30))
        shared, rest = _split(b)
        y = np.einsum("np,pmk->nmk", z[:, shared], b[shared])
        for feature, own in rest:
            y += z[:, feature][:, :, None] * own
        np.testing.assert_allclose(y, np.einsum("np,pmk->nmk", z, b), atol=1e-12)
