"""Scores and predictions of rows that lack a value or a label, in both forms of scoring."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from covaria.operators import metrics as M
from covaria.operators import project
from covaria.operators.features import FeatureTable
from covaria.operators.moments import fit_moments
from covaria.operators.plsda import fit_plsda
from covaria.operators.selection import evaluate_subset, scores_at

FEATURES = [f"f{i}" for i in range(4)]


def _rows(n=60, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = np.argmax(x[:, :3] + 0.3 * rng.normal(size=(n, 3)), axis=1)
    return x, y


def _table(spark, kind, gaps=False):
    x, y = _rows()
    label = {"string": lambda v: f"c{v}", "int": int, "bigint": int}[kind]
    rows = [[i, *map(float, r), label(c)] for i, (r, c) in enumerate(zip(x, y))]
    if gaps:
        rows[0][1], rows[1][2], rows[2][3], rows[3][4] = None, math.nan, math.inf, -math.inf
    schema = "id int, " + ", ".join(f"{f} double" for f in FEATURES) + f", label {kind}"
    return FeatureTable.of(spark.createDataFrame(rows, schema), FEATURES, "label")


def _array_form(table):
    df = table.df.select("id", "label", F.array(*table.features).alias("x"))
    return FeatureTable.of(df, table.features, "label", array="x")


@pytest.mark.parametrize("kind", ["string", "int", "bigint"])
@pytest.mark.parametrize("missing", ["null", "impute"])
def test_both_forms_agree(spark, monkeypatch, kind, missing):
    model = fit_plsda(_table(spark, kind))
    gaps = _table(spark, kind, gaps=True)

    def results(table):
        predicted = model.predict(table, ["id"], missing)
        assert predicted.schema["prediction"].dataType.simpleString() == kind
        scores = model.scores(table, ["id"], missing)
        return (
            {r["id"]: r["prediction"] for r in predicted.collect()},
            {r["id"]: (r["LV1"], r["LV2"]) for r in scores.collect()},
        )

    expressions = results(gaps)
    arrays = results(_array_form(gaps))
    monkeypatch.setattr(project, "EXPRESSION_LIMIT", 0)
    batches = results(gaps)
    for other in (arrays, batches):
        assert other[0] == expressions[0]
        for i, pair in expressions[1].items():
            assert pair == (None, None) == other[1][i] or np.allclose(pair, other[1][i])
    for i in range(4):
        assert (expressions[0][i] is None) == (missing == "null")
        assert (expressions[1][i][0] is None) == (missing == "null")
    assert all(expressions[0][i] is not None for i in range(4, 60))


def test_a_model_fitted_on_gaps_imputes_by_default(spark):
    table = _table(spark, "string", gaps=True)
    model = fit_plsda(table, nan_policy="impute")
    assert model.predict(table, ["id"]).where("prediction IS NULL").count() == 0


def test_rows_without_a_label_count_nowhere(spark):
    table = _table(spark, "string")
    partly = table.with_df(table.df.withColumn("label", F.when(F.col("id") % 4 != 0, F.col("label"))))
    only = table.with_df(table.df.where("id % 4 <> 0"))
    values = []
    for t in (partly, only):
        model = fit_plsda(t, scale=False)
        counts = M.confusion_matrix(model.predict(t, ["label"]), "label", "prediction")
        fisher = M.fisher_ratio(model.scores(t, ["label"]), ["LV1", "LV2"], "label").first()["fisher_ratio"]
        values.append([
            M.accuracy(counts).first()[0], M.macro_f1(counts).first()[0], fisher, model.fisher_ratio,
            evaluate_subset(t, FEATURES).value, evaluate_subset(t, FEATURES, scoring="f1").value,
        ])
    assert np.allclose(*values)
    accuracy, f1, fisher, of_model, selected, selected_f1 = values[0]
    assert np.isclose(accuracy, selected) and np.isclose(f1, selected_f1) and np.isclose(fisher, of_model)


def test_a_row_that_was_not_predicted_is_a_miss(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), ("b", "b"), (None, "a")], "y string, p string")
    counts = M.confusion_matrix(df, "y", "p")
    assert np.isclose(M.accuracy(counts).first()[0], 2 / 3)
    assert {r["label"]: (r["tp"], r["fp"], r["fn"]) for r in M.class_f1(counts).collect()} == {"a": (1, 0, 1), "b": (1, 0, 0)}


def test_too_few_features_give_no_map(spark):
    table = _table(spark, "string")
    for names in ([], ["f0"]):
        empty = scores_at(table, fit_moments(table), names, ["id"])
        assert empty.count() == 0 and empty.columns == ["id", "LV1", "LV2"]
