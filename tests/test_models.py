import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from covaria.operators.features import FeatureTable
from covaria.operators.moments import fit_moments
from covaria.operators.pca import canonical_sign, fit_pca, pca_by_group, ranked
from covaria.operators.plsda import fit_plsda
from covaria.plans.analyses import plsda_view, quality
from covaria.sources import FeatureCatalog
from tests import plain


def _tables(spark, x, y, partitions=4):
    names = [f"f/{j}.x" for j in range(x.shape[1])]
    frame = pd.DataFrame(x, columns=names)
    frame["id"], frame["y"] = range(len(x)), y
    df = spark.createDataFrame(frame).repartition(partitions)
    narrow = FeatureTable.of(df, names, "y")
    array = df.select("id", "y", F.array(*[F.col(f"`{n}`") for n in names]).alias("x"))
    return narrow, FeatureTable.of(array, names, "y", array="x")


@pytest.fixture(scope="module")
def data(spark):
    x, y = plain.samples(n=240, p=6)
    return x, y, *_tables(spark, x, y)


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_moments_agree_with_numpy(spark, data, partitions):
    x, y = data[:2]
    z, (d, classes) = plain.standardized(x), plain.dummies(y)
    for table in _tables(spark, x, y, partitions):
        m = fit_moments(table)
        np.testing.assert_allclose(m.gram, z.T @ z, atol=1e-9)
        np.testing.assert_allclose(m.class_sums, d.T @ z, atol=1e-9)
        assert list(m.classes) == classes and m.n_rows == len(x)
        assert list(m.class_counts) == list(d.sum(axis=0))


def test_moments_of_large_means_keep_precision(spark):
    x, y = plain.samples(n=200, p=3)
    z = plain.standardized(x)
    for table in _tables(spark, x + 1e8, y):
        np.testing.assert_allclose(fit_moments(table).correlation(), z.T @ z / 200, atol=1e-6)


def test_moments_impute_gaps(spark):
    x, y = plain.samples(n=100, p=4)
    x[::7, 1] = np.nan
    x[3, 2] = np.inf
    filled = np.where(np.isfinite(x), x, np.nan)
    mean, std = np.nanmean(filled, axis=0), np.nanstd(filled, axis=0)
    z = np.nan_to_num((filled - mean) / std)
    for table in _tables(spark, x, y):
        np.testing.assert_allclose(fit_moments(table).gram, z.T @ z, atol=1e-9)


def test_rows_without_a_label_are_not_fitted(spark):
    x, y = plain.samples(n=60, p=3)
    y = [None if i % 10 == 0 else v for i, v in enumerate(y)]
    for table in _tables(spark, x, y):
        m = fit_moments(table)
        assert m.n_rows == 54 and m.class_counts.sum() == 54 and None not in m.classes


def test_pca_agrees_with_svd(data):
    x, _, *tables = data
    z = plain.standardized(x)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    axes = np.array([canonical_sign(v) for v in vt[:2]]).T
    for table in tables:
        model = fit_pca(table)
        np.testing.assert_allclose(model.loadings, axes, atol=1e-9)
        np.testing.assert_allclose(model.explained_percent, (s**2 / (s**2).sum() * 100)[:2], atol=1e-9)
        rows = model.scores(table, ["id"]).orderBy("id").collect()
        np.testing.assert_allclose([[r["PC1"], r["PC2"]] for r in rows], z @ axes, atol=1e-9)


def test_pca_of_a_subset_reads_no_rows(data):
    x, _, narrow, wide = data
    m = fit_moments(wide)
    some = narrow.features[2:5]
    sliced = fit_pca(FeatureTable.of(wide.df, some, array="x"), moments=m)
    fresh = fit_pca(FeatureTable.of(narrow.df, some))
    np.testing.assert_allclose(sliced.loadings, fresh.loadings, atol=1e-9)
    np.testing.assert_allclose(
        [r["PC1"] for r in sliced.scores(wide, ["id"]).orderBy("id").collect()],
        [r["PC1"] for r in fresh.scores(narrow, ["id"]).orderBy("id").collect()],
        atol=1e-9,
    )


def test_pca_full_rank_explains_everything(data):
    table = data[2]
    assert fit_pca(table, n_components=6).explained_percent.sum() == pytest.approx(100)


def test_pca_drops_and_names_what_is_left(spark):
    rows = [(i, float(i), 5.0, None if i == 3 else 1.0 * i, float(i * i % 7)) for i in range(12)]
    df = spark.createDataFrame(rows, "id int, a double, c double, g double, b double")
    model = fit_pca(FeatureTable.of(df, ["a", "c", "g", "b"]))
    assert model.features == ("a", "b") and model.dropped == ("c", "g")
    top = model.top_loadings(spark).collect()
    assert {r["pc1_feature"] for r in top} == {"a", "b"}
    assert top[0]["pc1_loading_text"] == f"{top[0]['pc1_loading']:.3f}"


def test_pca_with_too_few_features(spark, data):
    table = FeatureTable.of(data[2].df, data[2].features[:1])
    model = fit_pca(table)
    scores = model.scores(table, ["id"])
    assert not model.fitted and scores.columns == ["id", "PC1", "PC2"] and scores.count() == 0
    assert model.top_loadings(spark).count() == 0


def test_pca_by_group(spark, data):
    table = data[2]
    f = table.features
    catalog = FeatureCatalog.of("c", {"g": f[:3], "single": f[3:4], "none": ["absent"]})
    rows = {r["group_id"]: r for r in pca_by_group(spark, fit_moments(table), catalog).collect()}
    alone = fit_pca(FeatureTable.of(table.df, f[:3]))
    assert rows["g"]["pc1_percent"] == pytest.approx(alone.explained_percent[0])
    assert rows["single"]["pc1_percent"] is None and rows["none"]["n_features"] == 0


def test_ranking_keeps_order_on_ties():
    assert ranked(np.array([0.5, -0.7, 0.7, 0.5 + 1e-13]), 4) == [1, 2, 0, 3]
    assert ranked(np.array([]), 3) == []


@pytest.mark.parametrize("scale", [True, False])
def test_plsda_agrees_with_iteration(data, scale):
    x, y, *tables = data
    z, (d, _) = plain.standardized(x), plain.dummies(y)
    w, t, fitted = plain.nipals(z, d, 2, scale)
    for table in tables:
        model = fit_plsda(table, scale=scale)
        np.testing.assert_allclose(model.weights, w, atol=1e-8)
        rows = model.scores(table, ["id"]).orderBy("id").collect()
        scores = np.array([[r["LV1"], r["LV2"]] for r in rows])
        np.testing.assert_allclose(scores, t, atol=1e-7)
        np.testing.assert_allclose(model.score_variance, t.var(axis=0), rtol=1e-8)
        assert abs(scores[:, 0] @ scores[:, 1]) < 1e-6
        responses = model.responses(table, ["id"]).orderBy("id").collect()
        np.testing.assert_allclose([list(r)[1:] for r in responses], fitted + d.mean(axis=0), atol=1e-8)
        predicted = [r["prediction"] for r in model.predict(table, ["id"]).orderBy("id").collect()]
        assert predicted == plain.predictions(z, y, 2, scale)


def test_vip_squares_sum_to_feature_count(data):
    model = fit_plsda(data[2])
    assert (model.vip**2).sum() == pytest.approx(6)
    np.testing.assert_allclose(np.linalg.norm(model.weights, axis=0), 1)


def test_rescaling_a_column_changes_nothing(spark, data):
    x, y = data[:2]
    scaled = x.copy()
    scaled[:, 2] = scaled[:, 2] * -1000 + 3
    a, b = fit_plsda(data[2]), fit_plsda(_tables(spark, scaled, y)[0])
    np.testing.assert_allclose(a.vip, b.vip, atol=1e-9)


def test_constants_count_but_get_no_weight(spark):
    x, y = plain.samples(n=80, p=3)
    x = np.column_stack([x, np.full(80, 4.0)])
    model = fit_plsda(_tables(spark, x, y)[0])
    assert model.weights[3].tolist() == [0, 0] and (model.vip**2).sum() == pytest.approx(4)


def test_duplicated_feature_leaves_second_component_zero(spark):
    x, y = plain.samples(n=80, p=1, classes=2)
    model = fit_plsda(_tables(spark, np.column_stack([x, x]), y)[0])
    assert np.isfinite(model.coefficients).all()
    assert model.score_variance[1] == pytest.approx(0, abs=1e-12)


def test_one_class(spark):
    x, _ = plain.samples(n=30, p=3)
    table = _tables(spark, x, ["only"] * 30)[0]
    view = plsda_view(table)
    values = {r["metric"]: (r["value"], r["value_text"]) for r in view.metrics.collect()}
    assert values["Accuracy"][0] == 1.0 and values["Silhouette"] == (None, "N/A")
    assert values["Fisher Ratio"][1] == "N/A"


def test_too_few_features_give_no_view(data):
    assert plsda_view(FeatureTable.of(data[2].df, data[2].features[:1], "y")) is None


def test_missing_values_are_refused_by_default(spark):
    x, y = plain.samples(n=30, p=3)
    x[4, 1] = np.nan
    with pytest.raises(ValueError, match="missing"):
        fit_plsda(_tables(spark, x, y)[0])


def test_quality(data):
    x, y, narrow, _ = data
    z, (d, _) = plain.standardized(x), plain.dummies(y)
    t = plain.nipals(z, d, 2, True)[1]
    predicted = plain.predictions(z, y, 2, True)
    row = quality(narrow, fit_plsda(narrow)).first()
    assert row["accuracy"] == pytest.approx(np.mean([a == b for a, b in zip(y, predicted)]))
    assert row["macro_f1"] == pytest.approx(plain.macro_f1(y, predicted))
    assert row["silhouette"] == pytest.approx(plain.silhouette(t[:, 0], t[:, 1], np.array(y)), abs=1e-8)
    labels = np.array(y)
    between = sum((labels == c).sum() * ((t[labels == c].mean(0) - t.mean(0)) ** 2).sum() for c in set(y))
    within = sum(((t[labels == c] - t[labels == c].mean(0)) ** 2).sum() for c in set(y))
    assert row["fisher_ratio"] == pytest.approx(between / within)


def test_view_tables(spark, data):
    view = plsda_view(data[2], ["id"])
    assert view.scores.columns == ["id", "y", "LV1", "LV2"] and view.scores.count() == 240
    assert view.vip.count() == 6 and view.top_weights.count() == 6
    assert [r["metric"] for r in view.metrics.orderBy("ord").collect()] == [
        "Accuracy", "F1 Score", "Silhouette", "Fisher Ratio",
    ]


@pytest.mark.parametrize("form", [0, 1])
def test_number_of_passes(spark, monkeypatch, form):
    """One pass on complete data; a second with gaps or a misleading start."""
    from covaria.operators import moments as module

    passes = []
    add_up = module._add_up
    monkeypatch.setattr(module, "_add_up", lambda *a, **k: passes.append(1) or add_up(*a, **k))
    x, y = plain.samples(n=120, p=3)
    fit_moments(_tables(spark, x, y)[form])
    assert len(passes) == 1
    gaps = x.copy()
    gaps[5, 1] = np.nan
    fit_moments(_tables(spark, gaps, y)[form])
    assert len(passes) == 3
    monkeypatch.setattr(module, "_rough_mean", lambda table: np.full(3, 1e9))
    z = plain.standardized(x)
    np.testing.assert_allclose(fit_moments(_tables(spark, x, y)[form]).gram, z.T @ z, atol=1e-9)
    assert len(passes) == 5


@pytest.mark.parametrize("form", [0, 1])
def test_constant_and_empty_columns(spark, form):
    x, y = plain.samples(n=50, p=4)
    x[:, 1], x[:, 2] = 3.3, np.nan
    m = fit_moments(_tables(spark, x, y)[form])
    assert m.scaling.constant.tolist() == [False, True, False, False]
    assert m.gram[1].tolist() == [0.0] * 4 and m.gram[2].tolist() == [0.0] * 4
    assert fit_pca(_tables(spark, x, y)[form]).features == ("f/0.x", "f/3.x")


def test_nothing_selected(spark, data):
    table = FeatureTable.of(data[2].df, [], "y")
    assert fit_pca(table).scores(table, ["id"]).count() == 0
    assert fit_plsda(table) is None


def test_no_rows(spark, data):
    for table in data[2:]:
        nothing = table.with_df(table.df.where("id < 0"))
        assert fit_moments(nothing).n_rows == 0
        assert not fit_pca(nothing).fitted


def test_ragged_arrays_are_refused(spark):
    df = spark.createDataFrame([(i, [1.0 * i] * (3 if i else 2)) for i in range(5)], "id int, x array<double>")
    with pytest.raises(Exception):
        fit_moments(FeatureTable.of(df, ["a", "b", "c"], array="x"))


def test_many_columns(spark):
    """Beyond the narrow limit plain columns take the batch path as well."""
    x, y = plain.samples(n=90, p=30)
    table = _tables(spark, x, y)[0]
    assert not table.narrow
    z, (d, _) = plain.standardized(x), plain.dummies(y)
    np.testing.assert_allclose(fit_moments(table).gram, z.T @ z, atol=1e-9)
    model = fit_plsda(table)
    w, t, _ = plain.nipals(z, d, 2, True)
    np.testing.assert_allclose(model.weights, w, atol=1e-7)
    rows = model.scores(table, ["id"]).orderBy("id").collect()
    np.testing.assert_allclose([[r["LV1"], r["LV2"]] for r in rows], t, atol=1e-6)
    assert model.top_weights(spark).count() == 10 and model.vip_df(spark).count() == 10
    assert model.vip_df(spark, top=None).count() == 30


def test_many_terms_take_the_batch_path(data, monkeypatch):
    """Scores and predictions agree however they are computed."""
    from covaria.operators import project as module

    table = data[2]
    model = fit_plsda(table)
    before = model.predict(table, ["id", "y"]).orderBy("id").collect()
    scores = model.scores(table, ["id"]).orderBy("id").collect()
    monkeypatch.setattr(module, "EXPRESSION_LIMIT", 0)
    assert model.predict(table, ["id", "y"]).orderBy("id").collect() == before
    again = model.scores(table, ["id"]).orderBy("id").collect()
    np.testing.assert_allclose([list(r) for r in again], [list(r) for r in scores], atol=1e-12)


def test_whole_catalogues(spark):
    """The full sample and entity catalogues, with all their odd column names."""
    from covaria.operators.selection import forward_selection
    from covaria.plans.analyses import pca_map, requested
    from covaria.sources import ENTITY_CATALOG, SAMPLE_CATALOG

    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 133))
    y = ["CsCl", "NaCl", "ZnS"] * 20
    x[:, 5] += np.arange(60) % 3
    frame = pd.DataFrame(x, columns=SAMPLE_CATALOG.columns)
    frame["Class"] = y
    samples = spark.createDataFrame(frame)
    table = requested(samples, SAMPLE_CATALOG, label="Class", all_=True)
    view = plsda_view(table)
    assert view.scores.count() == 60 and view.vip.count() == 10
    assert view.model.vip @ view.model.vip == pytest.approx(133)
    history = forward_selection(table, plateau_steps=1, seed=1).orderBy("step").collect()
    assert len(history) >= 2 and history[-1]["accuracy"] >= history[0]["accuracy"]

    frame = pd.DataFrame(rng.normal(size=(30, 72)), columns=ENTITY_CATALOG.columns)
    frame["Symbol"] = [f"E{i}" for i in range(30)]
    entities = spark.createDataFrame(frame)
    chosen = requested(entities, ENTITY_CATALOG, groups=["thermal_and_physical_properties"])
    assert len(chosen.features) == 10 and "Density,  g/mL" in chosen.features
    assert requested(entities, ENTITY_CATALOG).features == ("Period", "Group")
    found = pca_map(requested(entities, ENTITY_CATALOG, all_=True), "Symbol")
    assert found.top_loadings.count() == 10 and found.scores.count() == 30
