import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from covaria.operators import profile as P
from covaria.operators.features import FeatureTable

INF, NAN = float("inf"), float("nan")
ROWS = [
    (1, 1.0, 5.0, None, NAN, INF, None),
    (2, 2.0, 5.0, 3.0, 1.0, 2.0, None),
    (3, 4.0, 5.0, 7.0, 2.0, -INF, None),
    (4, 8.0, 5.0, 1.0, None, 4.0, None),
    (5, 0.5, 5.0, 2.0, 4.0, 6.0, None),
    (6, 3.0, 5.0, 2.0, 3.0, 1.0, None),
]
NAMES = ["plain", "constant", "gap", "nan", "inf", "empty"]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id int, " + ", ".join(f"`{n}` double" for n in NAMES))


def _wide(df):
    return FeatureTable.of(df.select("id", F.array(*[F.col(n) for n in NAMES]).alias("x")), NAMES, array="x")


@pytest.mark.parametrize("form", ["narrow", "wide"])
def test_profile_counts(df, form):
    table = FeatureTable.of(df, NAMES) if form == "narrow" else _wide(df)
    found = {r["column"]: r for r in P.profile(table).collect()}
    assert [found[n]["n_null"] for n in NAMES] == [0, 0, 1, 1, 0, 6]
    assert [found[n]["n_nan"] for n in NAMES] == [0, 0, 0, 1, 0, 0]
    assert [found[n]["n_inf"] for n in NAMES] == [0, 0, 0, 0, 2, 0]
    assert found["gap"]["mean"] == pytest.approx(3.0)
    assert found["inf"]["mean"] == pytest.approx(13 / 4)
    assert found["plain"]["std_samp"] == pytest.approx(math.sqrt(sum((r[1] - 18.5 / 6) ** 2 for r in ROWS) / 5))
    assert found["empty"]["mean"] is None


def test_dropping(df):
    assert P.drop_nan_columns(df, NAMES).columns == ["id", "plain", "constant", "inf"]
    assert P.drop_zero_variance(df, NAMES).columns == ["id", "plain", "gap", "nan", "inf", "empty"]


def test_single_row_is_not_constant(df):
    assert "constant" in P.drop_zero_variance(df.where("id = 1"), NAMES).columns


def test_clean(df):
    rows = P.clean_columns(df, NAMES, nan_value=-1.0, inf_value=9.0).orderBy("id").collect()
    assert [r["gap"] for r in rows] == [-1.0, 3.0, 7.0, 1.0, 2.0, 2.0]
    assert [r["nan"] for r in rows] == [-1.0, 1.0, 2.0, -1.0, 4.0, 3.0]
    assert [r["inf"] for r in rows] == [9.0, 2.0, 9.0, 4.0, 6.0, 1.0]


def test_policies(df):
    scaling = P.fit_scaling(FeatureTable.of(df, NAMES))
    with pytest.raises(ValueError, match="infinite"):
        P.usable_features(scaling, "drop_column")
    with pytest.raises(ValueError, match="missing"):
        P.usable_features(scaling, "error")
    with pytest.raises(ValueError, match="nan_policy"):
        P.usable_features(scaling, "other")
    assert P.usable_features(scaling, "impute") == ("plain", "gap", "nan", "inf", "empty")
    finite = scaling.subset(["plain", "constant", "gap"])
    assert P.usable_features(finite, "drop_column") == ("plain",)
    assert P.usable_features(finite, "drop_column", drop_constant=False) == ("plain", "constant")


@pytest.mark.parametrize("form", ["narrow", "wide"])
def test_standardize(df, form):
    table = FeatureTable.of(df, NAMES) if form == "narrow" else _wide(df)
    rows = P.standardize(table, keep=["id"], impute=True).orderBy("id").collect()
    z = [[r[n] for n in NAMES] if form == "narrow" else list(r["x"]) for r in rows]
    for j, name in enumerate(NAMES):
        column = [r[j] for r in z]
        assert sum(column) == pytest.approx(0, abs=1e-12), name
    assert [r[1] for r in z] == [0.0] * 6 and [r[5] for r in z] == [0.0] * 6
    assert z[0][2] == 0.0 and z[0][4] == 0.0


def test_standardize_keeps_gaps(df):
    rows = P.standardize(FeatureTable.of(df, ["gap"]), keep=["id"]).orderBy("id").collect()
    assert rows[0]["gap"] is None and rows[1]["gap"] == pytest.approx(0.0)


def test_no_rows(df):
    scaling = P.fit_scaling(FeatureTable.of(df.where("id < 0"), NAMES))
    assert scaling.n_rows == 0 and not scaling.constant.any()


def test_wide_profile_of_gaps_and_far_means(spark):
    rng = np.random.default_rng(1)
    x = 1e9 + rng.normal(size=(500, 8))
    rows = [[i, [float(v) for v in r]] for i, r in enumerate(x)]
    rows[0][1][0], rows[1][1][1], rows[2][1][2] = None, float("nan"), float("inf")
    for r in rows:
        r[1][7] = None
    table = FeatureTable.of(
        spark.createDataFrame(rows, "id int, x array<double>").repartition(5), [f"f{i}" for i in range(8)], array="x"
    )
    got = {r["ord"]: r for r in P.profile(table).collect()}
    assert all(r["n_rows"] == 500 for r in got.values())
    assert (got[0]["n_null"], got[1]["n_nan"], got[2]["n_inf"], got[7]["n_null"]) == (1, 1, 1, 500)
    assert got[7]["mean"] is None and got[7]["std_pop"] is None and got[7]["min_value"] is None
    for j in range(3, 7):
        assert got[j]["std_samp"] == pytest.approx(x[:, j].std(ddof=1), rel=1e-6)
        assert got[j]["mean"] == pytest.approx(x[:, j].mean(), rel=1e-15)


@pytest.mark.parametrize("bad", [None, [1.0], [1.0] * 9])
def test_wide_profile_refuses_ragged_rows(spark, bad):
    df = spark.createDataFrame([(1, [1.0] * 8), (2, bad)], "id int, x array<double>")
    with pytest.raises(Exception, match="every row needs an array of exactly 8 numbers"):
        P.profile(FeatureTable.of(df, [f"f{i}" for i in range(8)], array="x")).collect()
