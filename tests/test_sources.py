import pytest
from pyspark.sql import types as T

from covaria.functions import join_names, safe_division, split_names
from covaria.operators.lookups import invert_categories, with_category
from covaria.sources import (
    ENTITY_CATALOG,
    SAMPLE_CATALOG,
    FeatureCatalog,
    element_categories,
    read_entities,
    read_pairs,
    read_samples,
    split_label,
)
from pyspark.sql import functions as F

ODD = ["polarizability, A^3", "Density,  g/mL", "1st Bohr radius (a0)", "Z_eff_A/B", "a.b"]


def test_catalogue_sizes(spark):
    assert (len(SAMPLE_CATALOG.groups), len(SAMPLE_CATALOG.columns)) == (21, 133)
    assert (len(ENTITY_CATALOG.groups), len(ENTITY_CATALOG.columns)) == (7, 72)
    assert SAMPLE_CATALOG.to_df(spark).count() == 133
    assert set(SAMPLE_CATALOG.defaults) <= set(SAMPLE_CATALOG.columns)
    assert set(ENTITY_CATALOG.defaults) <= set(ENTITY_CATALOG.columns)
    assert SAMPLE_CATALOG.group_columns("period_group") == (
        "period_A", "period_B", "group_A", "group_B", "group_A-B",
    )


def test_resolve_keeps_catalogue_order():
    catalog = FeatureCatalog.of("c", {"g": ["a", "b"], "h": ["c", "d"]}, defaults=["d", "a"])
    have = ["d", "c", "b", "a"]
    assert catalog.resolve(have).columns == ("a", "d")
    assert catalog.resolve(have, columns=["d", "b", "zzz"]).columns == ("b", "d")
    assert catalog.resolve(have, groups=["h"], columns=["a"]).columns == ("a", "c", "d")
    assert catalog.resolve(have, all_=True, exclude_groups=["g"]).columns == ("c", "d")
    assert catalog.resolve(have, all_=True, exclude_columns=["c"]).columns == ("a", "b", "d")
    assert catalog.resolve(have, columns=[]).columns == ()
    assert catalog.resolve(["a"], groups=["g"]) .missing == ("b",)
    with pytest.raises(ValueError):
        catalog.resolve(have, groups=["nope"])


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_formats_and_odd_names(spark, tmp_path, fmt):
    names = [n for n in ODD if fmt != "orc" or "." not in n]
    schema = T.StructType(
        [T.StructField("Symbol", T.StringType())] + [T.StructField(n, T.DoubleType()) for n in names]
    )
    df = spark.createDataFrame([("Na", *[1.5] * len(names)), ("Cl", *[2.5] * len(names))], schema)
    path = str(tmp_path / fmt)
    writer = df.write.format(fmt)
    (writer.option("header", "true") if fmt == "csv" else writer).save(path)
    back = read_entities(spark, path, features=names, fmt=fmt, schema=schema)
    assert back.columns == ["Symbol", *names]
    assert sorted(r["Symbol"] for r in back.collect()) == ["Cl", "Na"]
    assert sorted(tuple(r)[1:] for r in back.collect())[0] == (1.5,) * len(names)


def test_readers_prune_columns(spark, tmp_path):
    path = str(tmp_path / "pairs")
    spark.createDataFrame([("NaCl", "NaCl", 1)], "Formula string, `Structure type` string, other int").write.parquet(path)
    df = read_pairs(spark, path)
    assert df.columns == ["formula", "structure"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "other" not in plan.split("ReadSchema")[1]


def test_read_samples(spark, tmp_path):
    path = str(tmp_path / "samples")
    spark.createDataFrame([(1, "a", 2, 3.0)], "id int, Class string, f int, g double").write.parquet(path)
    df = read_samples(spark, path, keys=["id"])
    assert df.columns == ["id", "Class", "f", "g"]
    assert dict(df.dtypes)["f"] == "double"
    assert split_label(df.drop("id"), "Class") == (["f", "g"], "Class")
    with pytest.raises(ValueError):
        split_label(df, "nope")


def test_categories(spark):
    symbols = invert_categories(element_categories(spark))
    found = {r["symbol"]: r["category"] for r in symbols.collect()}
    assert len(found) == 118
    assert (found["Na"], found["Cl"], found["Fe"], found["U"]) == (
        "alkali_metals", "halogens", "transition_metals", "actinides",
    )
    rows = spark.createDataFrame([("Na",), ("Xx",), (None,)], "symbol string")
    got = {r["symbol"]: r["category"] for r in with_category(rows, symbols, "symbol").collect()}
    assert got == {"Na": "alkali_metals", "Xx": "other", None: "other"}


def test_later_category_wins(spark):
    lists = spark.createDataFrame(
        [("one", 0, ["a", "b"]), ("two", 1, ["b", "c"])], "category string, ord int, symbols array<string>"
    )
    assert {r["symbol"]: r["category"] for r in invert_categories(lists).collect()} == {
        "a": "one", "b": "two", "c": "two",
    }


def test_scalars(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_division(F.col("a"), F.col("b"), 7.0)).collect()] == [0.5, 7.0, None]
    names = spark.createDataFrame([(["a", "b"],), ([],)], "n array<string>")
    text = names.select(join_names(F.col("n")).alias("t"))
    assert [r["t"] for r in text.collect()] == ["a,b", ""]
    assert [r[0] for r in text.select(split_names(F.col("t"))).collect()] == [["a", "b"], []]
