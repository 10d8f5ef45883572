import random
import re

import pytest
from pyspark.sql import functions as F

from covaria.operators.features import FeatureTable
from covaria.operators.links import link_counts, pair_links, rejected_pairs, split_pairs
from covaria.operators.lookups import first_per_key, lookup
from covaria.plans.analyses import pair_map, pca_map, with_element_category
from covaria.sources import POSITION, read_entities

FORMULAS = [("NaCl", "s1"), ("CsCl", "s2"), ("ZnS", "s3"), ("Na", "s1"), ("NaClO", "s1"), ("Na2Cl2", "s2"), ("XxCl", "s3"), (None, "s1")]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(FORMULAS, "formula string, structure string")


@pytest.fixture(scope="module")
def scores(spark):
    rows = [(0, "Na", 0.0, 0.0), (1, "Cl", 2.0, 4.0), (2, "Cs", -2.0, 2.0), (3, "Na", 9.0, 9.0), (4, "Zn", 1.0, 1.0), (5, "S", 3.0, -1.0)]
    return spark.createDataFrame(rows, "ord int, Symbol string, PC1 double, PC2 double")


def test_tokens(pairs):
    found = {r["formula"]: r["tokens"] for r in split_pairs(pairs).collect()}
    assert found["NaCl"] == ["Na", "Cl"] and found["NaClO"] == ["Na", "Cl", "O"] and found["Na2Cl2"] == ["Na", "Cl"]


def test_rejects(pairs):
    assert {(r["formula"], r["n_tokens"]) for r in rejected_pairs(pairs).collect()} == {("Na", 1), ("NaClO", 3), (None, 0)}


def test_links(pairs, scores):
    links = {r["formula"]: r for r in pair_links(pairs, scores, order_by=["ord"]).collect()}
    assert set(links) == {"NaCl", "CsCl", "ZnS", "Na2Cl2"}
    first = links["NaCl"]
    assert (first["x0"], first["y0"], first["x1"], first["y1"]) == (0.0, 0.0, 2.0, 4.0)
    assert (first["mid_x"], first["mid_y"], first["structure"]) == (1.0, 2.0, "s1")
    counts = link_counts(pairs, scores).first()
    assert tuple(counts) == (5, 4, 1)


def test_first_per_key(scores):
    by_order = {r["Symbol"]: r["PC1"] for r in first_per_key(scores, "Symbol", ["PC1"], ["ord"]).collect()}
    assert by_order["Na"] == 0.0 and len(by_order) == 5
    descending = scores.withColumn("back", -F.col("ord"))
    assert {r["Symbol"]: r["PC1"] for r in first_per_key(descending, "Symbol", ["PC1"], ["back"]).collect()}["Na"] == 9.0


@pytest.mark.parametrize("keep", [True, False])
def test_large_lookup_equals_broadcast(spark, keep):
    """One key holds a third of the rows, some keys are missing, some are NULL."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 5000)
    rows = spark.range(30000).select("id", key.alias("k"))
    table = spark.range(4000).select(F.col("id").alias("t"), (F.col("id") * 2).alias("value"))
    small = lookup(rows, table, "k", "t", keep)
    large = lookup(rows, table, "k", "t", keep, broadcast_bytes=0)
    assert large.columns == small.columns == ["id", "k", "value"]
    assert large.exceptAll(small).count() == 0 and small.exceptAll(large).count() == 0


def test_first_row_of_a_file_wins(spark, tmp_path):
    rows = [("B", 5.0, 1.0), ("A", 9.0, 2.0), ("A", 1.0, 7.0), ("C", 2.0, 2.0), ("A", 0.0, 0.0), ("D", 3.0, 4.0)]
    path = str(tmp_path / "entities")
    spark.createDataFrame(rows, "Symbol string, a double, b double").coalesce(1).write.parquet(path)
    df = read_entities(spark, path, features=["a", "b"], with_position=True)
    first = first_per_key(df, "Symbol", ["a", "b"], POSITION)
    assert {r["Symbol"]: (r["a"], r["b"]) for r in first.collect()}["A"] == (9.0, 2.0)
    table = FeatureTable.of(df, ["a", "b"])
    pairs = spark.createDataFrame([("AB", "s")], "formula string, structure string")
    link = pair_map(table, pairs, "Symbol", order_by=POSITION).links.first()
    scores = pca_map(table, "Symbol").model.scores(table, ["Symbol", "a"]).where("Symbol = 'A' and a = 9.0").first()
    assert link["x0"] == pytest.approx(scores["PC1"])


def test_random_formulas_against_re(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ABCabc0-é ") for _ in range(rng.randrange(12))) for _ in range(500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, formula string")
    found = {r["i"]: r["tokens"] for r in split_pairs(df).collect()}
    assert all(found[i] == re.findall("[A-Z][a-z]?", t) for i, t in enumerate(texts))
    rejected = {r["i"] for r in rejected_pairs(df).collect()}
    assert rejected == {i for i, t in enumerate(texts) if len(re.findall("[A-Z][a-z]?", t)) != 2}


def test_maps(spark, pairs):
    rows = [("Na", 1.0, 2.0, 5.0), ("Cl", 3.0, 1.0, 4.0), ("Cs", 2.0, 5.0, 1.0), ("Zn", 0.0, 1.0, 1.0), ("S", 4.0, 2.0, 2.0)]
    table = FeatureTable.of(spark.createDataFrame(rows, "Symbol string, a double, b double, c double"), ["a", "b", "c"])
    found = pair_map(table, pairs, "Symbol")
    assert found.links.count() == 4 and found.counts.first()["n_skipped"] == 1
    grouped = with_element_category(pca_map(table, "Symbol").scores)
    assert {r["Symbol"]: r["category"] for r in grouped.collect()}["Zn"] == "transition_metals"
    assert found.entities.explained_variance.count() == 2


def test_large_lookup_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN id % 7 END AS k").write.parquet(path)
    rows = spark.read.parquet(path)
    table = spark.range(5).selectExpr("id AS t", "repeat('v', 10) AS v")
    found = lookup(rows, table, "k", "t", True, broadcast_bytes=0)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert found.count() == 1000 and found.columns == ["id", "k", "v"]
    assert found.where("v IS NOT NULL").count() == rows.where("k < 5").count()


def test_bytes_are_measured(spark):
    from covaria.operators.lookups import measured_bytes

    table = spark.range(10).selectExpr("id", "repeat('é', 1000) AS v")
    assert 20_000 <= measured_bytes(table) <= 21_000 and measured_bytes(table.limit(0)) == 0
