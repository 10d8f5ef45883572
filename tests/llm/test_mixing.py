import pytest
from pyspark.sql import functions as F

from covaria.llm import mixing
from tests.llm import edge


def _targets(sizes, weights, epochs=3):
    """Water-filling one step at a time; sizes and weights by source."""
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in fixed]
        weight = sum(weights[s] for s in free)
        level = (total - sum(fixed.values())) / weight if weight else 0
        over = [s for s in free if weights[s] * level > epochs * sizes[s]]
        if not over:
            return fixed | {s: weights[s] * level for s in free}
        fixed |= {s: epochs * sizes[s] for s in over}


def _check(rows):
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    wanted = _targets(sizes, {s: k % 3 + 1 for k, s in enumerate(order)})
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(wanted[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    return wanted, taken, sizes


def _mixed(docs):
    mix = mixing.mixed(docs, mixing.cycled(1, 2, 3)).withColumnRenamed("doc_id", "i")
    ids = docs.select("doc_id", "source", F.count("*").over(mixing.Window.partitionBy("doc_id")).alias("n"))
    return mix.join(ids.where("n = 1"), mix.i == ids.doc_id).collect(), mix


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows, _ = _mixed(docs)
    assert len(rows) == docs.count()
    wanted, taken, sizes = _check(rows)
    for s in wanted:
        assert abs(taken[s] - wanted[s]) <= max(0.02 * wanted[s], 30)
    again, _ = _mixed(docs.repartition(7))
    assert {r["doc_id"]: r["taken"] for r in again} == {r["doc_id"]: r["taken"] for r in rows}
    mix = mixing.repeated(docs, mixing.cycled(1, 2, 3))
    times = {r["doc_id"]: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    assert mix.columns == docs.columns
    assert times == {r["doc_id"]: r["taken"] // r["size"] for r in rows if r["taken"]} | {
        i: times[i] for i in times if i in {r["doc_id"] for r in rows if not r["size"]}
    }


def test_capped_sources(spark):
    rows = [(i, "w " * (i % 7 + 1), "big") for i in range(900)] + [(1000 + i, "v u", s) for i in range(6) for s in ("a", None)]
    rows = [(k, t, s) for k, (_, t, s) in enumerate(rows)] + [(5000, None, "empty"), (5001, " ", "empty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found, _ = _mixed(docs)
    wanted, taken, sizes = _check(found)
    assert wanted["a"] == 3 * sizes["a"] == taken["a"] and wanted["empty"] == taken["empty"] == 0
    assert abs(taken["big"] - wanted["big"]) <= 7


def test_edge_cases(spark):
    docs = edge.table(spark)
    mix = mixing.mixed(docs, mixing.cycled(1, 2, 3))
    assert mix.count() == len(edge.TEXTS)
    assert mix.where("taken < 0 OR taken > 3 * size OR target IS NULL").count() == 0
    mixing.repeated(docs, mixing.cycled(1, 2, 3)).count()
    empty = docs.limit(0)
    assert mixing.mixed(empty, mixing.cycled(1, 2, 3)).count() == 0
    assert mixing.repeated(empty, mixing.cycled(1, 2, 3)).count() == 0


def test_nearest_sum_against_all_subsets(monkeypatch):
    import random

    r = random.Random(6)
    for _ in range(60):
        sizes = [r.randrange(0, 40) for _ in range(r.randrange(0, 9))]
        rest = r.randrange(0, 120)
        best = max(s for s in (sum(x for k, x in enumerate(sizes) if m >> k & 1) for m in range(1 << len(sizes))) if s <= rest)
        taken = mixing.nearest_sum(sizes, rest)
        assert sum(x for x, t in zip(sizes, taken) if t) == best
    monkeypatch.setattr(mixing, "SUMS", 2000)
    sizes = [r.randrange(1, 4000) for _ in range(30)]
    total = sum(x for x, t in zip(sizes, mixing.nearest_sum(sizes, 30_000)) if t)
    assert 29_500 <= total <= 30_000


def test_a_very_long_document_at_the_cut_does_not_end_the_walk():
    import numpy as np

    sizes = np.array([300] * 400 + [200_000] + [300] * 400)
    for rest in (200_000, 199_999, 150_000, 0):
        taken = mixing.filled(sizes, rest)
        assert 0 <= rest - sizes[taken].sum() < 300
    rng = np.random.default_rng(2)
    for _ in range(100):
        sizes = rng.integers(5, 600, 333)
        sizes[rng.choice(333, 2, False)] = 20_000
        rest = int(rng.integers(1, sizes.sum()))
        taken = mixing.filled(sizes, rest)
        left = rest - sizes[taken].sum()
        assert left >= 0 and (taken.all() or left < sizes[~taken].min())
