import random
from importlib import import_module

import numpy as np
import pytest
import xxhash

from covaria.llm import simhash, text
from covaria.llm.components import components
from covaria.operators.durable import stored
from tests.llm import edge


def _fingerprint(text, n=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(prints, most):
    """Smallest member of each member's component, by comparing all pairs."""
    values = sorted(set(prints))
    up = {v: v for v in values}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= most:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {v: root(v) for v in values}


def test_edge_cases(spark):
    rows = {(r["doc_id"], r["h"]): r for r in simhash.grouped(edge.table(spark)).collect()}
    found = [(r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.grouped(edge.table(spark)).collect()]
    wanted = sorted(((i, _fingerprint(t)) for i, t in edge.TEXTS), key=str)
    assert sorted(((i, f) for i, f, _ in found), key=str) == wanted and rows
    parts = _components([f for _, f in wanted], 3)
    smallest = {}
    for i, f in wanted:
        if i is not None:
            smallest[parts[f]] = min(i, smallest.get(parts[f], i))
    assert all(c == smallest.get(parts[f]) for _, f, c in found)
    kept = simhash.deduplicated(edge.table(spark))
    assert kept.count() == len(set(parts.values())) and kept.columns == edge.table(spark).columns


def test_empty_table(spark):
    docs = edge.table(spark, []).limit(0)
    assert simhash.grouped(docs).count() == 0 and simhash.deduplicated(docs).count() == 0


@pytest.mark.parametrize("most", [1, 2, 3, 4, 6])
def test_all_close_pairs_are_connected(spark, most):
    r = random.Random(most)
    values = [r.getrandbits(64) for _ in range(60)] + [0, 2**64 - 1]
    for v in list(values):
        for _ in range(6):  # neighbours within and just beyond the bound, also in chains
            v ^= sum(1 << b for b in r.sample(range(64), r.choice([1, most, most + 1])))
            values.append(v)
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    fps = spark.createDataFrame(signed, "fp long").distinct()
    got = {r["node"]: r["component"] for r in components(simhash.links(fps, most)).collect()}
    wanted = _components([v for (v,) in signed], most)
    sizes = {}
    for root in wanted.values():
        sizes[root] = sizes.get(root, 0) + 1
    assert got == {v: root for v, root in wanted.items() if sizes[root] > 1}


def test_anchors_cover():
    random_ = np.random.default_rng(4)
    x = random_.integers(0, 1 << 31, 2000, dtype=np.uint64)
    home, near = simhash.anchors(x, 5)
    assert np.bitwise_count(home ^ x).max() <= 1
    assert np.bitwise_count(near ^ x[:, None]).max() <= 2
    y = x ^ (np.uint64(1) << random_.integers(0, 31, 2000, dtype=np.uint64))
    assert (near == simhash.anchors(y, 5)[0][:, None]).any(axis=1).all()


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(300)] + [(100, 100)]
    links = spark.createDataFrame(chain + star + chain, "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(301)}
    assert components(links.limit(0)).count() == 0


@pytest.fixture
def plans(monkeypatch):
    """The plan of every table that SimHash and its components store."""
    seen = []

    def spy(df):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    for name in ("simhash", "components"):
        monkeypatch.setattr(import_module(f"covaria.llm.{name}"), "stored", spy)
    return seen


def test_copies_of_fingerprints_are_not_broadcast(spark, tmp_path):
    fps = [(v,) for v in (0, 1, 7 << 40, 0x5555 << 20)]
    spark.createDataFrame(fps, "fp long").write.parquet(f"{tmp_path}/fps")
    links = simhash.links(spark.read.parquet(f"{tmp_path}/fps"))
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {r["node"]: r["component"] for r in components(links).collect()} == {0: 0, 1: 0, 7 << 40: 0}


def test_only_counted_tables_are_broadcast(spark, monkeypatch, plans):
    docs = spark.createDataFrame([(i, f"a b {'c' * (i // 3)}") for i in range(30)], "doc_id long, text string")
    found = []
    for bound in (text.BROADCAST_BYTES, 0):
        monkeypatch.setattr(text, "BROADCAST_BYTES", bound)
        plans.clear()
        marks = simhash.grouped(docs)
        plans.append(marks._jdf.queryExecution().executedPlan().toString())
        found.append(sorted(marks.drop("h").collect()))
        joins = [p for p in plans if "Join" in p]
        assert joins and (bound or not any("BroadcastHashJoin" in p for p in joins))
    assert found[0] == found[1]
