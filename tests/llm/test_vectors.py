"""Exact top-k search and hard negatives against brute force, over several blocks."""

import math
import random

import numpy as np
import pytest

from covaria.llm import negatives, topk
from covaria.llm.negatives import Lists

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score string, v string"


def _rows(n=300, dims=6, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # Few distinct values: many ties in scores.
        vec = [rng.choice([-0.5, -0.25, 0.0, 0.01, 0.25, 0.5]) for _ in range(dims)]
        label = rng.randrange(4)
        if i % 37 == 5:
            vec[2] = None
        if i % 41 == 6:
            vec[0] = math.nan
        if i % 43 == 7:
            vec[1] = math.inf
        if i % 47 == 8:
            vec = None
        if i % 53 == 9:
            label = None
        rows.append((i, vec, label, "x", "y", "z"))
    rows.append((100, [0.5] * dims, 1, "x", "y", "z"))  # a repeated id beside a query
    rows.append((None, [0.25] * dims, 1, "x", "y", "z"))
    rows.append((1000, [], 2, "x", "y", "z"))
    return rows


def _usable(vec, vec_id=0):
    return vec_id is not None and vec is not None and all(x is not None and math.isfinite(x) for x in vec)


def _ints(vec):
    return [math.floor(256 * float(np.float32(x))) for x in vec]


def _dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_topk(rows, every=50, k=5):
    vecs = [(i, _ints(v)) for i, v, *_ in rows if _usable(v, i)]
    out = []
    for q in sorted({i for i, _ in vecs if i % every == 0}):
        # A repeated query id: its list is the best among the scores against any of its rows.
        ranked = sorted((-_dot(qv, cv), c) for i, qv in vecs if i == q for c, cv in vecs if c != q)
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(ranked[:k])]
    return sorted(out, key=lambda t: (t[0], t[1]))


def brute_negatives(rows, every=100, shift=7, positives=5, negatives_=10):
    vecs = []
    for i, v, label, *_ in rows:
        if not _usable(v, i) or label is None:
            continue
        if i is not None and i % shift == 0:
            label = (label + 1) % 10
        vecs.append((i, label, _ints(v)))
    out = []
    key = lambda t: (-t[0], t[1])
    for a in sorted({i for i, _, _ in vecs if i % every == 0}):
        # A repeated anchor id scores every row against each of its rows, as a SQL join would.
        others = [(_dot(av, v), i, l, al) for j, al, av in vecs if j == a for i, l, v in vecs if i != a]
        pos = sorted([t for t in others if t[2] == t[3]], key=key)[:positives]
        for ps, pi, _, _ in pos:
            neg = sorted([t for t in others if t[2] != t[3] and 30 * ps <= 100 * t[0] <= 90 * ps], key=key)[:negatives_]
            out += [(a, pi, r + 1, ni, ps, ns) for r, (ns, ni, _, _) in enumerate(neg)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(512, 8192), (3, 7)])
def test_topk_against_brute_force(spark, blocks):
    rows = _rows()
    table = spark.createDataFrame(rows, SCHEMA)
    found = topk.searched(table, every=50, k=5, query_rows=blocks[0], candidate_rows=blocks[1])
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    ours = sorted((tuple(r) for r in found.collect()), key=lambda t: (t[0], t[1]))
    assert ours == brute_topk(rows)
    assert topk.searched(table.limit(0)).count() == 0


@pytest.mark.parametrize("every", [100, 10])
def test_negatives_against_brute_force(spark, every):
    rows = _rows(500, dims=5, seed=3)
    table = spark.createDataFrame(rows, SCHEMA)
    found = negatives.mined(table, every=every)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    ours = sorted(tuple(r) for r in found.collect())
    assert ours == brute_negatives(rows, every=every)
    assert len(ours) > 0
    assert negatives.mined(table.limit(0)).count() == 0


def test_threshold_walk_meets_brute_force_and_stops_early():
    rng = np.random.default_rng(5)
    values = rng.integers(-128, 128, size=(4000, 16))
    ids = np.arange(4000)
    lists = Lists(values, ids)
    for _ in range(20):
        anchor = rng.integers(-128, 128, size=16)
        anchor[rng.integers(0, 16)] = 0
        eligible = rng.random(4000) < 0.7
        scores = values @ anchor
        top = np.sort(scores)[::-1]
        windows = [(-np.inf, np.inf, 5), (int(top[200]), int(top[100]), 10), (int(top[50]) + 1, int(top[50]), 3)]
        found = lists.walk(anchor, eligible, windows)
        for (low, high, k), chosen in zip(windows, found):
            places = [p for p in np.lexsort((ids, -scores)) if eligible[p] and low <= scores[p] <= high][:k]
            assert list(chosen) == places
    # An unbounded window of the best five does not need every row.
    anchor = rng.integers(1, 128, size=16)
    lists.walk(anchor, np.ones(4000, dtype=bool), [(-np.inf, np.inf, 5)])
