import hashlib
import random
import re
from collections import Counter

import pytest

from covaria.llm import exact
from tests.llm import edge


def _brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    out = []
    for body, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        for i, t in members:
            out.append((i, best[0], len(members), hashlib.sha256(body.encode()).hexdigest()))
    return Counter(out)


def _found(df):
    return Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in df.collect())


def test_edge_cases(spark):
    docs = edge.table(spark)
    assert _found(exact.grouped(docs)) == _brute(edge.TEXTS)
    kept = exact.deduplicated(docs)
    assert kept.columns == docs.columns
    bodies = [re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "") for r in kept.collect()]
    assert len(bodies) == len(set(bodies)) == len({b for _, t in edge.TEXTS for b in [re.sub(r"[\x20\x09-\x0D]", "", t or "")]})


def test_empty_table(spark):
    docs = edge.table(spark, []).limit(0)
    assert exact.grouped(docs).count() == 0 and exact.deduplicated(docs).count() == 0


@pytest.mark.parametrize("primes", [(2, 2, 2, 2), (3, 2, 2, 2)])
def test_texts_with_equal_fingerprints_are_told_apart(spark, primes):
    """With tiny primes nearly all texts of one length collide; results must not change."""
    r = random.Random(1)
    rows = [(i, "".join(r.choices("ab c", k=6)) * r.choice([1, 1, 20_000])) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _found(exact.grouped(docs, primes=primes, points=(1, 1, 1, 1))) == _brute(rows)


def test_fingerprints_compose():
    r = random.Random(2)
    for n in (0, 1, 4095, 4096, 4097, 50_000):
        text = r.randbytes(n)
        whole = exact.fingerprints_of([text])[0]
        for _ in range(3):
            at = r.randint(0, n)
            left, right = exact.fingerprints_of([text[:at], text[at:]])
            assert exact.combine(left, right, n - at) == whole
        value = [0] * 4
        for k, (p, point) in enumerate(zip(exact.PRIMES, exact.POINTS)):
            for b in text[:2000]:
                value[k] = (value[k] * point + b) % p
        if n <= 2000:
            assert tuple(value) == whole


def test_deduplicated_keeps_columns_of_any_name(spark):
    from covaria.llm import exact, simhash

    rows = [(1, "same text", "u1", "h1", "r1", "d1"), (2, "same text", "u2", "h2", "r2", "d2"),
            (3, "other", "u3", "h3", "r3", "d3"), (3, "other", "u3", "h3", "r3", "d3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id string, __h string, __row string, `a.b` string")
    for kept in (exact.deduplicated(docs), simhash.deduplicated(docs)):
        assert kept.columns == docs.columns
        got = sorted(tuple(r) for r in kept.collect())
        assert got == [(1, "same text", "u1", "h1", "r1", "d1"), (3, "other", "u3", "h3", "r3", "d3")]


def test_groups_are_not_broadcast(spark):
    """Spark takes a fingerprint's text to be 20 bytes long, and so the groups for half of what they are."""
    marks = exact.grouped(edge.table(spark))
    plan = marks._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
