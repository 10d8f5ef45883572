import random

import numpy as np
import pytest

from covaria.llm import paragraphs as P
from covaria.llm.queries import op7_substring_dedup
from tests.llm import edge


def _classes(texts, threshold=0.8):
    """Classes of paragraphs by comparing all pairs of shingle sets; ids to class representative."""
    sets = {}
    for t in texts:
        found = P.Paragraphs.of([t.encode()], P.RADIUS, P.LEAST_WORDS)
        grams, counts = found.shingles()
        ends = np.cumsum(counts)
        for i, a, b in zip(found.ids.tolist(), (ends - counts).tolist(), ends.tolist()):
            sets[i] = set(grams[a:b].tolist())
    ids = sorted(sets)
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def _words(r, n):
    return [f"w{r.randrange(5000)}" for _ in range(n)]


def test_planted_passages(spark):
    r = random.Random(5)
    passages = [_words(r, n) for n in (51, 55, 60, 80, 120)]
    rows, planted = [], {}
    for i in range(150):
        words = _words(r, r.randrange(60, 400))
        if i % 3 == 0:
            k = r.randrange(len(passages))
            at = r.randrange(len(words))
            words[at:at] = passages[k]
            planted.setdefault(k, set()).add(i)
        text = "".join(w + r.choice([" ", " ", "\n", "  "]) for w in words)
        rows.append((i, text))
    marks = P.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {m["doc_id"] for m in marks}
    wanted = set().union(*planted.values())
    assert found <= wanted and len(found) >= 0.93 * len(wanted)
    for m in marks:
        assert m["removed"] == (m["doc_id"] != m["keep_id"])


def test_classes_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(P, "tuned", lambda threshold, recall: (24, 2))  # so that every similar pair meets
    r = random.Random(8)
    base = [_words(r, 18) for _ in range(6)]
    phrase = _words(r, 9)
    texts = []
    for k in range(240):
        words = list(base[k % 6])
        for _ in range(r.choice([0, 0, 1, 2])):
            words[r.randrange(len(words))] = f"v{r.randrange(40)}"
        if k % 4 == 0:
            words = phrase + _words(r, 2 + k % 5)
        texts.append(" ".join(words))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    wanted = _classes(texts)
    linked = {
        x["node"]: x["component"]
        for x in P.components(P.links(docs.select("text"), 0.8, 0.99, P.RADIUS, P.LEAST_WORDS)).collect()
    }
    got = {i: linked.get(i, i) for i in wanted}
    assert got == wanted


def test_edge_cases(spark):
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [
        (1, None), (2, ""), (3, passage), (3, passage), (None, "before " + passage), (4, "heat " * 5000),
        (5, "heat " * 5000 + "x"), (6, passage + " " + passage), (7, "short one"), (8, "x" * 70_000),
    ]
    marks = P.repeated(edge.table(spark, rows)).collect()
    by_id = {m["doc_id"] for m in marks}
    assert {3, None, 6} <= by_id and by_id.isdisjoint({1, 2, 7, 8})
    assert all(m["removed"] for m in marks if m["doc_id"] in (None, 6))
    assert sum(not m["removed"] for m in marks if m["doc_id"] == 3) * 2 == sum(m["doc_id"] == 3 for m in marks)
    assert P.repeated(edge.table(spark, []).limit(0)).count() == 0


def test_query_finds_exact_repeats(spark, sf_dir):
    marks = op7_substring_dedup(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"].split() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    seen = {}
    for i, words in texts.items():
        words = [w.lower() for w in words]
        for k in range(len(words) - 79):
            seen.setdefault(" ".join(words[k : k + 80]), set()).add(i)
    wanted = {i for s in seen.values() if len(s) > 1 for i in s if len(set(texts[i])) > 60}
    assert wanted <= {m["doc_id"] for m in marks}


@pytest.mark.parametrize("recall", [0.9, 0.99, 0.999])
def test_bands_reach_the_recall(recall):
    bands, rows = P.tuned(0.8, recall)
    assert 1 - (1 - 0.8**rows) ** bands >= recall


def test_spans_are_cut_out_of_a_text():
    assert P.without(" a  b\nc d ", [(1, 2)]) == " a  d "
    assert P.without("a b", [(0, 2)]) == "" and P.without("a b", []) == "a b"
    assert P.without("a b c d", [(2, 2), (0, 1)]) == "b "


def test_cuts_do_not_depend_on_what_is_far():
    r = random.Random(3)
    passage = _words(r, 200)
    places = []
    for _ in range(2):
        left = _words(r, 37)
        found = P.Paragraphs.of([" ".join(left + passage).encode()], P.RADIUS, 1)
        places.append({int(x) - 37 for x in found.first if x >= 37 + 10})
    assert places[0] == places[1] and len(places[0]) > 5
