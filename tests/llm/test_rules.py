"""License scans and quality rules against plain Python."""

import random
import re

from covaria.llm import licenses, quality
from tests.llm import edge


def _bigrams(text):
    words = re.findall(licenses.WORD, text.lower())
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def _best(text):
    """Best Dice of any line or block of lines, and the names that reach the threshold."""
    text = text or ""
    blocks = [b for b in re.split(r"\n[\x20\x09\x0B-\x0D]*(?:\n|$)", text) if "\n" in b]
    names, n, top = set(), 0, 0.0
    for part in text.split("\n") + blocks:
        a, best = _bigrams(part), (0.0, 0, "")
        for k, (name, template) in enumerate(licenses.TEMPLATES):
            b = _bigrams(template)
            if a:
                best = max(best, (2 * len(a & b) / (len(a) + len(b)), -k, name))
        if best[0] >= licenses.THRESHOLD:
            names.add(best[2])
            n += 1
            top = max(top, best[0])
    return ",".join(sorted(names)), n, top


def test_licenses_against_brute_force(spark):
    r = random.Random(4)
    rows = [(i, t) for i, t in edge.TEXTS]
    for k, (_, text) in enumerate(licenses.TEMPLATES):
        words = text.split()
        broken = " ".join(w for w in words if r.random() > 0.05)
        wrapped = "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
        rows += [(100 + k, text), (200 + k, f"prose\n{broken}\nprose"), (300 + k, f"prose here\n\n{wrapped}\n \nmore"), (400 + k, wrapped)]
    rows.append((500, "Licensed under the sea"))
    found = licenses.scanned(edge.table(spark, rows))
    got = sorted(((r["doc_id"], r["licences"], r["n_matches"], round(r["dice"], 9)) for r in found.collect()), key=str)
    assert got == sorted(((i, *_best(t)[:2], round(_best(t)[2], 9)) for i, t in rows), key=str)
    assert sum(1 for i, name, *_ in got if i and 100 <= i < 200 and name) == len(licenses.TEMPLATES)
    assert licenses.scanned(edge.table(spark, []).limit(0)).count() == 0


def test_size_bounds_lose_nothing():
    for n in range(1, 200):
        low, high = licenses.size_range(n, 0.8)
        for a in range(1, 400):
            if 2 * min(a, n) / (a + n) >= 0.8:
                assert low - 1e-9 <= a <= high + 1e-9


def _measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


def test_quality_against_brute_force(spark):
    r = random.Random(9)
    rows = list(edge.TEXTS)
    for k in range(60):
        words = [r.choice(["the", "of", "é#x", "a|b", "w", "\n", "\n\n"]) for _ in range(r.randrange(0, 90))]
        rows.append((100 + k, " ".join(words * r.choice([1, 1, 2]))))
    rows.append((900, " ".join(f"w{i % 13}" for i in range(30_000))))
    found = quality.judged(edge.table(spark, rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(((r["doc_id"], *[r[n] for n in names]) for r in found), key=str) == sorted(
        ((i, *_measures(t)) for i, t in rows), key=str
    )
    for x in found:
        failed = x["n_words"] < 20 or 100 * x["n_repeat_words"] > 30 * x["n_words"]
        assert x["base_failed"] == failed and not (failed and x["kept"])
    assert quality.judged(edge.table(spark, []).limit(0)).count() == 0


def test_rules_are_one_expression(spark):
    plan = quality.judged(edge.table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    rules = (quality.Rule("n_words", 2, 2),)
    kept = quality.measures(edge.table(spark)).where(quality.verdict(rules))
    assert {r["doc_id"] for r in kept.collect()} == {4, 5, 8}
