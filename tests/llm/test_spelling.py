"""Spelling variants against a brute-force version over whole texts."""

import zlib
from collections import Counter

import regex

from covaria.llm import spelling
from covaria.llm.spelling import Index
from tests.llm import edge


def _one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = (a, b) if len(a) < len(b) else (b, a)
    return any(long_[:i] + long_[i + 1:] == short for i in range(len(long_)))


def brute(rows, shortest=5, least=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in regex.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            low = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 97 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1:]
            if len(low) >= shortest:
                counts[low] += 1
    vocab = {w: n for w, n in counts.items() if n >= least}
    near = {w: [v for v in vocab if _one_edit(w, v)] for w in vocab}
    out = {}
    for w, n in vocab.items():
        best = min(near[w], key=lambda v: (-vocab[v], v), default=None)
        form = best if best is not None and vocab[best] >= 2 * n else None
        out[w] = [form, None, n, len(near[w]), vocab[form] if form else None]
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w][1] = root
    return sorted((w, *v) for w, v in out.items())


def _texts():
    base = ["colour", "color", "colours", "organise", "organize", "théâtre", "theatre", "Strasse", "straße", "aaaaa",
            "aaaab", "baaaa", "aabaa", "wordy", "words", "worda", "Colour"]
    rows = []
    for k in range(60):
        words = [base[(k * 7 + j * 3) % len(base)] for j in range(k % 9 + 3)]
        rows.append((k, " ".join(words) + "," + "-".join(words[:2])))
    rows += [(None, "colour colour colour"), (61, None), (62, ""), (63, "x" * 5000 + " " + "Colour" * 3), (64, "colour")]
    return rows


def test_matches_brute_force_with_small_blocks(spark):
    rows = _texts()
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (4096, 2):
        found = spelling.grouped(table, block_words=block)
        assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_table_with_odd_rows_and_columns(spark):
    rows = [(i, t) for i, t in edge.TEXTS]
    found = spelling.grouped(edge.table(spark))
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)
    assert spelling.grouped(edge.table(spark).limit(0)).count() == 0


def test_index_finds_every_one_edit_word():
    words = ["abcde", "abcdf", "abxde", "bbcde", "abcd", "abcdex", "xabcde", "abde", "ébcde"]
    for length in (4, 5, 6):
        index = Index([w for w in words if len(w) == length])
        for m in (length - 1, length, length + 1):
            asking = [w for w in words if len(w) == m]
            if not asking:
                continue
            got = sorted(index.near(asking))
            want = sorted((q, w) for q in asking for w in index.words if _one_edit(q, w))
            assert got == want
