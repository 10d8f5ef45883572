import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from covaria.llm import attention, lm
from covaria.llm.queries import op9_lm_scoring, tokenizer_file
from covaria.llm.text import lower_ascii
from covaria.llm.tokens import WordIds
from tests.llm import edge


def _base(texts):
    """Base figures by brute force from (text, trained) pairs."""
    split = [(lower_ascii((t or "").encode()).split() + [b"\n"], trained) for t, trained in texts]
    c = Counter(w for words, trained in split if trained for w in words)
    total, size = sum(c.values()), math.log10(sum(c.values()) + 0.5 * (len(c) + 1))
    return total, [
        (len(words), sum(w in c for w in words), sum(math.log10(c[w] + 0.5) - size for w in words)) for words, _ in split
    ]


def _close(a, b):
    return abs(a - b) <= 1e-6 * max(1, abs(b))


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = {r["doc_id"]: r for r in op9_lm_scoring(spark, sf_dir).collect()}
    trained = [zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1 for r in docs]
    total, base = _base([(r["text"], t) for r, t in zip(docs, trained)])
    assert len(rows) == len(docs)
    held = []
    for d, t, (n, known, score) in zip(docs, trained, base):
        r = rows[d["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (not t, n, known, total)
        assert _close(r["base_score"], score) and r["score"] < 0
        held += [(r["score"], score)] if not t else []
    assert sum(s for s, _ in held) > 1.2 * sum(b for _, b in held)


def test_edge_cases(spark):
    docs = edge.table(spark)
    trains = F.coalesce(F.col("doc_id"), F.lit(0)) != 5
    found = lm.scored(docs, trains, tokenizer_file(), head_words=20).collect()
    texts = [(t, i != 5) for i, t in edge.TEXTS]
    total, base = _base(texts)
    wanted = Counter((i, n, known, total) for (i, _), (n, known, _) in zip(edge.TEXTS, base))
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in found) == wanted
    assert _close(sum(r["base_score"] for r in found), sum(b for _, _, b in base))
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in found)
    assert lm.scored(docs.limit(0), trains, tokenizer_file()).count() == 0
    none = lm.scored(docs, F.lit(False), tokenizer_file()).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in none} == {(0, 0)}


def _small_model(seed=0, vocabulary=12, classes=6):
    rng = np.random.default_rng(seed)
    counts = np.concatenate([rng.integers(1, 50, 20), np.zeros(4)]).astype(float)
    number = attention.numbered(counts, vocabulary)
    pairs = [(a, b, int(rng.integers(1, 9))) for a in range(vocabulary + 1) for b in range(vocabulary)]
    pairs += [(a, -1, 3) for a in range(vocabulary)]
    model = attention.Model(attention.statistics(counts, pairs, 24, number), classes=classes)
    model.weights["out"] = rng.normal(size=model.weights["out"].shape).astype(np.float32)
    model.weights["distance"] = rng.normal(size=attention.WINDOW).astype(np.float32)
    return model, rng


def test_probabilities_add_up_to_one():
    model, rng = _small_model()
    for n in (0, 1, 5, 40):
        before = rng.integers(0, 24, n)
        logs = []
        for last in range(24):
            with_last = model.score([np.append(before, last)])[0]
            logs.append(with_last - (model.score([before])[0] if n else 0.0))
        assert abs(sum(10**x for x in logs) - 1) < 1e-4


def test_no_id_sees_what_follows_and_each_is_scored_once():
    model, rng = _small_model(1)
    text = rng.integers(0, 24, 100)
    scores = [model.score([text[:k]])[0] for k in range(1, 101)]
    steps = np.diff([0.0, *scores])
    other = text.copy()
    other[60:] = rng.integers(0, 24, 40)
    changed = np.diff([0.0, *[model.score([other[:k]])[0] for k in range(1, 61)]])
    assert np.allclose(steps[:60], changed, atol=1e-5)
    together = model.score([text[:7], text, other[:33], text[:1]])
    assert np.allclose(together, [scores[6], scores[99], model.score([other[:33]])[0], scores[0]], atol=1e-4)


def test_gradients_are_those_of_the_loss():
    model, rng = _small_model(2)
    windows, following, _ = attention.cut([model.number[rng.integers(0, 24, 50)] for _ in range(3)], model.start, model.pad)
    for name in model.weights:
        model.weights[name] = model.weights[name].astype(np.float64)
    model.prior = model.prior.astype(np.float64)
    loss, grads = model.gradients(windows, following)
    for name, g in grads.items():
        flat = model.weights[name].reshape(-1)
        for k in rng.choice(np.flatnonzero(np.abs(g.reshape(-1)) > 1e-4), 3):
            keep = flat[k]
            flat[k] = keep + 1e-4
            up = model.gradients(windows, following)[0]
            flat[k] = keep - 1e-4
            down = model.gradients(windows, following)[0]
            flat[k] = keep
            assert (up - down) / 2e-4 == pytest.approx(g.reshape(-1)[k], rel=0.05, abs=2e-4), name


def test_pair_counts_against_brute_force(spark):
    words = {b"the": 5, b"then,": 3, "été".encode(): 2, b"a": 7, b"\n": 4, "​".encode(): 1}
    counts = spark.createDataFrame(list(words.items()), "word binary, c long")
    found = Counter()
    for r in lm.paired(counts, tokenizer_file()).collect():
        found[r["a"], r["b"]] += r["n"]
    wanted, encoder = Counter(), WordIds(tokenizer_file())
    for w, n in words.items():
        if w == b"\n":
            wanted[lm.IDS, lm.END] += n
            continue
        ids = encoder.text(w).tolist()
        for a, b in zip([lm.IDS, *ids], [*ids, lm.WORD_END]):
            if ids:
                wanted[a, b] += n
    assert found == wanted


def _rare_pairs(spark):
    """Texts of rare words, each of several ids, and one training text longer than 100,000 bytes."""
    rng = np.random.default_rng(4)
    stems = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(60)]
    texts = [" ".join(rng.choice(stems, 40)) for _ in range(40)] + ["lone zyxwvut " * 10_000]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_training_reads_every_window_of_every_document(spark):
    docs = _rare_pairs(spark)
    encoder, wanted = WordIds(tokenizer_file()), Counter()
    for r in docs.collect():
        ids = np.append(encoder.text(r["text"].encode()), lm.END).astype(np.int64)
        some, after, _ = attention.cut([ids], lm.IDS, lm.IDS + 1)
        used = (np.arange(after.size) < len(ids)).reshape(after.shape)
        wanted.update(np.concatenate([some, np.where(used, after, lm.NOTHING)], axis=1).astype(np.uint16)[k].tobytes() for k in range(len(some)))
    found, width = Counter(), 2 * (attention.WINDOW + attention.STRIDE)
    for r in lm.windows(docs, tokenizer_file()).collect():
        for k in range(lm.ROUNDS):
            found.update(r[f"w{k}"][i : i + width] for i in range(0, len(r[f"w{k}"]), width))
    assert found == wanted


def test_training_lowers_the_loss_and_pairs_of_all_ids_count(spark):
    docs = _rare_pairs(spark)
    score = lambda **given: {
        r["doc_id"]: r["score"] for r in lm.scored(docs, F.lit(True), tokenizer_file(), vocabulary=8, **given).collect()
    }
    near, far = score(head_pairs=1 << 20, steps=1), score(head_pairs=0, steps=1)
    # Counts sent to the tasks and counts joined by a shuffle give the same.
    assert all(abs(near[k] - far[k]) < 0.02 * abs(near[k]) for k in near)
    # Ids outside the vocabulary follow their predecessors: inside a known word little is open.
    encoder = WordIds(tokenizer_file())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    words = {k: len(t.split()) for k, t in texts.items()}
    pieces = {k: len(encoder.text(t.encode())) for k, t in texts.items()}
    assert sum(pieces[k] for k in range(40)) > 2 * sum(words[k] for k in range(40))
    assert all(near[k] > -4.5 * words[k] for k in range(40)), [near[k] / words[k] for k in range(40)]


def test_probabilities_with_pairs_by_id_add_up_to_one():
    model, rng = _small_model(3)
    by_class = rng.integers(0, 9, (25, 6)).astype(float)
    codes, times, left = [], [], by_class[:, 5].copy()
    last = np.flatnonzero(model.number >= model.rest)
    for a in range(25):
        codes.append(a << 32 | int(last[a % len(last)]))
        times.append(int(left[a]))
    held = attention.Pairs.of(
        rng.integers(0, 9, 24).astype(float), rng.integers(0, 9, 24).astype(float), np.append(rng.integers(0, 3, 24), 0).astype(float),
        by_class, model.number, model.rest, np.array(codes), np.array(times), True,
    )
    model.pairs = held
    for n in (0, 1, 5, 40):
        before = rng.integers(0, 24, n)
        base = model.score_by_id(before, np.array([n]))[0][0] if n else 0.0
        total = sum(10 ** (model.score_by_id(np.append(before, x), np.array([n + 1]))[0][0] - base) for x in range(24))
        assert abs(total - 1) < 1e-4


def test_sums_by_number():
    rng = np.random.default_rng(6)
    for kind in (np.float32, np.float64):
        at, d = rng.integers(0, 9, 200), rng.normal(size=(200, 32)).astype(kind)
        wanted = np.zeros((12, 32))
        np.add.at(wanted, at, d)
        found = attention._summed_by(at, d, 12)
        assert found.dtype == kind and np.allclose(found, wanted, atol=1e-4)


def test_texts_are_read_once_and_scored_from_their_stored_windows(spark, monkeypatch):
    monkeypatch.setattr(lm, "PIECE", 500)  # windows of the long text lie in several rows
    docs = _rare_pairs(spark).withColumn("trained", F.col("doc_id") % 3 != 0).cache()
    counts = lm.counted(docs).groupBy("word").agg(F.sum("n").alias("c")).cache()
    pairs = lm.paired(counts, tokenizer_file()).groupBy("a", "b").agg(F.sum("n").alias("n")).cache()
    table = lm.stored(lm.read(docs, tokenizer_file(), {}, ["doc_id"]))
    found, cuts = table.where("row IS NOT NULL"), table.where("row IS NULL")
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(r["doc_id"] for r in docs.collect())
    windows = {r["trained"]: r["n"] for r in cuts.groupBy("trained").agg(F.sum("n").alias("n")).collect()}
    encoder, wanted, ids = WordIds(tokenizer_file()), Counter(), {}
    for r in docs.collect():
        ids[r["doc_id"]] = np.append(encoder.text(r["text"].encode()), lm.END).astype(np.int64)
        wanted[r["trained"]] += -(-len(ids[r["doc_id"]]) // attention.STRIDE)
    assert windows == wanted and cuts.where("n > 0").count() > len(ids) / 40 + 2
    model = lm.fitted(cuts.where("trained"), pairs, 8, 1, 1 << 20)
    scores = lm._scores(cuts, model).groupBy("row").agg(F.sum("score").alias("score"))
    rows = found.select("doc_id", "row").join(scores, "row").collect()
    assert len(rows) == len(ids)
    for r in rows:
        text = ids[r["doc_id"]]
        assert r["score"] == pytest.approx(model.score_by_id(text, np.array([len(text)]))[0][0], rel=1e-5)
