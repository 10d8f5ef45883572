"""Every stage of the corpus pipeline against a brute-force version of it."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from covaria.llm import language, mixing, simhash, text
from covaria.llm.queries import language_model, tokenizer_file
from tests.llm import edge
from tests.llm.test_packing import _check
from tests.llm.test_simhash import _components, _fingerprint


@pytest.fixture(scope="module")
def results(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs, found = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        found.append((name, docs, after))
        docs = after
    return found


def _texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(results):
    assert [name for name, *_ in results] == ["language", "exact", "near", "mix", "pack"]
    for _, before, after in results[:-1]:
        assert after.dtypes == before.dtypes
        assert after.select("doc_id", "text", "lang", "source").distinct().exceptAll(
            before.select("doc_id", "text", "lang", "source").distinct()
        ).isEmpty()


def test_language_stage(results):
    _, before, after = results[0]
    verdicts = {r["doc_id"]: r["rejected"] for r in language.predicted(before, language_model(before)).collect()}
    assert {i for i, _ in _texts(after)} == {i for i, gone in verdicts.items() if not gone}
    assert after.count() >= 0.98 * before.count()


def test_exact_stage(results):
    _, before, after = results[1]
    best = {}
    for i, t in _texts(before):
        body = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[body] = min(best.get(body, (0, 1 << 60)), (-len(t), i))
    assert sorted(i for i, _ in _texts(after)) == sorted(i for _, i in best.values())


def test_near_stage(results):
    _, before, after = results[2]
    prints = {i: _fingerprint(t) for i, t in _texts(before)}
    parts, best = _components(list(prints.values()), 3), {}
    for i, f in prints.items():
        best[parts[f]] = min(i, best.get(parts[f], i))
    assert sorted(i for i, _ in _texts(after)) == sorted(best.values())


def test_mix_stage(results):
    _, before, after = results[3]
    wanted = {r["doc_id"]: r["repeats"] for r in mixing.mixed(before, mixing.cycled(1, 2, 3)).collect()}
    times = {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert times == {i: n for i, n in wanted.items() if n}


def test_pack_stage(results):
    _, before, after = results[4]
    texts = dict(_texts(before))
    copies = {r["doc_id"]: r["count"] for r in before.groupBy("doc_id").count().collect()}
    rows = after.collect()
    assert sum(r["piece"] == 0 for r in rows) == before.count()
    once = {i: t for i, t in texts.items() if copies[i] == 1}
    sequences, tokens = _check(rows, once)
    assert sequences <= 1.02 * tokens / 4096 + 1
    assert tokenizer_file().endswith("word_bpe_49k.json")


def test_run_and_registration(spark, sf_dir, results):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in __spark_entry__.queries() if re.match(r"op\d+_", q)}
    assert corpus_pipeline.run(spark, sf_dir).count() == results[-1][2].count()


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_on_edge_cases(spark, stage):
    docs = edge.table(spark)
    out = stage(spark, docs, "")
    out.collect()
    if stage is not corpus_pipeline.pack:
        assert out.columns == docs.columns
    assert stage(spark, docs.limit(0), "").count() == 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_dotted_and_clashing_columns(spark, stage):
    docs = edge.table(spark).withColumns({"a.b": F.lit("dot"), "__id": F.lit("mine"), "__h": F.lit("mine too")})
    out = stage(spark, docs, "")
    assert out.columns == docs.columns
    assert all(r["a.b"] == "dot" and r["__id"] == "mine" and r["__h"] == "mine too" for r in out.collect())


def test_near_copies_of_the_whole_table_are_one_group(spark):
    docs = spark.createDataFrame([(i, "w " * 500 + "x") for i in range(50)], "doc_id long, text string")
    assert [r["doc_id"] for r in simhash.deduplicated(docs).collect()] == [0]


@pytest.mark.parametrize("length, way", [(10, "BroadcastHashJoin"), (2_000, "SortMergeJoin")])
def test_long_texts_count_before_a_broadcast(spark, monkeypatch, length, way):
    monkeypatch.setattr(text, "BROADCAST_BYTES", 10_000)
    rows = [(i, str(i) * length) for i in range(10)]
    docs = spark.createDataFrame(rows, "k long, t string")
    keys = spark.createDataFrame(rows, "k long, `a.b` string")
    joined = docs.join(text.small_enough(keys, 16), "k")
    assert way in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 10
