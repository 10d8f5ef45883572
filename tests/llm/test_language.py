import zlib

import pytest

from covaria.llm import language
from covaria.llm.queries import language_model, op6_language_id
from tests.llm import edge


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").cache()


def test_held_out_accuracy(spark, docs):
    rows = op6_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    right = sum(r["lang_pred"] == truth[r["doc_id"]] for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) <= 0.02 * len(rows)


def test_edge_cases(spark, docs):
    model = language_model(docs)
    rows = [(1, None), (2, ""), (3, "123 !! 456"), (4, "the"), (5, "é"), (6, "der die das " * 60_000), (6, "x"), (None, "la")]
    table = edge.table(spark, rows)
    found = [(r["doc_id"], r["lang_pred"], r["rejected"]) for r in language.predicted(table, model).collect()]
    assert len(found) == len(rows)
    for i, name, rejected in found:
        assert (name == "und") == (i in (1, 2, 3)) and (rejected or i not in (1, 2, 3))
    kept = language.recognised(table, model)
    assert kept.columns == table.columns and {1, 2, 3}.isdisjoint({r["doc_id"] for r in kept.collect()})
    assert language.predicted(table.limit(0), model).count() == 0
    assert {r["lang_pred"] for r in language.predicted(table, None).collect()} == {"und"}


def test_one_language_or_none(spark):
    one = spark.createDataFrame([(i, "some words here", "xx") for i in range(20)], "doc_id long, text string, lang string")
    model = language_model(one)
    assert {r["lang_pred"] for r in language.predicted(one, model).collect()} == {"xx"}
    assert language_model(one.where("lang IS NULL")) is None


def test_a_prediction_depends_on_its_text_alone(docs):
    texts = [r["text"].encode() for r in docs.select("text").limit(40).collect()]
    model = language.fit(texts, ["a", "b"] * 20, epochs=2)
    columns = list(model.embeddings.T.copy())
    together = language.averages(texts, columns)
    for k in (0, 7, 39):
        assert abs(language.averages([texts[k]], columns)[0] - together[k]).max() < 1e-9


def test_blocks_do_not_change_averages(monkeypatch):
    texts = [b"a b c d e f" * 50, b"", b"xyz" * 100]
    columns = [language.fit([b"abc", b"xyz"] * 5, ["a", "b"] * 5, epochs=1).embeddings[:, 0].copy()]
    whole = language.averages(texts, columns)
    monkeypatch.setattr(language, "BLOCK", 37)
    assert abs(language.averages(texts, columns) - whole).max() < 1e-9
