import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from covaria.llm import packing
from covaria.llm.queries import op3_best_fit_packing, tokenizer_file
from covaria.llm.tokens import WordIds, encoded
from tests.llm import edge

ODD = [
    "", "  ", "a b c", "İstanbul ǅ ﬁ é é ΑΣ ας", "<|endoftext|>x <|startoftext|> <|ENDOFTEXT|>", "it's we'll I'D 12 3a",
    "\x1c\x1d a\x0bb", "x" * 5000, " ́a", "a. b, c; d: e! f? .. ,, é, 1. a1. A. ...", " x y z", "日本語 한국어 ñ",
    "tab\tnew\nline\r\nend", "don't. o'clock,", "ﬀ ﬁ Å K ſ", "퟿", "a​b", "naïve, café; ÉTÉ.",
]


@pytest.mark.parametrize("remembered", [3, 1_000_000])
def test_word_ids_equal_the_tokenizer(spark, sf_dir, remembered):
    whole = Tokenizer.from_file(tokenizer_file())
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    words = WordIds(tokenizer_file(), remembered)
    raws = [packing._lowered(t.encode()) for t in texts]
    got = dict(encoded(raws, words))
    for k, e in enumerate(whole.encode_batch(texts, add_special_tokens=False)):
        assert got[k].tolist() == e.ids, texts[k][:80]
    for raw, text in zip(raws[: len(ODD)], ODD):
        assert words.text(raw).tolist() == whole.encode(text, add_special_tokens=False).ids


def _check(rows, texts, most=4096):
    """Pieces restore every document; places leave no gap."""
    whole = Tokenizer.from_file(tokenizer_file())
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text in texts.items():
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r["piece"])):
            own = ids[at : at + most]
            assert (r["piece"], r["start"], r["length"], r["ids_crc32"]) == (k, at, len(own), zlib.crc32(own.tobytes()))
            at += len(own)
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= most
    return len(by_sequence), sum(r["length"] for r in rows)


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sequences, tokens = _check(op3_best_fit_packing(spark, sf_dir).collect(), texts)
    assert sequences <= 1.02 * tokens / 4096 + 1


def test_edge_cases(spark):
    docs = edge.table(spark)
    rows = packing.packed(docs, tokenizer_file()).collect()
    unique = {i: t for i, t in edge.TEXTS if [j for j, _ in edge.TEXTS].count(i) == 1}
    _check([r for r in rows], {i: t for i, t in unique.items()})
    assert sum(r["piece"] == 0 for r in rows) == len(edge.TEXTS)
    assert packing.packed(docs.limit(0), tokenizer_file()).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, "a few words " * (i * 7 % 50)) for i in range(60)], "doc_id long, text string")
    rows = packing.packed(docs, tokenizer_file(), most_tokens=64, with_ids=True)
    rows = rows.cache()
    whole = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in packing.sequences(rows).collect()}
    for r in rows.collect():
        part = whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
    assert sum(map(len, whole.values())) == sum(r["length"] for r in rows.collect())
    rows.unpersist()


@pytest.mark.parametrize("choose", ["norm", "dot"])
@pytest.mark.parametrize("caps", [(100, 100, 1e4), (100, 4, 1e4), (100, 100, 5000.0), (100, 3, 4000.0)])
def test_every_capacity_holds(choose, caps):
    lengths = np.random.default_rng(7).integers(1, 60, 500)
    number, offset = packing.best_fit(lengths, caps, (1.0, 0.5, 0.5), choose)
    for n in range(number.max() + 1):
        own = lengths[number == n]
        assert own.sum() <= caps[0] and len(own) <= caps[1] and (own.astype(float) ** 2).sum() <= caps[2]
        order = np.argsort(offset[number == n])
        assert (np.cumsum(own[order]) - own[order] == offset[number == n][order]).all()
    bound = max(lengths.sum() / caps[0], len(lengths) / caps[1], (lengths.astype(float) ** 2).sum() / caps[2])
    assert number.max() + 1 <= 1.15 * bound + 1


def test_a_piece_too_large_is_refused():
    with pytest.raises(ValueError):
        packing.best_fit([10], (5, 5, 100.0))
