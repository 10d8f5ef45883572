"""Character counts of texts: right across pieces, and in memory that does not follow the batch."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from covaria.plans import bindings as B


def counts_of(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    (found,) = B._character_counts([batch])
    return found


def plainly(text):
    return [len(text), *[sum(c in some for c in text) for some in (" ", B.DIGITS, B.CAPITALS, B.MARKS)]]


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64, 1 << 18])
def test_counts_do_not_depend_on_pieces(monkeypatch, piece):
    monkeypatch.setattr(B, "COUNTED_BYTES", piece)
    texts = ["", "Ab 1, é!", "", "漢字 \U0001f600 X9?", "a" * 70 + " Ü. " * 9, "", "0123 ABC", ""]
    found = counts_of(texts)
    assert [list(row) for row in zip(*[c.to_pylist() for c in found.columns[1:]])] == [plainly(t) for t in texts]


def test_sliced_and_empty_batches():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3], pa.int64()), pa.array(["skip ME", "é 1", "B."])], names=["doc_id", "text"])
    (found,) = B._character_counts([batch.slice(1)])
    assert [list(r) for r in zip(*[c.to_pylist() for c in found.columns])] == [[2, 3, 1, 1, 0, 0], [3, 2, 0, 0, 1, 1]]
    (none,) = B._character_counts([batch.slice(3)])
    assert none.num_rows == 0 and none.schema.names == ["doc_id", *B.TEXT_FEATURES]


@pytest.mark.parametrize("texts", [["word 1. " * 4_000] * 500, ["word 1. " * 2_000_000]])
def test_memory_does_not_follow_the_batch(texts):
    """16 MB of text, as many short texts or as one: far less than one number a byte is held."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    tracemalloc.start()
    (found,) = B._character_counts([batch])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.sum(found.column("n_digits").to_numpy()) == 2_000_000
    assert peak < 16_000_000
