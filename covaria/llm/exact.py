r"""Exact dedup by composable polynomial fingerprints.

The normalised text (UTF-8, the six white-space bytes deleted) is cut into chunks of
``CHUNK`` bytes. A chunk's hash is its bytes read as a polynomial at a fixed point modulo
each of four primes below 2^31; all chunks of a batch are hashed by one matrix product,
exact in doubles because 4096 * 255 * 2^31 < 2^53. Hashes combine by

    H(A B) = H(A) * r^len(B) + H(B),

so that chunks, or parts of a document held by different tasks, can be hashed apart and put
together in any grouping (``combine``). Fingerprint and length name a candidate group.

Documents with equal fingerprints are then compared byte by byte: their texts are streamed
as chunk rows, and the smallest and largest chunk at each place of a group must be the same.
The aggregate combines inside each task before the shuffle, so a group that holds a third of
all rows sends one chunk per task and place. A group that fails is split by the texts'
SHA-256, which the result carries anyway.

Defined results: a null text counts as empty; empty texts are equal to each other. The row
with most code points stays, then the smallest id, a null id last. Rows with one id are
separate documents; of rows with one id and equally many code points the one with the
smallest text hash stays. Where that row has twins (same id, same original text), all of
them show ``kept`` true in the digest and ``deduplicated`` returns one of them. Other
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covaria.llm.keep import one_of_each, text_hash, winners
from covaria.llm.text import SPACE_BYTES, raw_texts, shuffled, slices, small_enough
from covaria.operators.durable import stored

CHUNK = 4096
#: Bytes of a text that one comparison row holds.
COMPARED = 1 << 16
# The four largest primes below 2^31, and a point for each.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
POINTS = (1103515245, 1664525, 69069, 1812433253)


def chunk_hashes(data: bytes, starts, ends, primes=PRIMES, points=POINTS):
    """Hash of each ``data[start:end]`` of at most ``CHUNK`` bytes: int64, chunks by primes."""
    import numpy as np

    powers = np.empty((CHUNK, len(primes)))
    for k, (p, r) in enumerate(zip(primes, points)):
        value = 1
        for i in range(CHUNK):
            powers[CHUNK - 1 - i, k] = value
            value = value * r % p
    flat = np.frombuffer(data, np.uint8)
    out = np.zeros((len(starts), len(primes)), np.int64)
    whole = np.flatnonzero(ends - starts == CHUNK)
    for at in range(0, len(whole), 256):  # full chunks by one product, 8 MB of doubles at a time
        some = whole[at : at + 256]
        block = flat[starts[some][:, None] + np.arange(CHUNK)].astype(np.float64)
        out[some] = (block @ powers).astype(np.int64)
    rest = np.flatnonzero(ends - starts < CHUNK)
    for at in range(0, len(rest), 256):  # last chunks stand at the end of a zero block
        some = rest[at : at + 256]
        block = np.zeros((len(some), CHUNK))
        for row, k in zip(block, some):
            if ends[k] > starts[k]:
                row[CHUNK - (ends[k] - starts[k]) :] = flat[starts[k] : ends[k]]
        out[some] = (block @ powers).astype(np.int64)
    return out % np.array(primes, np.int64)


def combine(left, right, right_length, primes=PRIMES, points=POINTS) -> tuple[int, ...]:
    """Hash of two pieces of text in a row from the hash of each and the right one's length."""
    return tuple(
        (int(a) * pow(r, right_length, p) + int(b)) % p for a, b, p, r in zip(left, right, primes, points)
    )


def fingerprints_of(texts: list[bytes], primes=PRIMES, points=POINTS) -> list[tuple[int, ...]]:
    """Fingerprint of each text, from the hashes of its chunks."""
    import numpy as np

    lengths = np.array([len(t) for t in texts], np.int64)
    pieces = np.maximum((lengths + CHUNK - 1) // CHUNK, 1)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    owner = np.repeat(np.arange(len(texts)), pieces)
    first = np.cumsum(pieces) - pieces
    starts = offsets[owner] + (np.arange(len(owner)) - first[owner]) * CHUNK
    ends = np.minimum(starts + CHUNK, offsets[owner + 1])
    hashes = chunk_hashes(b"".join(texts), starts, ends, primes, points)
    found = []
    for k in range(len(texts)):
        value = tuple(hashes[first[k]])
        for j in range(first[k] + 1, first[k] + pieces[k]):
            value = combine(value, hashes[j], int(ends[j] - starts[j]), primes, points)
        found.append(tuple(int(v) for v in value))
    return found


def _reader(primes, points, with_chunks: bool):
    """Arrow function: a row with the fingerprint per document, or one per chunk of its text."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            originals = raw_texts(batch.column("text"))
            for begin, end in slices(originals):
                texts = [t.translate(None, SPACE_BYTES) for t in originals[begin:end]]
                prints = fingerprints_of(texts, primes, points)
                fp = [f"{len(t):x}." + ".".join(f"{v:x}" for v in p) for t, p in zip(texts, prints)]
                if with_chunks:
                    yield pa.RecordBatch.from_pydict({
                        "fp": pa.array(fp, pa.string()), "normal": pa.array(texts, pa.binary()),
                    })
                    continue
                codes = [
                    len(t) - int(np.count_nonzero((np.frombuffer(t, np.uint8) & 0xC0) == 0x80))
                    for t in originals[begin:end]
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(begin, end - begin),
                        batch.column("h").slice(begin, end - begin),
                        pa.array(fp, pa.string()),
                        pa.array(codes, pa.int64()),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                    ],
                    names=["doc_id", "h", "fp", "n_codes", "text_sha256"],
                )

    return run


def _differing(docs: DataFrame, groups: DataFrame, primes, points) -> DataFrame:
    """Fingerprints shared by texts that differ, found chunk by chunk."""
    shared = groups.where("group_size > 1").select("fp")
    texts = docs.select("text").mapInArrow(_reader(primes, points, True), "fp string, normal binary")
    texts = texts.join(small_enough(shared, 128), "fp", "left_semi")
    n = F.greatest(F.ceil(F.length("normal") / COMPARED), F.lit(1)).cast("int")
    chunks = texts.select("fp", "normal", F.explode(F.sequence(F.lit(0), n - 1)).alias("place")).select(
        "fp", "place", F.expr(f"substring(normal, place * {COMPARED} + 1, {COMPARED})").alias("chunk")
    )
    ends = chunks.groupBy("fp", "place").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b"))
    return ends.where("a <> b").select("fp").distinct()


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", primes=PRIMES, points=POINTS) -> DataFrame:
    """One row per document: doc_id, h, keep_id, group_size, kept, text_sha256, n_twins.

    ``h`` is the hash of the original text and ``n_twins`` the number of rows that share the
    kept row's id and text.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), text_hash(F.col(text_col)).alias("h"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = stored(
        docs.mapInArrow(
            _reader(primes, points, False),
            f"doc_id {kind}, h bigint, fp string, n_codes bigint, text_sha256 string",
        )
    )
    sizes = stored(rows.groupBy("fp").agg(F.count("*").alias("group_size")))
    differing = stored(_differing(docs, sizes, primes, points))
    key = F.lit("").alias("split")
    if not differing.isEmpty():
        key = F.when(F.col("unlike").isNotNull(), F.col("text_sha256")).otherwise("").alias("split")
        rows = rows.join(small_enough(differing, 128).withColumn("unlike", F.lit(True)), "fp", "left")
    rows = rows.select("doc_id", "h", "fp", "n_codes", "text_sha256", key)
    groups = stored(winners(rows, ["fp", "split"], [(-F.col("n_codes")).alias("minus_codes")]))
    return rows.join(shuffled(groups), ["fp", "split"]).select(
        "doc_id",
        "h",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (
            (F.col("n_codes") == -F.col("best.minus_codes"))
            & F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
            & (F.col("h") == F.col("best.h"))
        ).alias("kept"),
        "text_sha256",
        "n_twins",
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    return one_of_each(docs, grouped(docs, id_col, text_col), id_col, text_col)
