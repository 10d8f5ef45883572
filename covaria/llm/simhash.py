"""SimHash near-dedup by covering anchors.

A document's fingerprint is the bitwise majority of its shingles' XXH64 values. Documents
whose fingerprints differ in at most ``max_bits`` bits are linked, and linked documents form
components.

Candidates. The 64 bits are cut into ``max_bits // 2 + 1`` parts, so two linked fingerprints
differ by at most one bit in some part. Of each part the first 2^r - 1 bits are covered by a
perfect Hamming code: every value lies within one bit of exactly one code word. The code
words are the anchors. A fingerprint goes home to its nearest anchor and is replicated to
every anchor within covering radius plus threshold (1 + 1 bits: 1 or 2^(r-1) anchors, 16 for
31 bits). If x and y differ by one bit in the part, y is within two bits of x's home, so the
pair meets there; homes are compared with replicas anchor by anchor. Work per distinct
fingerprint is constant, and the code words are so many (2^26 for 31 bits) that unrelated
fingerprints rarely share one.

Only distinct fingerprints are compared, so exact copies cost nothing more. Links are thinned
to a forest in the task that finds them. Components are joined back to documents by
fingerprint; a very common one is split by the skew join.

Defined results: fewer words than the shingle length form one shingle; no word (also null
text) gives fingerprint zero, linked like any other. A component is named by its smallest
id, null if all ids are null. Repeated rows get equal results. Other columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import repeat

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covaria.llm.components import components, thinned
from covaria.llm.keep import one_of_each, text_hash, winners
from covaria.llm.text import lower_ascii, raw_texts, shuffled
from covaria.operators.durable import stored

SEED = 42
#: Shingles whose votes are added up at a time.
BLOCK = 1 << 16


def shingle_hashes(raw: bytes, words_each: int, seed: int = SEED):
    """XXH64 of every shingle of a text, repeats included, as uint64."""
    import numpy as np
    import xxhash

    words = lower_ascii(raw).split()
    joined = b" ".join(words)
    if len(words) <= words_each:
        return np.array([xxhash.xxh64_intdigest(joined, seed)] if words else [], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    pieces = map(slice, (ends - lengths)[: 1 - words_each].tolist(), ends[words_each - 1 :].tolist())
    hashes = map(xxhash.xxh64_intdigest, map(joined.__getitem__, pieces), repeat(seed))
    return np.fromiter(hashes, np.uint64, len(words) - words_each + 1)


def majority(hashes) -> int:
    """The number whose bits are set in over half the hashes, as a signed long."""
    import numpy as np

    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        rows = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, words_each: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, h (hash of the text) and fp (signed long) of every document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [majority(shingle_hashes(raw, words_each)) for raw in raw_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(found, pa.int64())], names=["doc_id", "h", "fp"]
            )

    columns = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), text_hash(F.col(text_col)).alias("h")
    )
    return columns.mapInArrow(run, f"doc_id {kind}, h bigint, fp bigint")


def parts_of(max_bits: int) -> tuple[int, int, int]:
    """Number of parts, bits of each, and r of the Hamming code of 2^r - 1 bits inside."""
    parts = max_bits // 2 + 1
    width = 64 // parts
    return parts, width, (width + 1).bit_length() - 1


def anchors(values, r: int):
    """For values of 2^r - 1 bits: home anchor, and all anchors within two bits (padded by home)."""
    import numpy as np

    n = (1 << r) - 1
    values = values.astype(np.uint64)
    syndrome = np.zeros(len(values), np.uint64)
    for place in range(1, n + 1):
        syndrome ^= ((values >> np.uint64(place - 1)) & np.uint64(1)) * np.uint64(place)
    one = np.uint64(1)
    # The bit of place k is 1 << (k - 1); place 0 stands for no bit.
    flip = lambda places: np.where(places > 0, one << (np.maximum(places, one) - one), np.uint64(0))
    home = values ^ flip(syndrome)
    near = [home]
    for place in range(1, n + 1):
        other = syndrome ^ np.uint64(place)
        # Two flips i < j with i xor j = syndrome lead to another code word.
        use = (syndrome > 0) & (other > place)
        near.append(np.where(use, values ^ flip(np.full_like(values, place)) ^ flip(other), home))
    return home, np.stack(near, axis=1)


def _replicated(fps: DataFrame, max_bits: int) -> DataFrame:
    """Rows (part, anchor, fp, home) of every fingerprint."""
    parts, width, r = parts_of(max_bits)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            signed = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            bits = signed.view(np.uint64)
            for at in range(0, len(bits), 20_000):
                some, ids = bits[at : at + 20_000], signed[at : at + 20_000]
                for part in range(parts):
                    mask = np.uint64((1 << ((1 << r) - 1)) - 1)
                    home, near = anchors((some >> np.uint64(part * width)) & mask, r)
                    fresh = near != home[:, None]
                    fresh[:, 0] = True
                    row, column = np.nonzero(fresh)
                    yield pa.RecordBatch.from_pydict({
                        "anchor": pa.array((near[row, column] * np.uint64(parts) + np.uint64(part)).view(np.int64)),
                        "fp": pa.array(ids[row]),
                        "home": pa.array(column == 0),
                    })

    return fps.mapInArrow(run, "anchor bigint, fp bigint, home boolean")


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (a, b), enough to connect all of ``fps`` within ``max_bits`` bits of each other."""
    copies = _replicated(fps, max_bits)
    home = copies.where("home").select("anchor", F.col("fp").alias("a"))
    near = copies.select("anchor", F.col("fp").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    # Spark would size the copies by the few bytes of a fingerprint, and broadcast them.
    return thinned(shuffled(home).join(near, (home.anchor == near.anchor) & (F.col("a") != F.col("b")) & close))


def grouped(
    docs: DataFrame, words_each: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, h, fp, component_id, kept, n_twins.

    The row of the smallest id of a component is ``kept``; rows with that id and different
    texts are told apart by ``h``, rows with the same text are its ``n_twins``.
    """
    rows = stored(fingerprints(docs, words_each, id_col, text_col))
    distinct = stored(rows.select("fp").distinct())
    linked = components(links(distinct, max_bits)).withColumnRenamed("node", "fp")
    named = stored(
        distinct.join(shuffled(linked), "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))
    )
    best = winners(rows.join(shuffled(named), "fp"), ["component"], [])
    classes = stored(named.join(shuffled(best), "component").select("fp", "best", "n_twins"))
    return rows.join(shuffled(classes), "fp").select(
        "doc_id",
        "h",
        "fp",
        F.col("best.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("h") == F.col("best.h"))).alias("kept"),
        "n_twins",
    )


def deduplicated(
    docs: DataFrame, words_each: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each component, with all its columns."""
    return one_of_each(docs, grouped(docs, words_each, max_bits, id_col, text_col), id_col, text_col)
