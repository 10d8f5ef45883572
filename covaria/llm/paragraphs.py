"""Substring dedup: paragraph MinHash banding.

A paragraph is a stretch of words between cuts that the words themselves place: a word is a
cut if the hash of it and the next two is the smallest among the ``RADIUS`` words on either
side, the first of equal ones. A passage that repeats inside different surroundings, or with
other line breaks, is so cut at the same words, except near its ends: a passage of more than
50 words holds at least one whole paragraph unless cuts are unusually far apart. Paragraphs
have about 2 * RADIUS + 1 words. Words are compared with ASCII letters lowered; paragraphs
of fewer than ``least_words`` words are left alone.

Equal paragraphs share a 64-bit hash. For others, the sets of five-word shingles are
MinHashed in bands; ``tuned`` picks the bands for a recall at the threshold. Paragraphs that
meet in a band are compared with the bucket's first by exact Jaccard similarity of the
shingle sets, so a bucket of alike paragraphs costs one comparison each. Those that turn out
unlike it are compared with every paragraph that could reach the threshold with them by an
exact prefix filter (similar sets share one of their rarest shingles), so no similar pair
that meets is lost, and a bucket held together by a common phrase alone is not compared pair
by pair. Similar paragraphs form components, the classes. Of each class that occurs in two
rows or more, the first occurrence (smallest id, null last, then place) stays and the others
are removals. Repeats that follow each other make one stretch; stretches of fewer than
``least_run`` words are phrases, not passages, and stay.

Buckets are streams of sorted (band, hash) rows, never collected. A task sends a paragraph it
has just seen once, so a passage held by a third of all rows adds little.

Defined results: a null text counts as empty and has no paragraph. Repeated rows repeat each
other. Within one document a repeat alone is no removal. Other columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from covaria.llm.components import components, thinned
from covaria.llm.text import SPACE_BYTES, lower_ascii, raw_texts, slices, small_enough
from covaria.operators.durable import stored

RADIUS = 8
SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.99
LEAST_WORDS = 9
LEAST_RUN = 12
#: Bytes of text that are cut at a time.
SLICE = 1 << 20
SEED = 3
_MIX = 0x9E3779B97F4A7C15


def tuned(threshold: float = THRESHOLD, recall: float = RECALL, most_bands: int = 6) -> tuple[int, int]:
    """Bands and rows: as many rows as ``most_bands`` allow, then the fewest bands for the recall."""
    found = (0, 0)
    for rows in range(1, 17):
        for bands in range(1, most_bands + 1):
            if 1 - (1 - threshold**rows) ** bands >= recall:
                found = (bands, rows)
                break
    if not found[0]:
        raise ValueError("no number of bands reaches the recall")
    return found


def _mixed(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _grams(hashes, n: int):
    """Hash of every n hashes in a row."""
    import numpy as np

    size = max(len(hashes) - n + 1, 0)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = out * np.uint64(_MIX) + hashes[k : k + size]
    return _mixed(out)


def _least_before(values, width: int):
    """At each place the smallest of the ``width`` values before it (the largest number at the start)."""
    import numpy as np

    top = np.uint64(2**64 - 1)
    out = np.full(len(values), top, np.uint64)
    reach, least = 1, np.concatenate([[top], values])[: len(values)].astype(np.uint64)
    at = 0
    # ``least`` covers ``reach`` values; widths are put together from powers of two.
    while width:
        if width & 1:
            moved = np.concatenate([np.full(min(at, len(values)), top, np.uint64), least])[: len(values)]
            out = np.minimum(out, moved)
            at += reach
        width >>= 1
        least = np.minimum(least, np.concatenate([np.full(min(reach, len(values)), top, np.uint64), least])[: len(values)])
        reach *= 2
    return out


def word_hashes(raws: list[bytes]):
    """Hashes of all words of the texts in a row, and how many each text has."""
    import numpy as np

    flat = np.frombuffer(b"\n".join(lower_ascii(raw) for raw in raws) + b"\n", np.uint8)
    lengths = np.array([len(raw) + 1 for raw in raws], np.int64)
    inside = ~_space_table()[flat]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)])))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    used = np.flatnonzero(inside)
    first = np.searchsorted(used, starts)
    sizes = np.diff(first, append=len(used))
    values = np.random.default_rng(SEED).integers(0, 2**63, 256, dtype=np.uint64)[flat[used]]
    return _sequence_hashes(values, first, sizes), counts


def _space_table():
    import numpy as np

    table = np.zeros(256, bool)
    table[list(SPACE_BYTES)] = True
    return table


def _sequence_hashes(values, first, sizes):
    """Hash of each run ``values[first:first + size]``; runs lie side by side."""
    import numpy as np

    powers = np.concatenate([[1], np.cumprod(np.full(int(sizes.max()), _MIX, np.uint64))]).astype(np.uint64)
    place = np.arange(len(values)) - np.repeat(first, sizes)
    return _mixed(np.add.reduceat(values * powers[place], first) + sizes.astype(np.uint64) * np.uint64(_MIX))


def cuts(hashes, counts, radius: int = RADIUS):
    """Where paragraphs begin among the words of texts in a row; each text's first word always does."""
    import numpy as np

    top = np.uint64(2**64 - 1)
    owner = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    # Texts are set apart, so that no window reaches from one into another.
    place = np.arange(len(hashes)) + owner * radius
    marks = np.full(len(hashes) + len(counts) * radius, top, np.uint64)
    whole = np.flatnonzero(np.arange(len(hashes)) + 3 <= (begin + counts)[owner])
    marks[place[whole]] = _grams(hashes, 3)[whole]
    before = _least_before(marks, radius)
    after = _least_before(marks[::-1], radius)[::-1]
    least = ((marks < before) & (marks <= after) & (marks != top))[place]
    least[begin[counts > 0]] = True
    return np.flatnonzero(least)


@dataclass(frozen=True)
class Paragraphs:
    """Paragraphs with enough words of a few texts; starts count among all words in a row."""

    hashes: object
    owner: object
    starts: object
    first: object
    sizes: object
    ids: object

    @staticmethod
    def of(raws: list[bytes], radius: int, least_words: int) -> Paragraphs:
        import numpy as np

        hashes, counts = word_hashes(raws)
        starts = cuts(hashes, counts, radius)
        begin = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(counts)), counts)[starts]
        sizes = np.diff(starts, append=len(hashes))
        ids = _sequence_hashes(hashes, starts, sizes).view(np.int64) if len(starts) else np.zeros(0, np.int64)
        use = sizes >= least_words
        starts, owner = starts[use], owner[use]
        return Paragraphs(hashes, owner, starts, starts - begin[owner], sizes[use], ids[use])

    def shingles(self):
        """Shingle hashes of all paragraphs in a row, and how many each has."""
        import numpy as np

        counts = np.maximum(self.sizes - SHINGLE + 1, 0)
        ends = np.cumsum(counts)
        total = int(counts.sum())
        return _grams(self.hashes, SHINGLE)[np.repeat(self.starts - ends + counts, counts) + np.arange(total)], counts


def _occurrences(docs: DataFrame, radius: int, least_words: int) -> DataFrame:
    """doc_id, row (a number of the document), start, n_words and pid of every paragraph."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            raws = raw_texts(batch.column("text"))
            for begin, end in slices(raws, SLICE):
                found = Paragraphs.of(raws[begin:end], radius, least_words)
                owner = found.owner + begin
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(owner)),
                        pa.array(owner + row),
                        pa.array(found.first),
                        pa.array(found.sizes),
                        pa.array(found.ids),
                    ],
                    names=["doc_id", "row", "start", "n_words", "pid"],
                )
            row += batch.num_rows

    return docs.mapInArrow(run, f"doc_id {kind}, row bigint, start bigint, n_words bigint, pid bigint")


def _bands(docs: DataFrame, radius: int, least_words: int, bands: int, rows: int) -> DataFrame:
    """(band, pid) of every paragraph, once for each slice of texts."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        random = np.random.default_rng(SEED)
        factors = random.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            raws = raw_texts(batch.column("text"))
            for begin, end in slices(raws, SLICE):
                found = Paragraphs.of(raws[begin:end], radius, least_words)
                if not len(found.ids):
                    continue
                grams, counts = found.shingles()
                first = np.cumsum(counts) - counts
                ids, fresh = np.unique(found.ids, return_index=True)
                for band in range(bands):
                    key = np.full(len(fresh), (band + 1) * _MIX & (2**64 - 1), np.uint64)
                    for k in range(band * rows, (band + 1) * rows):
                        least = np.minimum.reduceat(_mixed(grams * factors[k]), first)[fresh]
                        key = _mixed(key + least) * np.uint64(_MIX)
                    yield pa.RecordBatch.from_pydict({"band": pa.array(key.view(np.int64)), "pid": pa.array(ids)})

    return docs.select("text").mapInArrow(run, "band bigint, pid bigint")


def _firsts(bands: DataFrame) -> DataFrame:
    """(band, lo, pid): every paragraph that meets another in a band, with the bucket's smallest."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        last_band = last_pid = lo = None
        for batch in batches:
            band, pid = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("band", "pid"))
            if not len(band):
                continue
            new = np.concatenate([[band[0] != last_band], band[1:] != band[:-1]])
            again = ~new & np.concatenate([[pid[0] == last_pid], pid[1:] == pid[:-1]])
            at = np.maximum.accumulate(np.where(new, np.arange(len(band)), -1))
            first = np.where(at >= 0, pid[np.maximum(at, 0)], 0 if lo is None else lo)
            use = ~new & ~again & (pid != first)
            yield pa.RecordBatch.from_pydict({
                "band": pa.array(band[use]), "lo": pa.array(first[use].astype(np.int64)), "pid": pa.array(pid[use]),
            })
            last_band, last_pid, lo = band[-1], pid[-1], first[-1]

    sorted_rows = bands.repartition("band").sortWithinPartitions("band", "pid")
    return sorted_rows.mapInArrow(run, "band bigint, lo bigint, pid bigint")


def _sets(docs: DataFrame, ids: DataFrame, radius: int, least_words: int) -> DataFrame:
    """Shingle set of each paragraph in ``ids`` (pid)."""

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            raws = raw_texts(batch.column("text"))
            for begin, end in slices(raws, SLICE):
                found = Paragraphs.of(raws[begin:end], radius, least_words)
                grams, counts = found.shingles()
                ends = np.cumsum(counts)
                unique, fresh = np.unique(found.ids, return_index=True)
                own = [grams[a:b].tobytes() for a, b in zip((ends - counts)[fresh].tolist(), ends[fresh].tolist())]
                yield pa.RecordBatch.from_pydict({"pid": pa.array(unique), "grams": pa.array(own, pa.binary())})

    def opened(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            sets = [np.unique(np.frombuffer(g, np.int64)) for g in batch.column("grams").to_pylist()]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*sets, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([batch.column("pid"), lists], names=["pid", "grams"])

    every = docs.select("text").mapInArrow(cut, "pid bigint, grams binary")
    some = every.join(small_enough(ids, 32), "pid", "left_semi")
    return some.groupBy("pid").agg(F.any_value("grams").alias("grams")).mapInArrow(opened, "pid bigint, grams array<bigint>")


def _prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    """(pid, size, place, gram): of each set of n the n - ceil(t n) + 1 shingles rarest among the sets.

    Two sets with Jaccard similarity t or more have one of these in common. ``place`` counts
    the set's shingles from the rarest.
    """
    each = sets.select("pid", F.size("grams").alias("size"), F.explode("grams").alias("gram"))
    often = stored(each.groupBy("gram").agg(F.count("*").alias("n")))
    ranked = each.join(often, "gram").groupBy("pid", "size").agg(
        F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("by_count")
    )
    length = (F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1).cast("int")
    first = F.posexplode(F.slice("by_count", F.lit(1), length)).alias("place", "g")
    return ranked.select("pid", "size", first).select("pid", "size", "place", "g.gram")


def _compared(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` (a, b) with ``similar``: exact Jaccard at the threshold or above."""
    left = sets.select(F.col("pid").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("pid").alias("b"), F.col("grams").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    similar = both >= threshold * (F.size("x") + F.size("y") - both)
    return pairs.join(left, "a").join(right, "b").select("a", "b", similar.alias("similar"))


def links(docs: DataFrame, threshold: float, recall: float, radius: int, least_words: int) -> DataFrame:
    """Links (a, b) that connect all similar paragraphs that meet in a band."""
    bands, rows = tuned(threshold, recall)
    met = stored(_firsts(_bands(docs, radius, least_words, bands, rows)))
    ids = stored(met.select(F.explode(F.array("lo", "pid")).alias("pid")).distinct())
    sets = stored(_sets(docs, ids, radius, least_words))
    pairs = met.select(F.col("lo").alias("a"), F.col("pid").alias("b")).distinct()
    first = stored(_compared(pairs, sets, threshold))
    # What is unlike its bucket's first may be like another of the bucket. Such pairs share a
    # shingle that is rare among the sets, where the bucket may share a common phrase only.
    # At the first shingle they share, enough others must be left in both. Pairs that are
    # linked already, by way of others, are passed over.
    unlike = first.where("NOT similar").select(F.col("b").alias("pid")).distinct()
    known = components(thinned(first.where("similar").select("a", "b"))).withColumnRenamed("node", "pid")
    rare = _prefixes(sets, threshold).join(known, "pid", "left")
    rare = stored(rare.withColumn("part", F.coalesce("component", "pid")).drop("component"))
    left = rare.join(unlike, "pid", "left_semi").select(
        F.col("pid").alias("x"), F.col("size").alias("n"), F.col("place").alias("at"), F.col("part").alias("own"), "gram"
    )
    fits = (F.col("size") >= threshold * F.col("n") - 1e-9) & (F.col("n") >= threshold * F.col("size") - 1e-9)
    shared = F.least(F.col("n") - F.col("at"), F.col("size") - F.col("place"))
    enough = shared >= threshold / (1 + threshold) * (F.col("n") + F.col("size")) - 1e-9
    more = (
        left.join(rare, "gram")
        .where((F.col("x") != F.col("pid")) & (F.col("own") != F.col("part")) & fits & enough)
        .select(F.least("x", "pid").alias("a"), F.greatest("x", "pid").alias("b"))
        .distinct()
    )
    second = _compared(more, sets, threshold)
    return thinned(first.union(second).where("similar").select("a", "b"))


def repeated(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    radius: int = RADIUS,
    least_words: int = LEAST_WORDS,
    least_run: int = LEAST_RUN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per occurrence of a paragraph that other documents hold too.

    doc_id, start and n_words (in words of the text), class_id, keep_id (the document whose
    occurrence stays), n_docs, removed, and row, a number of the document's row.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = stored(_occurrences(docs, radius, least_words))
    linked = stored(components(links(docs, threshold, recall, radius, least_words)))
    span = found.groupBy("pid").agg(F.min("row").alias("lo"), F.max("row").alias("hi"))
    named = (
        span.join(linked, span.pid == linked.node, "left")
        .where("lo <> hi OR component IS NOT NULL")
        .select("pid", F.coalesce("component", "pid").alias("class_id"))
    )
    named = stored(named)
    here = stored(found.join(small_enough(named, 48), "pid").drop("pid"))
    place = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "row", "start")
    by_row = here.groupBy("class_id", "row").agg(F.min(place).alias("place"))
    classes = (
        by_row.groupBy("class_id")
        .agg(F.min("place").alias("first"), F.count("*").alias("n_docs"))
        .where("n_docs > 1")
    )
    classes = stored(classes)
    same = (F.col("row") == F.col("first.row")) & (F.col("start") == F.col("first.start"))
    marks = here.join(classes, "class_id").select(
        "doc_id", "start", "n_words", "class_id", F.col("first.doc_id").alias("keep_id"), "n_docs",
        (~same).alias("removed"), "row",
    )
    # A stretch begins where a repeat does not start at the end of another.
    in_row = Window.partitionBy("row").orderBy("start")
    begins = F.coalesce(F.lag(F.col("start") + F.col("n_words")).over(in_row) != F.col("start"), F.lit(True))
    stretch = F.sum(begins.cast("int")).over(in_row)
    long_enough = F.sum("n_words").over(Window.partitionBy("row", "stretch")) >= least_run
    return (
        marks.withColumn("stretch", stretch).withColumn("long", long_enough).where("long").drop("stretch", "long")
    )


def removals(marks: DataFrame) -> DataFrame:
    """doc_id and spans (arrays of first word and number of words) to be removed, per document row."""
    gone = marks.where("removed")
    return gone.groupBy("row").agg(
        F.any_value("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("start", "n_words"))).alias("spans")
    )


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and the white space after them."""
    import re

    words = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)] + [len(text)]
    keep, at = [], 0
    for first, n in sorted(spans):
        keep.append(text[at : max(at, words[first])])
        at = max(at, words[first + n])
    return "".join([*keep, text[at:]])
