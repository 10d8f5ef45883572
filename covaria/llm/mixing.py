"""Mixing sources to target weights by capped water-filling.

Targets. Sources share ``total`` words by weight. A source whose share exceeds ``max_epochs``
times its size is clamped there, and the excess goes to the others in proportion to their
weights, until no share is above its cap.

Sampling. A source with target t and size s takes every document floor(t / s) times whole.
The rest of its target, less than s words, is a fraction of one more repetition: documents
in the order of a seeded hash, until the rest is reached. The order is cut by a histogram of
the hash with about sqrt(n) / 8 classes for n documents: classes below the cut are taken
entirely, above it not at all. Only the documents of the class at the cut, some 8 sqrt(n),
are put in order in one task. They are taken in order, those longer than what is left passed
over, while the rest exceeds the next ``FITTED`` documents together; of those a set is chosen
whose sum comes nearest to what is left, and so on with all that are not taken. So a source
misses its target by less than its shortest document at the cut that is not taken, and no
task holds a source.

Defined results: a null text has size 0; documents of size 0 take nothing. A null source is a
source, last in order. Identical rows (id, source, text) share one decision. Sources with no
words have target 0. The same table, seed and weights give the same result whatever the
partitioning. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from covaria.functions import column
from covaria.llm.text import small_enough, word_count
from covaria.operators.durable import stored

SEED = 20_240_229
MAX_EPOCHS = 3
#: The seeded hash is a number below 2^RANGE_BITS.
RANGE_BITS = 52
#: The last documents of a source are chosen together, so many of them.
FITTED = 40
#: Sums that are told apart when they are.
SUMS = 1_000_000


def _place(id_col: str, text_col: str, seed: int) -> Column:
    """The document's place in its source's order."""
    mixed = F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(F.col(text_col)))
    return F.shiftrightunsigned(mixed, 64 - RANGE_BITS)


def _class_of(place: Column, classes: Column) -> Column:
    return F.floor(place * classes.cast("double") / float(1 << RANGE_BITS)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` from 0 in order of code points, null last.

    Ranks are counted inside range partitions; only the partitions' sizes reach the driver.
    """
    dealt = stored(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    )
    sizes = sorted((r["part"], r["count"]) for r in dealt.groupBy("part").count().collect())
    before, starts = 0, []
    for part, size in sizes:
        starts.append((part, before))
        before += size
    start = F.create_map(*[F.lit(x) for pair in starts or [(0, 0)] for x in pair])
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return dealt.withColumn("rank", (inside - 1 + start[F.col("part")]).cast("long")).drop("part")


def water_level(sources: DataFrame, total: float) -> float:
    """Words per unit of weight for sources that are not clamped.

    ``sources`` has weight and cap. Each round is one aggregation; the level only rises.
    """
    level, clamped = 0.0, -1
    under = F.col("cap") < F.col("weight") * F.lit(0.0)
    while True:
        free = F.when(~under, F.col("weight")).otherwise(0.0)
        fixed = F.when(under, F.col("cap")).otherwise(0)
        weight, caps, n = sources.agg(F.sum(free), F.sum(fixed), F.sum(under.cast("long"))).first()
        if not weight or n == clamped:
            return level if weight is not None else 0.0
        level, clamped = (total - caps) / weight, n
        under = F.col("cap") < F.col("weight") * F.lit(level)


def targets(sizes: DataFrame, weight: Column, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Per source: source_size, n, weight, target. ``weight`` may use rank and source."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = stored(ranked(sources).withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(sources, total)
    return sources.withColumn(
        "target", F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(float(level)))
    )


def nearest_sum(sizes: list[int], rest: int) -> list[bool]:
    """Which of the sizes to take so that their sum comes nearest ``rest`` from below.

    Sums are bits of one number; beyond a million, sizes are rounded up to a larger unit.
    Where sums are equal, earlier sizes are taken rather than later ones.
    """
    unit = max(1, rest // SUMS)
    most = rest // unit
    steps = [-(-size // unit) for size in sizes]
    reached = [1]
    for step in steps:
        more = reached[-1] << step if 0 < step <= most else 0
        reached.append((reached[-1] | more) & ((1 << (most + 1)) - 1))
    at, taken = reached[-1].bit_length() - 1, [False] * len(sizes)
    for k in reversed(range(len(sizes))):
        if not reached[k] >> at & 1:
            taken[k] = True
            at -= steps[k]
    return taken


def filled(sizes, rest: int):
    """Which of the sizes, in order, to take until their sum is ``rest`` or no other fits.

    Sizes above what is left are passed over. The others are taken in order while the rest
    exceeds the next ``FITTED`` of them together; else of these the set with the nearest sum
    is, and the walk goes on with all that are not taken.
    """
    import numpy as np

    taken = np.zeros(len(sizes), bool)
    while len(fit := np.flatnonzero(~taken & (sizes > 0) & (sizes <= rest))):
        upto = np.cumsum(sizes[fit])
        ahead = upto[np.minimum(np.arange(len(fit)) + FITTED, len(fit)) - 1]
        some = fit[: np.searchsorted(ahead, rest)]  # then these fit
        if not len(some):
            window = fit[:FITTED]
            some = window[nearest_sum(sizes[window].tolist(), rest)]
            if not len(some):  # sums are rounded
                some = window[:1]
        taken[some] = True
        rest -= int(sizes[some].sum())
    return taken


def _chosen_at_the_cut(group):
    """Documents of one source's class at the cut that are taken once more."""
    import pandas as pd

    group = group.sort_values("place", kind="stable")
    taken = filled(group["size"].to_numpy(), int(group["rest"].iloc[0]))
    return pd.DataFrame({"source": group["source"], "place": group["place"]})[taken]


def plan(sizes: DataFrame, weight: Column, max_epochs: float = MAX_EPOCHS) -> tuple[DataFrame, DataFrame]:
    """Per source what to take, and the (source, place) pairs taken once more at its cut.

    ``sizes`` has source, size and place and is read several times.
    """
    aims = targets(sizes, weight, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    aims = stored(
        aims.withColumn("whole", whole.cast("long"))
        .withColumn("want", (F.round("target") - F.col("whole") * F.col("source_size")).cast("long"))
        .withColumn("classes", F.ceil(F.sqrt("n") / 8).cast("long"))
    )
    known = small_enough(aims.select(F.col("source").alias("s"), "classes"), 300)
    # Rows with one place are one unit, so that equal rows share a decision.
    units = sizes.join(known, sizes.source.eqNullSafe(known.s)).select(
        "source", "size", "place", _class_of(F.col("place"), F.col("classes")).alias("class")
    )
    counted = units.groupBy("source", "class").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("class"))
    counted = counted.withColumn("before", upto - F.col("words")).withColumnRenamed("source", "s")
    found = aims.join(counted, aims.source.eqNullSafe(counted.s), "left").drop("s")
    inside = (F.col("before") <= F.col("want")) & (F.col("want") < F.col("before") + F.col("words"))
    cuts = found.groupBy(*[c for c in aims.columns]).agg(
        F.min(F.when(inside, F.struct("class", (F.col("want") - F.col("before")).alias("rest")))).alias("cut")
    )
    cuts = stored(
        cuts.select(
            "source", "source_size", "target", "whole", "classes",
            F.coalesce("cut.class", F.when(F.col("want") >= F.col("source_size"), F.col("classes")).otherwise(0)).alias("cut"),
            F.coalesce("cut.rest", F.lit(0)).alias("rest"),
        )
    )
    at = small_enough(cuts.where("rest > 0").select(F.col("source").alias("s"), "cut", "rest"), 300)
    edge = units.join(at, units.source.eqNullSafe(at.s) & (F.col("class") == F.col("cut")))
    edge = edge.groupBy("source", "place").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"))
    chosen = edge.groupBy("source").applyInPandas(_chosen_at_the_cut, "source string, place bigint")
    return cuts, stored(chosen)


def repeats(rows: DataFrame, cuts: DataFrame, chosen: DataFrame) -> DataFrame:
    """``rows`` (with source and place) and the source's figures and number of ``repeats``."""
    cuts = small_enough(cuts.withColumnRenamed("source", "s"), 300)
    chosen = small_enough(chosen.select(F.col("source").alias("c"), F.col("place").alias("p")), 300)
    joined = rows.join(cuts, rows.source.eqNullSafe(cuts.s), "left")
    joined = joined.join(chosen, joined.source.eqNullSafe(chosen.c) & (joined.place == chosen.p), "left")
    extra = (_class_of(F.col("place"), F.col("classes")) < F.col("cut")) | F.col("p").isNotNull()
    return joined.withColumn("repeats", (F.col("whole") + extra.cast("long")).cast("long"))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        _place(id_col, text_col, seed).alias("place"),
    )


def cycled(*weights: float) -> Column:
    """Weights dealt to the sources in order, again and again."""
    return F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))


def mixed(
    docs: DataFrame,
    weight: Column,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, repeats."""
    rows = stored(sized(docs, id_col, text_col, source_col, seed))
    cuts, chosen = plan(rows, weight, max_epochs)
    return repeats(rows, cuts, chosen).select(
        "doc_id", "size", "source_size", "target", (F.col("repeats") * F.col("size")).alias("taken"), "repeats"
    )


def repeated(
    docs: DataFrame,
    weight: Column,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns."""
    rows = stored(sized(docs, id_col, text_col, source_col, seed))
    cuts, chosen = plan(rows, weight, max_epochs)
    whole = F.struct(*[column(c) for c in docs.columns]).alias("row")
    named = docs.select(whole, column(source_col).cast("string").alias("source"), _place(id_col, text_col, seed).alias("place"))
    taken = repeats(named, cuts, chosen).where("repeats > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), F.col("repeats").cast("int")))).select("row.*")
