"""Connected components of a graph of links, computed by rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covaria.llm.text import small_enough
from covaria.operators.durable import stored

#: A task keeps so many nodes in memory while it thins out links.
FOREST_NODES = 200_000
#: A broadcast row of two ids takes at most so much: itself and its places in the hash index.
ROW_BYTES = 112


def thinned(links: DataFrame) -> DataFrame:
    """Links (a, b) of ids reduced inside each task to a spanning forest.

    The components stay the same; a task emits at most one link per node it has seen.
    """

    def run(batches):
        import pyarrow as pa

        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        def emit():
            pairs = [(x, root(x)) for x in list(parent)]
            pairs = [(x, r) for x, r in pairs if x != r]
            return pa.RecordBatch.from_pydict({
                "a": pa.array([x for x, _ in pairs], pa.int64()),
                "b": pa.array([r for _, r in pairs], pa.int64()),
            })

        for batch in batches:
            for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = root(x), root(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            if len(parent) > FOREST_NODES:
                yield emit()
                parent.clear()
        yield emit()

    return links.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node in a link.

    Alternates large-star and small-star steps (Kiveris et al. 2014): every node's larger
    neighbours move to its smallest one, then its smaller neighbours do. Minima combine
    inside each task; the minima are stored before they are joined: counted, few are broadcast,
    and among more a node with very many links is split by the skew join.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while True:
        after = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if after == before or not after[0]:
            break
        before = after
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.where("b > a").join(small_enough(lowest, ROW_BYTES), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(large.distinct())
        lowest = stored(edges.groupBy("a").agg(F.min("b").alias("m")))
        small = edges.join(small_enough(lowest, ROW_BYTES), "a").select("a", "b", "m")
        small = small.select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct("a", F.col("m").alias("b")),
        )).alias("e")).select("e.a", "e.b")
        edges = stored(small.where("a <> b").distinct())
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.union(edges.select(F.col("b"), F.col("b"))).distinct()
