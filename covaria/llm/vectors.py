"""Integer vectors of the ``embeddings`` table, and the blocks in which queries meet candidates.

A row takes part when its ``vec_id`` is not null and its vector is not null and holds no null, NaN or infinite component; an empty
vector takes part and scores 0 against everything. Each component ``x`` becomes
``floor(256 * x)`` with ``x`` read as a double. Vectors of unequal length meet on their common
dimensions (a missing component counts as 0). Scores are integer inner products in 64 bits;
they are exact while every ``|floor(256 x)|`` stays below 2^26 and vectors below 2^10
dimensions, which any embedding of values in [-1, 1] meets by far.

Queries meet all candidates in blocks: candidates are dealt by a hash of ``vec_id`` into
``ceil(candidates / candidate_rows)`` blocks, queries into ``ceil(queries / query_rows)``; a
query row is copied to every candidate block and a candidate row to every query block, so one
task holds at most about ``query_rows`` queries and ``candidate_rows`` candidates whatever the
table's size. No pair of rows is written out; a task reduces its block to a few rows a query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Queries and candidates a task holds at most, about; their product bounds a task's score array.
QUERY_ROWS, CANDIDATE_ROWS = 512, 8192


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def usable(vec: Column) -> Column:
    """True where a vector takes part; NaN compares above infinity in Spark, so both fail ``< inf``."""
    return F.col("vec_id").isNotNull() & vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(math.inf)))


def scaled(vec: Column, by: int = 256) -> Column:
    """``floor(by * x)`` of every component, as longs."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * F.lit(float(by))).cast("long"))


def divisible(vec_id: Column, by: int) -> Column:
    return vec_id.isNotNull() & (vec_id % by == 0)


def matrix(column: pd.Series) -> np.ndarray:
    """Rows of long arrays as one int64 matrix, short rows padded with zeros."""
    rows = [np.asarray(v, dtype=np.int64) for v in column]
    width = max((len(v) for v in rows), default=0)
    out = np.zeros((len(rows), width), dtype=np.int64)
    for k, v in enumerate(rows):
        out[k, : len(v)] = v
    return out


def aligned(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices widened with zero columns to the larger width."""
    width = max(a.shape[1], b.shape[1])
    return (np.pad(a, ((0, 0), (0, width - a.shape[1]))), np.pad(b, ((0, 0), (0, width - b.shape[1]))))


def best(scores: np.ndarray, ids: np.ndarray, k: int, allowed: np.ndarray | None = None) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller id, among ``allowed`` places (all if None).

    ``ids`` must ascend, so that a smaller place is a smaller id.
    """
    places = np.arange(len(scores)) if allowed is None else np.flatnonzero(allowed)
    if len(places) > k:
        values = scores[places]
        kth = np.partition(values, len(values) - k)[len(values) - k]
        places = places[values >= kth]
    order = np.lexsort((places, -scores[places]))
    return places[order[:k]]


def blocked(spark: SparkSession, queries: DataFrame, candidates: DataFrame, counts: tuple[int, int],
            query_rows: int = QUERY_ROWS, candidate_rows: int = CANDIDATE_ROWS) -> tuple[DataFrame, DataFrame, int]:
    """Both sides keyed by ``qblock`` and ``cblock``, each row copied to every block of the other side.

    Both are dealt to the same number of partitions by the same two keys, so that a cogroup of
    them shuffles each once. Returns the two sides and that number.
    """
    n_queries, n_candidates = counts
    qb = max(1, math.ceil(n_queries / query_rows))
    cb = max(1, math.ceil(n_candidates / candidate_rows))
    parts = qb * cb
    # Both keys are ints on both sides: hash partitions of an int and a long of one value differ.
    q = queries.withColumn("qblock", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(qb)).cast("int")).withColumn(
        "cblock", F.explode(F.sequence(F.lit(0), F.lit(cb - 1)))
    )
    c = candidates.withColumn("cblock", F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(cb)).cast("int")).withColumn(
        "qblock", F.explode(F.sequence(F.lit(0), F.lit(qb - 1)))
    )
    return q.repartition(parts, "qblock", "cblock"), c.repartition(parts, "qblock", "cblock"), parts
