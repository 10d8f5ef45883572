"""Exact top-k search by inner product, term at a time.

Every query meets every candidate: in a task, one block of queries meets one block of
candidates (see ``vectors``). The candidate block is an index of postings, one dense posting
list per dimension (the candidates' values there). Queries are taken as sparse rows: for each
dimension, the queries whose value there is not zero scatter that value times the posting list
into a dense score array of (queries x candidates). Per query the ``k`` best places are picked
by partition selection (``np.partition``, then an exact order of the few at or above the k-th
score), so a task returns at most ``k`` rows a query. The partial lists of all candidate blocks
are merged by a window with a row limit, which Spark applies before the shuffle as well.

Defined cases:

* rows with a null ``vec_id`` or an unusable vector (null, or a null, NaN or infinite
  component) are neither queries nor candidates;
* a query never meets a row with its own ``vec_id`` (repeated rows of that id included);
  repeated rows under other ids are separate candidates; a query id of several rows gets one
  list, the best among the scores against any of its rows (as a SQL window over the id);
* ties go to the smaller ``vec_id``; fewer than ``k`` candidates give all of them;
* an empty table, or one without queries, gives no rows; other columns of the table are
  carried by no row and cannot clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covaria.llm import vectors

RESULT = "query_id long, rank int, vec_id long, score long"
_PARTIAL = "query_id long, vec_id long, score long"


def _accumulated(queries: np.ndarray, postings: np.ndarray) -> np.ndarray:
    """Scores of all queries against all candidates, one term (dimension) at a time.

    A term's posting list is the candidates' values there, held contiguous; queries whose
    weight there is zero skip it. Where the largest weights and postings bound every score
    below 2^31, scores are kept in 32 bits, else in 64.
    """
    lists = np.ascontiguousarray(postings.T)
    bound = int(np.abs(queries).max(initial=0)) * int(np.abs(lists).max(initial=0)) * queries.shape[1]
    kind = np.int32 if bound < 2**31 else np.int64
    lists, weights_all = lists.astype(kind), queries.astype(kind)
    scores = np.zeros((queries.shape[0], postings.shape[0]), dtype=kind)
    for term in range(queries.shape[1]):
        weights = weights_all[:, term]
        rows = np.flatnonzero(weights)
        if rows.size == len(weights):
            scores += weights[:, None] * lists[term][None, :]
        elif rows.size:
            scores[rows] += weights[rows, None] * lists[term][None, :]
    return scores.astype(np.int64)


def _block_top(k: int):
    def top(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        c = c.sort_values("vec_id", kind="stable")
        ids = c["vec_id"].to_numpy(dtype=np.int64)
        qv, cv = vectors.aligned(vectors.matrix(q["v"]), vectors.matrix(c["v"]))
        scores = _accumulated(qv, cv)
        out_q, out_c, out_s = [], [], []
        for row, query_id in enumerate(q["vec_id"].to_numpy(dtype=np.int64)):
            chosen = vectors.best(scores[row], ids, k, ids != query_id)
            out_q.append(np.full(len(chosen), query_id, dtype=np.int64))
            out_c.append(ids[chosen])
            out_s.append(scores[row, chosen])
        return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_c),
                             "score": np.concatenate(out_s)})

    return top


def searched(table: DataFrame, every: int = 50, k: int = 5, by: int = 256,
             query_rows: int = vectors.QUERY_ROWS, candidate_rows: int = vectors.CANDIDATE_ROWS) -> DataFrame:
    """The ``k`` best candidates of each query (rows whose ``vec_id`` divides by ``every``).

    ``table`` needs ``vec_id`` and ``embedding``. Returns query_id, rank (from 1), vec_id, score.
    """
    spark = table.sparkSession
    rows = table.where(vectors.usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), vectors.scaled(F.col("embedding"), by).alias("v")
    )
    is_query = vectors.divisible(F.col("vec_id"), every)
    counted = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    queries, candidates, _ = vectors.blocked(
        spark, rows.where(is_query), rows, (counted["q"], counted["n"]), query_rows, candidate_rows
    )
    partial = (
        queries.groupBy("qblock", "cblock")
        .cogroup(candidates.groupBy("qblock", "cblock"))
        .applyInPandas(_block_top(k), _PARTIAL)
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (
        partial.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
