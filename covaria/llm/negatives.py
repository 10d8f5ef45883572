"""Hard negatives by Fagin's threshold algorithm.

For an anchor, every row's score is its integer inner product with the anchor (see ``vectors``).
Positives are the anchor's best ``positives`` other rows of the same label; for each positive
with score ``p``, negatives are the best ``negatives`` rows of another label whose score ``s``
lies in the window ``low * p <= 100 * s <= high * p`` (percent bounds). Higher scores come
first, ties to the smaller ``vec_id``.

Method, in each task (one block of anchors against one block of rows):

* per-dimension sorted lists of the block's rows, one ascending and one descending, ties by
  ``vec_id``; an anchor walks each list in the direction of the sign of its own component
  (anchor-signed sorted access), dimensions where it is zero not at all;
* every row met is scored exactly by random access (its whole integer vector);
* the threshold is the sum over dimensions of the anchor's component times the last value met
  in that list: no row not yet met can score above it. A window is settled once it holds ``k``
  rows met and the threshold is strictly below the ``k``-th of their scores, or once the
  threshold is strictly below the window's lower bound. The walk stops when all of the anchor's
  windows are settled (depth doubles between checks, which changes no result).

Phase one finds positives (one window without bounds, ``k = positives``, rows of the anchor's
label only); their global best are merged by a window with a row limit. Phase two gives every
anchor the windows of its positives and walks rows of other labels. Partial lists of all blocks
are merged alike.

Defined cases: rows with a null ``vec_id``, a null label, a null or unusable vector take no part; where ``vec_id``
divides by ``shift_every`` the label first becomes ``(label + 1) % 10``; an anchor never counts
rows with its own ``vec_id``; a positive score of 0 gives a window of score 0 only, a negative
one an empty window; fewer rows than asked give all of them; an anchor id of several rows
scores every row against each of them and keeps the best, as a SQL join on the id would; an empty table gives no rows;
other columns are carried by no row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covaria.llm import vectors
from covaria.operators.durable import stored

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_POSITIVES = "anchor_id long, positive_id long, positive_score long"
_NEGATIVES = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


class Lists:
    """Sorted lists of one block of rows, ``ids`` ascending."""

    def __init__(self, values: np.ndarray, ids: np.ndarray):
        self.values, self.ids = values, ids
        places = np.arange(len(ids))
        # lexsort's last key sorts first: by value, then by place (= vec_id).
        self.up = [np.lexsort((places, values[:, j])) for j in range(values.shape[1])]
        self.down = [np.lexsort((places, -values[:, j])) for j in range(values.shape[1])]

    def walk(self, anchor: np.ndarray, eligible: np.ndarray, windows: list[tuple[float, float, int]]) -> list[np.ndarray]:
        """For each window (low, high, k), the places of its best ``k`` eligible rows, by the threshold algorithm."""
        n = len(self.ids)
        active = np.flatnonzero(anchor)
        seen = np.zeros(n, dtype=bool)
        scores = np.zeros(n, dtype=np.int64)
        lists = [self.down[j] if anchor[j] > 0 else self.up[j] for j in active]
        depth, step = 0, 64
        settled = [low > high for low, high, _ in windows]
        while not all(settled):
            if not lists:  # every score is 0: all rows are met at once
                depth = n
                fresh = np.flatnonzero(~seen)
            else:
                end = min(n, depth + step)
                met = np.concatenate([order[depth:end] for order in lists])
                fresh = np.unique(met[~seen[met]])
                depth = end
            scores[fresh] = self.values[fresh] @ anchor
            seen[fresh] = True
            if depth >= n:
                break
            threshold = sum(int(anchor[j]) * int(self.values[order[depth - 1], j]) for j, order in zip(active, lists))
            for w, (low, high, k) in enumerate(windows):
                if settled[w]:
                    continue
                inside = seen & eligible & (scores >= low) & (scores <= high)
                count = int(inside.sum())
                if count >= k:
                    kth = np.partition(scores[inside], count - k)[count - k]
                    settled[w] = threshold < kth
                else:
                    settled[w] = threshold < low
            step *= 2
        chosen = []
        for low, high, k in windows:
            if low > high:
                chosen.append(np.zeros(0, dtype=np.int64))
                continue
            inside = seen & eligible & (scores >= low) & (scores <= high)
            chosen.append(vectors.best(scores, self.ids, k, inside))
        self.scores = scores
        return chosen


def _block(rows: pd.DataFrame) -> tuple[Lists, np.ndarray]:
    rows = rows.sort_values("vec_id", kind="stable")
    return rows, vectors.matrix(rows["v"])


def _positives(k: int):
    def walk(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = {"anchor_id": [], "positive_id": [], "positive_score": []}
        if a.empty or c.empty:
            return pd.DataFrame(out)
        c, cv = _block(c)
        av, cv = vectors.aligned(vectors.matrix(a["v"]), cv)
        ids, labels = c["vec_id"].to_numpy(dtype=np.int64), c["label"].to_numpy()
        lists = {}
        for row, (anchor_id, label) in enumerate(zip(a["vec_id"].to_numpy(dtype=np.int64), a["label"].to_numpy())):
            if label not in lists:
                mine = labels == label
                lists[label] = (Lists(cv[mine], ids[mine]), ids[mine])
            found, own = lists[label]
            if not len(own):
                continue
            (chosen,) = found.walk(av[row], own != anchor_id, [(-np.inf, np.inf, k)])
            out["anchor_id"] += [anchor_id] * len(chosen)
            out["positive_id"] += own[chosen].tolist()
            out["positive_score"] += found.scores[chosen].tolist()
        return pd.DataFrame(out)

    return walk


def _negatives(k: int, low: int, high: int):
    def walk(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = {name: [] for name in ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")}
        if a.empty or c.empty:
            return pd.DataFrame(out)
        c, cv = _block(c)
        av, cv = vectors.aligned(vectors.matrix(a["v"]), cv)
        ids, labels = c["vec_id"].to_numpy(dtype=np.int64), c["label"].to_numpy()
        lists = Lists(cv, ids)
        for row, (anchor_id, label, pos_ids, pos_scores) in enumerate(
            zip(a["vec_id"].to_numpy(dtype=np.int64), a["label"].to_numpy(), a["pos_ids"], a["pos_scores"])
        ):
            # low * p <= 100 * s <= high * p, in integers: ceil(low * p / 100) <= s <= floor(high * p / 100).
            windows = [(-((-low * int(p)) // 100), (high * int(p)) // 100, k) for p in pos_scores]
            if not windows:
                continue
            found = lists.walk(av[row], (labels != label) & (ids != anchor_id), windows)
            for pos_id, pos_score, chosen in zip(pos_ids, pos_scores, found):
                out["anchor_id"] += [anchor_id] * len(chosen)
                out["positive_id"] += [int(pos_id)] * len(chosen)
                out["positive_score"] += [int(pos_score)] * len(chosen)
                out["negative_id"] += ids[chosen].tolist()
                out["negative_score"] += lists.scores[chosen].tolist()
        return pd.DataFrame(out)

    return walk


def _grouped(anchors: DataFrame, rows: DataFrame, counts: tuple[int, int], function, schema: str) -> DataFrame:
    left, right, _ = vectors.blocked(anchors.sparkSession, anchors, rows, counts)
    return left.groupBy("qblock", "cblock").cogroup(right.groupBy("qblock", "cblock")).applyInPandas(function, schema)


def mined(table: DataFrame, every: int = 100, shift_every: int = 7, positives: int = 5, negatives: int = 10,
          low: int = 30, high: int = 90, by: int = 256) -> DataFrame:
    """Hard negatives of every anchor (``vec_id`` divisible by ``every``) of ``table``.

    ``table`` needs ``vec_id``, ``embedding`` and ``label``. Returns anchor_id, positive_id, rank
    (from 1, per anchor and positive), negative_id, positive_score, negative_score.
    """
    label = F.col("label").cast("long")
    rows = stored(
        table.where(vectors.usable(F.col("embedding")) & label.isNotNull()).select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.when(vectors.divisible(F.col("vec_id"), shift_every), (label + 1) % 10).otherwise(label).alias("label"),
            vectors.scaled(F.col("embedding"), by).alias("v"),
        )
    )
    is_anchor = vectors.divisible(F.col("vec_id"), every)
    counted = rows.agg(F.count("*").alias("n"), F.count(F.when(is_anchor, 1)).alias("q")).first()
    counts = (counted["q"], counted["n"])
    anchors = rows.where(is_anchor)
    best_first = [F.col("positive_score").desc(), F.col("positive_id")]
    found = _grouped(anchors, rows, counts, _positives(positives), _POSITIVES)
    pos = stored(
        found.withColumn("r", F.row_number().over(Window.partitionBy("anchor_id").orderBy(*best_first)))
        .where(F.col("r") <= positives)
        .groupBy("anchor_id")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("positive_id").alias("i"), F.col("positive_score").alias("s")))).alias("p"))
    )
    windows = anchors.alias("a").join(pos.alias("w"), F.col("a.vec_id") == F.col("w.anchor_id")).select(
        F.col("a.vec_id").alias("vec_id"), F.col("a.label").alias("label"), F.col("a.v").alias("v"),
        F.col("w.p.i").alias("pos_ids"), F.col("w.p.s").alias("pos_scores"),
    )
    raw = _grouped(windows, rows, counts, _negatives(negatives, low, high), _NEGATIVES)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), F.col("negative_id"))
    return (
        raw.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
