"""Mean silhouette estimated from anchors drawn per class, with a confidence interval.

An opt-in mode for tables where even the tree is too much: it is never chosen by size. Per
class, the ``per_class`` distinct points of smallest hash (of the point, its label and
``seed``) are the anchors, so a draw is the same on every run and every layout. Each anchor's
silhouette is exact: every task adds up, for all anchors at once, the distances from its share
of the points to the anchors per class, and these small sums are added over tasks.

The estimate is stratified by class. Within a class, anchors stand for distinct points and
carry their number of rows as weight, so the class mean is a ratio estimate; its variance is
the linearised one with the finite-population factor, and a class drawn whole adds none. The
interval is the estimate plus or minus ``z`` standard errors. ``approximate`` is false when
every class was drawn whole; the estimate then equals the exact silhouette.

Anchors and their sums are bounded by ``per_class`` times the number of classes
(``MAX_CLASSES`` at most), which is what reaches the driver and every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covaria.functions import column
from covaria.operators.durable import stored
from covaria.operators.moments import MAX_CLASSES

RESULT = "n_rows long, n_classes int, anchors long, silhouette double, low double, high double, approximate boolean"


def _distance_sums(merged: DataFrame, anchors: np.ndarray, k: int) -> np.ndarray:
    """anchors x classes: weighted distances from every anchor to all points of each class."""
    ax, ay = anchors[:, 0], anchors[:, 1]
    n = len(anchors)

    def run(batches):
        sums = np.zeros((n, k))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, c, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            step = max(1, 4_000_000 // max(n, 1))
            for start in range(0, len(x), step):
                part = slice(start, start + step)
                d = np.hypot(ax[:, None] - x[None, part], ay[:, None] - y[None, part]) * w[None, part]
                for cls in np.unique(c[part]):
                    sums[:, cls] += d[:, c[part] == cls].sum(axis=1)
        a, cls = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int32()), pa.array(cls, pa.int32()), pa.array(sums[a, cls])], names=["a", "c", "s"]
        )

    found = (
        merged.select("x", "y", "c", "w").mapInArrow(run, "a int, c int, s double")
        .groupBy("a", "c").agg(F.sum("s").alias("s")).collect()
    )
    out = np.zeros((n, k))
    for r in found:
        out[r["a"], r["c"]] = r["s"]
    return out


def silhouette_sampled(points: DataFrame, x: str, y: str, label: str, per_class: int = 1000, seed: int = 0,
                       z: float = 1.96) -> DataFrame:
    """One row ``n_rows, n_classes, anchors, silhouette, low, high, approximate``.

    Rows without a label or coordinates are left out; a class of one row counts 0; with fewer
    than two classes, or every row its own class, the silhouette and its bounds are NULL.
    """
    spark = points.sparkSession
    merged = stored(
        points.select(column(x).cast("double").alias("x"), column(y).cast("double").alias("y"), column(label).alias("label"))
        .dropna()
        .groupBy("x", "y", "label")
        .agg(F.count(F.lit(1)).alias("w"))
    )
    classes = merged.groupBy("label").agg(F.sum("w").alias("rows"), F.count(F.lit(1)).alias("points")).limit(
        MAX_CLASSES + 1
    ).collect()
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"label {label!r} has more than {MAX_CLASSES} distinct values")
    classes.sort(key=lambda r: r["label"])
    rows = np.array([r["rows"] for r in classes], dtype=np.float64)
    total = int(rows.sum())
    if len(classes) < 2 or len(classes) == total:
        return spark.createDataFrame([(total, len(classes), 0, None, None, None, False)], RESULT)
    type_ = merged.schema["label"].dataType.simpleString()
    index = spark.createDataFrame([(r["label"], i) for i, r in enumerate(classes)], f"label {type_}, c int")
    indexed = stored(merged.join(F.broadcast(index), "label").select("x", "y", "c", "w"))
    draw = Window.partitionBy("c").orderBy(F.xxhash64("x", "y", "c", F.lit(seed)), "x", "y")
    drawn = indexed.withColumn("r", F.row_number().over(draw)).where(F.col("r") <= per_class).collect()
    anchors = np.array([(r["x"], r["y"]) for r in drawn], dtype=np.float64).reshape(-1, 2)
    cls = np.array([r["c"] for r in drawn], dtype=np.int64)
    weight = np.array([r["w"] for r in drawn], dtype=np.float64)
    sums = _distance_sums(indexed, anchors, len(classes))
    own = np.arange(len(cls)), cls
    inside = sums[own] / np.maximum(rows[cls] - 1, 1)
    means = sums / rows
    means[own] = np.inf
    outside = means.min(axis=1)
    larger = np.maximum(inside, outside)
    s = np.where((rows[cls] > 1) & (larger > 0), (outside - inside) / np.where(larger > 0, larger, 1.0), 0.0)
    estimate, variance, partial = 0.0, 0.0, False
    for c, r in enumerate(classes):
        mine = cls == c
        n_c, w_c, s_c = int(mine.sum()), weight[mine], s[mine]
        mean = float(w_c @ s_c / w_c.sum())
        estimate += rows[c] / total * mean
        if n_c < r["points"]:
            partial = True
            spread = float(((w_c * (s_c - mean)) ** 2).sum() / w_c.sum() ** 2) * n_c / max(n_c - 1, 1)
            variance += (rows[c] / total) ** 2 * (1 - n_c / r["points"]) * spread
    estimate, half = float(estimate), float(z * variance**0.5)
    return spark.createDataFrame(
        [(total, len(classes), len(cls), estimate, estimate - half, estimate + half, partial)], RESULT
    )
