"""Mean silhouette on an adaptive quadtree: each leaf has its own depth.

``silhouette.silhouette`` deepens the whole tree until its most crowded cell is small enough,
so one dense spot makes every part of the plane that deep. Here a cell is split only while it
holds more than ``leaf_points`` distinct points, so leaves of sparse parts stay shallow and a
dense spot goes deep on its own.

Distances are summed per point and class by a tree code over that tree:

* each cell of level 2 or deeper carries interpolation weights of its points per class on a
  Chebyshev grid (as in ``silhouette``), the leaves' from points, the others' from children;
* cells of one level that are not adjacent, but whose parents are, exchange weights for values
  on each other's grids, and values are handed down to the leaves, level by level;
* from each leaf the cells beside it are walked down, a level a round. Leaves that touch each
  other (the coarser one the finer one's ancestor) go to near lists; a finer cell that does not
  touch the leaf, though its parent does, is set apart from it;
* leaves are evaluated in blocks of those with the same ancestor ``BLOCK_LEVELS`` up, so that
  neighbours share the points around them. A leaf's points meet the points of its near list
  exactly, the values on its own grid, and the cells set apart by their distances to grid points.
  Such a cell lies at least its own side away, which is what its interpolation needs.

Equal points are merged up front. Work grows with the number of points times the depth, and a
target's lists hold a bounded number of cells per level where the points do not crowd along a
leaf's border.
"""

from __future__ import annotations

from math import ceil, log

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covaria.functions import column
from covaria.operators.durable import stored
from covaria.operators.moments import MAX_CLASSES
from covaria.operators.silhouette import (
    _added,
    _block,
    _block_levels,
    _block_sums,
    _columns,
    _exchange,
    _frame,
    _from_parent,
    _grids,
    _in_z_order,
    _upward,
)

LEAF_POINTS = 256
# Levels between leaves and the block evaluated as one group; finer leaves crowd around it.
BLOCK_LEVELS = 2
# Halving the square more often would go below the resolution of double coordinates.
MAX_DEPTH = 48
_VECTOR = "level int, ix long, iy long, c int, vec array<double>"


def _cell(frame, value: str, origin: float, level: int) -> F.Column:
    cells = 2**level
    index = F.floor((F.col(value) - F.lit(origin)) * F.lit(cells / frame.side)).cast("long")
    return F.greatest(F.lit(0).cast("long"), F.least(F.lit(cells - 1).cast("long"), index))


def _leaves(points: DataFrame, frame, leaf_points: int) -> tuple[DataFrame, DataFrame]:
    """Points with their leaf (level, ix, iy); cells of all levels with a flag ``leaf``.

    A round settles as many levels as evenly spread points would need: points are counted in
    the cells of the lowest, and the counts of the others are added up from those.
    """
    remaining, placed, cells, top, crowd = points, [], [], 0, frame.n_points
    while True:
        bottom = min(MAX_DEPTH, top + max(0, ceil(log(crowd / leaf_points, 4))))
        here = remaining.select(
            "x", "y", "c", "w",
            _cell(frame, "x", frame.x0, bottom).alias("bx"), _cell(frame, "y", frame.y0, bottom).alias("by"),
        )
        lowest = stored(here.groupBy("bx", "by").agg(F.count(F.lit(1)).alias("n")))
        above = lowest.select("bx", "by", "n", F.explode(F.sequence(F.lit(top), F.lit(bottom))).alias("level")).select(
            "bx", "by", "n", "level",
            F.expr(f"shiftright(bx, {bottom} - level)").alias("ix"), F.expr(f"shiftright(by, {bottom} - level)").alias("iy"),
        )
        sized = stored(above.groupBy("level", "ix", "iy").agg(F.sum("n").alias("n")))
        split = sized.where(F.col("n") > leaf_points).select(
            (F.col("level") + 1).alias("level"), F.col("ix").alias("px"), F.col("iy").alias("py")
        )
        under = sized.select("*", F.shiftright("ix", 1).alias("px"), F.shiftright("iy", 1).alias("py")).join(
            split, ["level", "px", "py"], "left_semi"
        )
        found = sized.where(F.col("level") == top).unionByName(under.where(F.col("level") > top).select(sized.columns))
        leaf = (F.col("n") <= leaf_points) | (F.col("level") == MAX_DEPTH)
        found = stored(found.select("level", "ix", "iy", "n", leaf.alias("leaf")))
        cells.append(found.select("level", "ix", "iy", "leaf"))
        home = above.select("bx", "by", "level", "ix", "iy").join(
            found.where("leaf").select("level", "ix", "iy"), ["level", "ix", "iy"]
        )
        crowd = found.where(~F.col("leaf") & (F.col("level") == bottom)).agg(F.max("n")).first()[0]
        placed.append(here.join(home, ["bx", "by"]).select("x", "y", "c", "w", "level", "ix", "iy"))
        if crowd is None:
            break
        left = found.where(~F.col("leaf") & (F.col("level") == bottom)).select(F.col("ix").alias("bx"), F.col("iy").alias("by"))
        remaining = stored(here.join(left, ["bx", "by"], "left_semi").select("x", "y", "c", "w"))
        top = bottom + 1
    return stored(_union(placed)), stored(_union(cells))


def _weights(placed: DataFrame, frame) -> DataFrame:
    """Grid weights per cell of level 2 and deeper and class, from the points below it."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from _upward(frame, *_columns(batch, "level", "ix", "iy", "x", "y", "c", "w"))

    return stored(_added(_in_z_order(placed).mapInArrow(run, _VECTOR)))


def _adjacent() -> F.Column:
    """Whether cell (sl, sx, sy) touches target (tl, tx, ty) at the finer of the two levels.

    A coarser cell is compared with the target's ancestor at its level, a finer one with the
    block of cells the target covers at its level.
    """
    return F.expr(
        """
        sx >= shiftleft(shiftright(tx, greatest(tl - sl, 0)), greatest(sl - tl, 0)) - 1
        AND sx <= shiftleft(shiftright(tx, greatest(tl - sl, 0)) + 1, greatest(sl - tl, 0))
        AND sy >= shiftleft(shiftright(ty, greatest(tl - sl, 0)), greatest(sl - tl, 0)) - 1
        AND sy <= shiftleft(shiftright(ty, greatest(tl - sl, 0)) + 1, greatest(sl - tl, 0))
        """
    )


def _lists(cells: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(target, leaf) pairs of the near lists; (target, cell) pairs of finer cells set apart.

    From each leaf the cells beside it, of its own level, are walked down. Leaves among them
    are near. Of finer cells, those that touch the leaf are walked on or near; those that do
    not, below one that does, are set apart from it. To a finer leaf, the leaf that the walk
    started from is near in any case: it touches the finer one's ancestor of its level.
    """
    side = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    beside = (
        cells.where("leaf")
        .select(F.col("level").alias("tl"), F.col("ix").alias("tx"), F.col("iy").alias("ty"))
        .withColumn("dx", side)
        .withColumn("dy", side)
        .select("tl", "tx", "ty", (F.col("tx") + F.col("dx")).alias("px"), (F.col("ty") + F.col("dy")).alias("py"))
    )
    every = cells.select(F.col("level").alias("sl"), F.col("ix").alias("sx"), F.col("iy").alias("sy"), "leaf")
    pair = ["tl", "tx", "ty", "sl", "sx", "sy"]
    opened = beside.join(
        every, (F.col("sl") == F.col("tl")) & (F.col("sx") == F.col("px")) & (F.col("sy") == F.col("py"))
    ).select(*pair, "leaf", F.lit(True).alias("above"), F.lit(True).alias("touching"))
    near, apart = [], []
    while True:
        step = stored(opened)
        near.append(step.where("leaf AND touching").select(*pair))
        if apart or len(near) > 1:
            near.append(step.where("leaf").select(*[F.col(a).alias(b) for a, b in zip(pair[3:] + pair[:3], pair)]))
            apart.append(step.where("above AND NOT touching").select(*pair))
        inner = step.where(~F.col("leaf")).select(
            "tl", "tx", "ty", F.col("sl").alias("pl"), F.col("sx").alias("px"), F.col("sy").alias("py"), F.col("touching").alias("above")
        )
        if not inner.limit(1).count():
            break
        opened = inner.join(
            every,
            (F.col("sl") == F.col("pl") + 1)
            & (F.shiftright("sx", 1) == F.col("px"))
            & (F.shiftright("sy", 1) == F.col("py")),
        ).select(*pair, "leaf", "above", (F.col("above") & _adjacent()).alias("touching"))
    return stored(_union(near)), stored(_union(apart)) if apart else None


def _far_values(weights: DataFrame, cells: DataFrame, frame) -> DataFrame | None:
    """``tl, tx, ty, fc, vec``: on each leaf's grid, distances to the cells that its ancestors,
    or itself, find not adjacent at their own level; handed down from level to level."""
    depth = cells.agg(F.max("level")).first()[0]
    if depth < 2:
        return None
    known = cells.where(F.col("level") >= 2).select("level", "ix", "iy")
    exchanged = stored(_added(_exchange(weights, known, frame)))
    local, found = None, []
    for level in range(2, depth + 1):
        at_level = exchanged.where(F.col("level") == level)
        here = cells.where(F.col("level") == level)
        if local is not None:
            parent = local.select(F.col("ix").alias("px"), F.col("iy").alias("py"), "c", "vec")
            inherited = here.join(
                parent, (F.shiftright("ix", 1) == F.col("px")) & (F.shiftright("iy", 1) == F.col("py"))
            )
            inherited = inherited.select("level", "ix", "iy", "c", "vec").mapInArrow(_from_parent, _VECTOR)
            at_level = _added(at_level.unionByName(inherited))
        local = stored(at_level)
        found.append(local)
    leaves = cells.where("leaf").select("level", "ix", "iy")
    return _union(found).join(leaves, ["level", "ix", "iy"], "left_semi").select(
        F.col("level").alias("tl"), F.col("ix").alias("tx"), F.col("iy").alias("ty"), F.col("c").alias("fc"), "vec"
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _sums(placed: DataFrame, near: DataFrame, apart: DataFrame | None, far: DataFrame | None, weights: DataFrame, frame) -> DataFrame:
    """``total, rows`` per block of leaves: silhouettes of its points summed, and its row count."""
    levels = min(BLOCK_LEVELS, _block_levels(len(frame.class_rows)))
    packed = placed.groupBy(F.col("level").alias("sl"), F.col("ix").alias("sx"), F.col("iy").alias("sy")).agg(
        F.collect_list(F.struct("x", "y", "c", "w")).alias("points")
    )
    wanted = near.select(*_block("tl", "tx", "ty", levels), "sl", "sx", "sy").distinct()
    own = F.lit(True)
    for name, place in zip(("bl", "bx", "by"), _block("sl", "sx", "sy", levels)):
        own = own & (F.col(name) == place)
    sources = wanted.join(packed, ["sl", "sx", "sy"]).select("bl", "bx", "by", "sl", "sx", "sy", "points", own.alias("own"))
    grids = None if far is None else _grids(far, levels)
    if apart is not None:
        cell = [F.col("level").alias("sl"), F.col("ix").alias("sx"), F.col("iy").alias("sy")]
        vectors = apart.join(weights.select(*cell, F.col("c").alias("fc"), "vec"), ["sl", "sx", "sy"]).select(
            "tl", "tx", "ty", F.col("sl").cast("int").alias("fl"), F.col("sx").alias("fx"), F.col("sy").alias("fy"), "fc", "vec"
        )
        vectors = _grids(vectors, levels)
        grids = vectors if grids is None else grids.unionByName(vectors)
    return _block_sums(sources, grids, frame)


def silhouette_adaptive(points: DataFrame, x: str, y: str, label: str, leaf_points: int = LEAF_POINTS) -> DataFrame:
    """One row ``n_rows, n_classes, silhouette``, as ``silhouette.silhouette`` defines them.

    Rows without a label or coordinates are left out; a class of one row counts 0; with fewer
    than two classes, or every row its own class, the silhouette is NULL; infinite coordinates
    are refused.
    """
    spark = points.sparkSession
    merged = stored(
        points.select(column(x).cast("double").alias("x"), column(y).cast("double").alias("y"), column(label).alias("label"))
        .dropna()
        .groupBy("x", "y", "label")
        .agg(F.count(F.lit(1)).alias("w"))
    )
    classes = merged.groupBy("label").agg(
        F.sum("w").alias("rows"), F.count(F.lit(1)).alias("points"),
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
    ).limit(MAX_CLASSES + 1).collect()
    if any(np.isinf([r["x0"], r["x1"], r["y0"], r["y1"]]).any() for r in classes):
        raise ValueError("infinite coordinates have no silhouette")
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"label {label!r} has more than {MAX_CLASSES} distinct values")
    classes.sort(key=lambda r: r["label"])
    rows = np.array([r["rows"] for r in classes], dtype=np.float64)
    if len(classes) < 2 or len(classes) == rows.sum():
        return spark.createDataFrame([(int(rows.sum()), len(classes), None)], "n_rows long, n_classes int, silhouette double")
    frame = _frame(classes, rows)
    type_ = merged.schema["label"].dataType.simpleString()
    index = spark.createDataFrame([(r["label"], i) for i, r in enumerate(classes)], f"label {type_}, c int")
    indexed = merged.join(F.broadcast(index), "label").select("x", "y", "c", "w")
    placed, cells = _leaves(indexed, frame, leaf_points)
    weights = _weights(placed, frame)
    near, apart = _lists(cells)
    sums = _sums(placed, near, apart, _far_values(weights, cells, frame), weights, frame)
    return sums.agg(
        F.lit(int(rows.sum())).cast("long").alias("n_rows"),
        F.lit(len(classes)).alias("n_classes"),
        (F.sum("total") / F.sum("rows")).alias("silhouette"),
    )
