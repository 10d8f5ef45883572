"""Mean silhouette of labelled points in the plane, with Euclidean distances.

The silhouette of a point needs the sum of its distances to every class. Comparing all
pairs of points is out of the question for large tables. Points are therefore sorted into
the cells of a quadtree. Neighbouring cells, which hold a bounded number of distinct
points each, are compared exactly. Between cells further apart the distance is a smooth
function, so each cell is represented by weights on a Chebyshev grid (the black-box fast
multipole method of Fong and Darve, J. Comput. Phys. 2009). With the grid used here this
agrees with the sum over pairs to about nine digits, for work that grows with the number
of points. Equal points are merged up front, so a crowd of copies costs one point.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covaria.functions import column
from covaria.operators.durable import settle
from covaria.operators.features import matrix
from covaria.operators.moments import MAX_CLASSES

# Distinct points a leaf cell may hold; the tree is deepened until none holds more.
LEAF_POINTS = 256

# Grid points per axis.
GRID = 10

# Up to this many distinct points are compared directly, as one cell.
DIRECT_POINTS = 4096

# Halving the square more often would go below the resolution of double coordinates.
MAX_DEPTH = 48

# Leaves of an ancestor this many levels up are evaluated together, as one group of rows.
BLOCK_LEVELS = 3

# Distances held at once, few enough for a core's cache.
PAIRS = 1 << 15

# Up to this many classes, sums by class are a matrix product.
FEW_CLASSES = 16

# Bits per axis of the sort key that keeps close cells close.
ORDER_BITS = 31

# Grid weights of one class in one cell of one level of the tree.
_VECTOR = "level int, ix long, iy long, c int, vec array<double>"


def _nodes() -> np.ndarray:
    return np.cos((2 * np.arange(GRID) + 1) * np.pi / (2 * GRID))


def _interpolation(at: np.ndarray) -> np.ndarray:
    """Value at ``at`` (in [-1, 1]) of the polynomial that is 1 at each node in turn."""
    degree = np.arange(1, GRID)
    here = np.cos(degree[None, :] * np.arccos(np.clip(at, -1.0, 1.0))[:, None])
    there = np.cos(degree[None, :] * np.arccos(_nodes())[:, None])
    return (1.0 + 2.0 * here @ there.T) / GRID


def _on_grid(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Interpolation weights of points given inside the unit cell, points x GRID**2."""
    x, y = _interpolation(2 * u - 1), _interpolation(2 * v - 1)
    return (x[:, :, None] * y[:, None, :]).reshape(len(u), -1)


def _child_to_parent() -> np.ndarray:
    """For each quadrant (2 * right + upper) the map from child to parent grid weights."""
    half = [_interpolation((_nodes() + side) / 2) for side in (-1, 1)]
    return np.array([np.kron(half[qx].T, half[qy].T) for qx in (0, 1) for qy in (0, 1)])


def _distances(dx: int, dy: int) -> np.ndarray:
    """Grid-to-grid distances of a cell and one ``dx, dy`` away, in cell sides."""
    position = (_nodes() + 1) / 2
    gap = position[:, None] - position[None, :]
    across, along = gap + dx, gap + dy
    size = GRID * GRID
    return np.hypot(across[:, None, :, None], along[None, :, None, :]).reshape(size, size)


def _far_offsets(parity: int) -> list[tuple[int, int]]:
    """Cells not adjacent to a cell whose parents are adjacent to its parent."""
    px, py = parity >> 1, parity & 1
    return [
        (dx, dy)
        for dx in range(-3, 4)
        for dy in range(-3, 4)
        if max(abs(dx), abs(dy)) > 1 and abs((px + dx) >> 1) <= 1 and abs((py + dy) >> 1) <= 1
    ]


@dataclass(frozen=True)
class _Frame:
    """Bounding square of the points and the class sizes."""

    x0: float
    y0: float
    side: float
    n_points: int
    class_rows: np.ndarray

    def cell(self, value: str, origin: float, depth: int) -> Column:
        cells = 2**depth
        index = F.floor((F.col(value) - F.lit(origin)) * F.lit(cells / self.side))
        return F.greatest(F.lit(0), F.least(F.lit(cells - 1), index)).cast("long")


def silhouette(
    points: DataFrame,
    x: str,
    y: str,
    label: str,
    leaf_points: int = LEAF_POINTS,
    direct_points: int = DIRECT_POINTS,
) -> DataFrame:
    """One row ``n_rows, n_classes, silhouette``.

    Rows without a label or coordinates are left out; ``n_rows`` counts the others. A class
    of one row counts 0. With fewer than two classes, or every row its own class, the
    silhouette is NULL. An infinite coordinate is refused, as distances to it mean nothing.
    """
    spark = points.sparkSession
    merged = (
        points.select(column(x).cast("double").alias("x"), column(y).cast("double").alias("y"), column(label).alias("label"))
        .dropna()
        .groupBy("x", "y", "label")
        .agg(F.count(F.lit(1)).alias("w"))
    )
    merged = settle(merged)
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
        return spark.createDataFrame(
            [(int(rows.sum()), len(classes), None)], "n_rows long, n_classes int, silhouette double"
        )
    frame = _frame(classes, rows)
    type_ = merged.schema["label"].dataType.simpleString()
    index = spark.createDataFrame([(r["label"], i) for i, r in enumerate(classes)], f"label {type_}, c int")
    indexed = merged.join(F.broadcast(index), "label").select("x", "y", "c", "w")
    depth = 0 if frame.n_points <= direct_points else _depth(indexed, frame, leaf_points)
    placed = indexed.select(
        frame.cell("x", frame.x0, depth).alias("ix"), frame.cell("y", frame.y0, depth).alias("iy"), "x", "y", "c", "w"
    )
    far = _far_field(placed.withColumn("level", F.lit(depth)), frame, depth) if depth >= 2 else None
    sums = _leaf_sums(placed, far, frame, depth)
    return sums.agg(
        F.lit(int(rows.sum())).cast("long").alias("n_rows"),
        F.lit(len(classes)).alias("n_classes"),
        (F.sum("total") / F.sum("rows")).alias("silhouette"),
    )


def _frame(classes, rows: np.ndarray) -> _Frame:
    x0, y0 = min(r["x0"] for r in classes), min(r["y0"] for r in classes)
    side = max(max(r["x1"] for r in classes) - x0, max(r["y1"] for r in classes) - y0)
    return _Frame(x0, y0, side if side > 0 else 1.0, sum(r["points"] for r in classes), rows)


def _depth(points: DataFrame, frame: _Frame, leaf_points: int) -> int:
    """Smallest depth tried at which no cell holds more than ``leaf_points``."""

    def deeper(n: int) -> int:
        return max(1, ceil(log(n / leaf_points, 4)))

    if frame.n_points <= leaf_points:
        return 0
    depth = deeper(frame.n_points)
    while True:
        cells = points.groupBy(
            frame.cell("x", frame.x0, depth).alias("ix"), frame.cell("y", frame.y0, depth).alias("iy")
        ).count()
        crowd = cells.agg(F.max("count")).first()[0]
        if crowd <= leaf_points or depth >= MAX_DEPTH:
            return depth
        depth = min(MAX_DEPTH, depth + deeper(crowd))


def _z_order() -> Column:
    """Leading bits of both cell numbers interleaved: sorting by it keeps close cells close."""

    def spread(v: Column) -> Column:
        for shift, mask in (
            (16, 0x0000FFFF0000FFFF),
            (8, 0x00FF00FF00FF00FF),
            (4, 0x0F0F0F0F0F0F0F0F),
            (2, 0x3333333333333333),
            (1, 0x5555555555555555),
        ):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    ix, iy = (F.expr(f"shiftright({n}, greatest(level - {ORDER_BITS}, 0))") for n in ("ix", "iy"))
    return F.shiftleft(spread(ix), 1).bitwiseOR(spread(iy))


def _in_z_order(df: DataFrame) -> DataFrame:
    """Range-partitioned and sorted by level and place, so that a batch holds close cells.

    What a batch computes for a cell is then mostly added up before the next shuffle.
    """
    order = [F.col("level"), _z_order()]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def _added(vectors: DataFrame) -> DataFrame:
    """Grid vectors summed per cell and class: rows of a cell meet in a task, sorted, and are added batch by batch."""
    key = ["level", "ix", "iy", "c"]

    def run(batches):
        held = None  # the last cell, which the next batch may continue
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [batch] if held is None else [held, batch]
            keys = [np.concatenate(columns) for columns in zip(*[_columns(part, *key) for part in parts])]
            emitted = _emit(*keys, np.concatenate([matrix(part.column(4), GRID * GRID) for part in parts]))
            held = emitted.slice(emitted.num_rows - 1)
            if emitted.num_rows > 1:
                yield emitted.slice(0, emitted.num_rows - 1)
        if held is not None:
            yield held

    return vectors.select(*key, "vec").repartition(*key[:3]).sortWithinPartitions(*key).mapInArrow(run, _VECTOR)


def _emit(level, ix, iy, c, vectors: np.ndarray) -> pa.RecordBatch:
    """Rows of one batch, those of the same cell and class added up first."""
    order = np.lexsort((c, iy, ix, level))
    keys = [np.asarray(k)[order] for k in (level, ix, iy, c)]
    changes = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    starts = np.concatenate([[0], np.flatnonzero(changes) + 1])
    sums = np.add.reduceat(vectors[order], starts, axis=0)
    offsets = np.arange(0, sums.size + 1, sums.shape[1], dtype=np.int32)
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            *[pa.array(k[starts], t) for k, t in zip(keys, types)],
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(sums.ravel())),
        ],
        names=["level", "ix", "iy", "c", "vec"],
    )


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]


def _far_field(placed: DataFrame, frame: _Frame, depth: int) -> DataFrame:
    """``ix, iy, c, vec``: on the grid of each leaf, distances to all far points of class c."""
    vectors = settle(_added(_in_z_order(placed).mapInArrow(_tree_weights(frame, depth), _VECTOR)))
    cells = vectors.select("level", "ix", "iy").distinct()
    exchanged = settle(_added(_exchange(vectors, cells, frame)))
    local = None
    for level in range(2, depth + 1):
        at_level = exchanged.where(F.col("level") == level)
        if local is not None:
            parent = local.select(F.col("ix").alias("px"), F.col("iy").alias("py"), "c", "vec")
            inherited = cells.where(F.col("level") == level).join(
                parent,
                (F.shiftright("ix", 1) == F.col("px")) & (F.shiftright("iy", 1) == F.col("py")),
            )
            inherited = inherited.select("level", "ix", "iy", "c", "vec").mapInArrow(_from_parent, _VECTOR)
            at_level = _added(at_level.unionByName(inherited))
        local = at_level
    return local.select("ix", "iy", "c", "vec")


def _tree_weights(frame: _Frame, depth: int):
    """Grid weights of every cell from level 2 to the leaves, of one depth, as ``_upward`` adds them up."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                ix, iy, x, y, c, w = _columns(batch, "ix", "iy", "x", "y", "c", "w")
                yield from _upward(frame, np.full(len(ix), depth), ix, iy, x, y, c, w)

    return run


def _upward(frame: _Frame, leaf, ix, iy, x, y, c, w):
    """Grid weights of all cells of level 2 and deeper that hold the points given with their leaves.

    Only leaves are computed from points; a cell's weights are its children's, taken to its
    grid, which is exact: the polynomials of a cell are polynomials on its children too.
    """
    up = np.swapaxes(_child_to_parent(), 1, 2)
    below = None  # cells of the level below: ix, iy, c, weights
    for level in range(int(leaf.max()), 1, -1):
        at = leaf == level
        scale = 2.0**level / frame.side
        parts = []
        if at.any():
            grid = _on_grid((x[at] - frame.x0) * scale - ix[at], (y[at] - frame.y0) * scale - iy[at])
            grid *= w[at, None]
            parts.append((ix[at], iy[at], c[at], grid))
        if below is not None:
            bx, by, bc, vec = below
            quadrant = 2 * (bx & 1) + (by & 1)
            moved = np.empty_like(vec)
            for q in range(4):
                moved[quadrant == q] = vec[quadrant == q] @ up[q]
            parts.append((bx >> 1, by >> 1, bc, moved))
        if not parts:
            continue
        lx, ly, lc, vectors = parts[0] if len(parts) == 1 else [np.concatenate(p) for p in zip(*parts)]
        emitted = _emit(np.full(len(lx), level), lx, ly, lc, vectors)
        yield emitted
        below = (*_columns(emitted, "ix", "iy", "c"), matrix(emitted.column(4), GRID * GRID))


def _from_parent(batches):
    """A parent's values interpolated to the grid of each child."""
    down = _child_to_parent()
    for batch in batches:
        if not batch.num_rows:
            continue
        level, ix, iy, c = _columns(batch, "level", "ix", "iy", "c")
        vec = matrix(batch.column(4), GRID * GRID)
        quadrant = 2 * (ix & 1) + (iy & 1)
        moved = np.empty_like(vec)
        for q in range(4):
            moved[quadrant == q] = vec[quadrant == q] @ down[q]
        yield _emit(level, ix, iy, c, moved)


def _exchange(vectors: DataFrame, cells: DataFrame, frame: _Frame) -> DataFrame:
    """What each cell's far neighbours of the same level add to its grid, all levels at once.

    Which of the at most 27 neighbours exist is settled on cell numbers alone; the grid
    vectors are then joined once.
    """
    by_parity = F.array(
        *[
            F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in _far_offsets(parity)])
            for parity in range(4)
        ]
    )
    parity = (2 * F.col("ix").bitwiseAND(1) + F.col("iy").bitwiseAND(1)).cast("int")
    reach = cells.select("level", "ix", "iy", F.explode(F.get(by_parity, parity)).alias("to"))
    target = cells.select(F.col("level").alias("tl"), F.col("ix").alias("tx"), F.col("iy").alias("ty"))
    existing = (
        reach.join(
            target,
            (F.col("level") == F.col("tl"))
            & (F.col("ix") + F.col("to.dx") == F.col("tx"))
            & (F.col("iy") + F.col("to.dy") == F.col("ty")),
            "left_semi",
        )
        .groupBy("level", "ix", "iy")
        .agg(F.collect_set(F.col("to.dx") * 8 + F.col("to.dy")).alias("to"))
    )
    side, size = frame.side, GRID * GRID

    def run(batches):
        kernels: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            level, ix, iy, c = _columns(batch, "level", "ix", "iy", "c")
            vec = matrix(batch.column(4), size) * (side / 2.0**level)[:, None]
            to = batch.column(5)
            source = np.repeat(np.arange(batch.num_rows), np.diff(to.offsets.to_numpy()))
            codes = to.flatten().to_numpy(zero_copy_only=False)
            moved = np.empty((len(codes), size))
            dx, dy = np.empty(len(codes), np.int64), np.empty(len(codes), np.int64)
            for code in np.unique(codes):
                at = codes == code
                sx = (int(code) + 3) // 8
                sy = int(code) - 8 * sx
                if code not in kernels:
                    kernels[code] = _distances(sx, sy)
                moved[at] = vec[source[at]] @ kernels[code].T
                dx[at], dy[at] = sx, sy
            yield _emit(level[source], ix[source] + dx, iy[source] + dy, c[source], moved)

    joined = vectors.join(existing, ["level", "ix", "iy"])
    ordered = _in_z_order(joined.select("level", "ix", "iy", "c", "vec", "to"))
    # A row turns into up to 27; smaller batches keep that within a task's memory.
    return ordered.mapInArrow(_small_batches(run), _VECTOR)


def _small_batches(run, rows: int = 1024):
    def sliced(batches):
        return run(b.slice(i, rows) for b in batches for i in range(0, b.num_rows, rows))

    return sliced


def _block_levels(classes: int) -> int:
    """Levels between leaves and the block evaluated as one group.

    Fewer with many classes, so that the grid vectors of a block's leaves stay within 32 MB.
    """
    return max(0, min(BLOCK_LEVELS, int(log(32 * 2**20 / (8 * GRID * GRID * classes), 4))))


def _block(level: str, ix: str, iy: str, levels: int) -> list[Column]:
    """``bl, bx, by``: the ancestor of a cell so many levels above, or the root."""
    rise = f"least({level}, {levels})"
    return [
        F.expr(f"cast({level} - {rise} as int)").alias("bl"),
        F.expr(f"shiftright({ix}, {rise})").alias("bx"),
        F.expr(f"shiftright({iy}, {rise})").alias("by"),
    ]


def _leaf_sums(placed: DataFrame, far: DataFrame | None, frame: _Frame, depth: int) -> DataFrame:
    """``total, rows``: summed silhouettes and row counts, one row per block of leaves.

    A leaf, whose few points travel as one row, goes to its own block and to those it touches.
    """
    levels = min(_block_levels(len(frame.class_rows)), depth)
    last = (2**depth - 1) >> levels
    packed = placed.groupBy(F.col("ix").alias("sx"), F.col("iy").alias("sy")).agg(
        F.collect_list(F.struct("x", "y", "c", "w")).alias("points")
    )

    def reached(place: str) -> Column:
        low, high = (F.shiftright(F.col(place) + F.lit(side), levels) for side in (-1, 1))
        return F.explode(F.sequence(F.greatest(F.lit(0).cast("long"), low), F.least(F.lit(last).cast("long"), high)))

    near = (
        packed.withColumn("bx", reached("sx"))
        .withColumn("by", reached("sy"))
        .select(
            F.lit(depth - levels).alias("bl"), "bx", "by", F.lit(depth).alias("sl"), "sx", "sy", "points",
            ((F.shiftright("sx", levels) == F.col("bx")) & (F.shiftright("sy", levels) == F.col("by"))).alias("own"),
        )
    )
    if far is not None:
        far = _grids(far.select(
            F.lit(depth).alias("tl"), F.col("ix").alias("tx"), F.col("iy").alias("ty"), F.col("c").alias("fc"), "vec"
        ), levels)
    return _block_sums(near, far, frame)


def _grids(vectors: DataFrame, levels: int) -> DataFrame:
    """Grid vectors for the blocks of the targets ``tl, tx, ty``.

    They hold values on the target's own grid, unless ``fl, fx, fy`` name the cell whose points
    they stand for.
    """
    types = {"fl": "int", "fx": "long", "fy": "long"}
    cell = [F.col(n) if n in vectors.columns else F.lit(None).cast(t).alias(n) for n, t in types.items()]
    return vectors.select(*_block("tl", "tx", "ty", levels), "tl", "tx", "ty", *cell, "fc", "vec")


def _touching(tl, tx, ty, level, ix, iy) -> np.ndarray:
    """Which cells touch the target, at the finer of the two levels; a coarser one its ancestor."""
    up, down = np.maximum(tl - level, 0), np.maximum(level - tl, 0)
    ax, ay = tx >> up, ty >> up
    return (
        (ix >= (ax << down) - 1) & (ix <= (ax + 1) << down) & (iy >= (ay << down) - 1) & (iy <= (ay + 1) << down)
    )


def _block_sums(near: DataFrame, grids: DataFrame | None, frame: _Frame) -> DataFrame:
    """``total, rows`` per block: silhouettes of its leaves' points summed, and their row count.

    ``near`` has the points of the block's own leaves and of all leaves that touch one. Each
    leaf is compared with those that touch it; grid vectors stand for everything further away.
    """
    # Lengths in units of a power of two near the side, so that no square overflows.
    unit = -int(np.frexp(frame.side)[1])
    x0, y0, side = (float(np.ldexp(v, unit)) for v in (frame.x0, frame.y0, frame.side))
    class_rows = frame.class_rows
    k = len(class_rows)
    position = (_nodes() + 1) / 2
    gx, gy = np.repeat(position, GRID), np.tile(position, GRID)

    def exact(x, y, sx, sy, sw, codes, classes):
        """Distances to the sources, summed by class (``codes`` from 0)."""
        sums = np.empty((len(x), classes))
        if classes <= FEW_CLASSES:
            by_class = np.zeros((len(sx), classes))
            by_class[np.arange(len(sx)), codes] = sw
        else:
            order = np.argsort(codes, kind="stable")
            sx, sy, sw = sx[order], sy[order], sw[order]
            starts = np.searchsorted(codes[order], np.arange(classes))
        rows = max(1, PAIRS // len(sx))
        for start in range(0, len(x), rows):
            part = slice(start, start + rows)
            away, across = x[part, None] - sx, y[part, None] - sy
            away *= away
            across *= across
            away += across
            np.sqrt(away, out=away)
            if classes <= FEW_CLASSES:
                sums[part] = away @ by_class
            else:
                away *= sw
                sums[part] = np.add.reduceat(away, starts, axis=1)
        return sums

    def apart(x, y, fl, fx, fy, fc, vec, sums):
        """Add distances to the points of other cells, through their grids."""
        order = np.lexsort((fy, fx, fl))
        fl, fx, fy, fc, vec = fl[order], fx[order], fy[order], fc[order], vec[order]
        new = (np.diff(fl) != 0) | (np.diff(fx) != 0) | (np.diff(fy) != 0)
        starts = np.concatenate([[0], np.flatnonzero(new) + 1, [len(fl)]])
        size = side / 2.0 ** fl[starts[:-1]].astype(np.float64)
        for i, (begin, end) in enumerate(zip(starts[:-1], starts[1:])):
            nx, ny = x0 + (fx[begin] + gx) * size[i], y0 + (fy[begin] + gy) * size[i]
            away = np.sqrt((x[:, None] - nx) ** 2 + (y[:, None] - ny) ** 2)
            sums[:, fc[begin:end]] += away @ vec[begin:end].T

    def block(near: pa.Table, grids: pa.Table | None) -> pa.Table:
        own = np.flatnonzero(near.column("own").to_numpy()) if near.num_rows else []
        if not len(own):
            return pa.table({"total": pa.array([], pa.float64()), "rows": pa.array([], pa.int64())})
        level, ix, iy = (near.column(n).to_numpy().astype(np.int64) for n in ("sl", "sx", "sy"))
        points = near.column("points").combine_chunks()
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(points).to_numpy())])
        x, y, c, w = (points.flatten().field(n).to_numpy(zero_copy_only=False) for n in ("x", "y", "c", "w"))
        x, y, weight = np.ldexp(x, unit), np.ldexp(y, unit), w.astype(np.float64)
        owner = np.zeros(0, np.int64)
        if grids is not None and grids.num_rows:
            place = {(level[t], ix[t], iy[t]): n for n, t in enumerate(own)}
            names = zip(*[grids.column(n).to_numpy() for n in ("tl", "tx", "ty")])
            owner = np.array([place[name] for name in names])
            order = np.argsort(owner, kind="stable")
            owner = owner[order]
            # Values on the target's grid are distances, the others weights.
            here = pc.is_null(grids.column("fl")).to_numpy()
            vec = np.ldexp(matrix(grids.column("vec"), GRID * GRID), np.where(here, unit, 0)[:, None])
            fl, fx, fy, fc = (grids.column(n).fill_null(0).to_numpy() for n in ("fl", "fx", "fy", "fc"))
        total, rows = 0.0, 0
        for n, t in enumerate(own):
            mine = slice(bounds[t], bounds[t + 1])
            tx, ty, tc, tw = x[mine], y[mine], c[mine], w[mine]
            beside = np.flatnonzero(_touching(level[t], ix[t], iy[t], level, ix, iy))
            at = np.concatenate([np.arange(bounds[s], bounds[s + 1]) for s in beside])
            present, codes = np.unique(c[at], return_inverse=True)
            sums = np.zeros((len(tx), k))
            sums[:, present] = exact(tx, ty, x[at], y[at], weight[at], codes, len(present))
            mail = order[slice(*np.searchsorted(owner, [n, n + 1]))] if len(owner) else owner
            if len(mail):
                values, cells = mail[here[mail]], mail[~here[mail]]
                if len(values):
                    scale = 2.0 ** level[t] / side
                    grid = _on_grid((tx - x0) * scale - ix[t], (ty - y0) * scale - iy[t])
                    sums[:, fc[values]] += grid @ vec[values].T
                if len(cells):
                    apart(tx, ty, fl[cells], fx[cells], fy[cells], fc[cells], vec[cells], sums)
            total += _silhouettes(sums, tc, class_rows) @ tw
            rows += int(tw.sum())
        return pa.table({"total": [float(total)], "rows": [rows]})

    key, schema = ["bl", "bx", "by"], "total double, rows long"
    if grids is None:
        return near.groupBy(*key).applyInArrow(lambda table: block(table, None), schema)
    return near.groupBy(*key).cogroup(grids.groupBy(*key)).applyInArrow(lambda a, b: block(a, b), schema)


def _silhouettes(sums: np.ndarray, c: np.ndarray, class_rows: np.ndarray) -> np.ndarray:
    """Silhouettes of points of classes ``c`` from their summed distances to every class."""
    own = np.arange(len(c)), c
    inside = sums[own] / np.maximum(class_rows[c] - 1, 1)
    means = sums / class_rows
    means[own] = np.inf
    outside = means.min(axis=1)
    larger = np.maximum(inside, outside)
    return np.where((class_rows[c] > 1) & (larger > 0), (outside - inside) / np.where(larger > 0, larger, 1.0), 0.0)
