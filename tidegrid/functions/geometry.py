"""Geometry as column expressions. A ring is a closed ``array<struct<x,y>>``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegrid.plans.ship import ship


def point(x: Column | float, y: Column | float) -> Column:
    as_double = lambda v: (F.lit(v) if isinstance(v, (int, float)) else v).cast("double")
    return F.struct(as_double(x).alias("x"), as_double(y).alias("y"))


def unwrapped(x: Column, x0: Column) -> Column:
    """Longitude ``x`` on the side of the date line where ``x0`` is."""
    return F.when(F.abs(x - x0) > 270, x - 360 * F.signum(x - x0)).otherwise(x)


def ring_box(ring: Column) -> list[Column]:
    """West, east, south and north of a ring."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return [F.array_min(xs).alias("west"), F.array_max(xs).alias("east"), F.array_min(ys).alias("south"), F.array_max(ys).alias("north")]


def upright(ring: Column) -> Column:
    """True for a ring that is a rectangle along the axes, which holds what its box holds."""
    x, y = ([F.get(ring, F.lit(i))[v] for i in range(5)] for v in "xy")
    closed = (F.size(ring) == 5) & (x[0] == x[4]) & (y[0] == y[4]) & ~F.isnan(x[0] + x[2]) & ~F.isnan(y[0] + y[2])
    ways = [(a[0] == a[1]) & (b[1] == b[2]) & (a[2] == a[3]) & (b[3] == b[0]) for a, b in ((x, y), (y, x))]
    return F.coalesce(closed & (ways[0] | ways[1]), F.lit(False))


def inside(ring: Column, x: Column, y: Column) -> Column:
    """True if the point lies in the ring or on its edge (even-odd rule, no division).

    The ring is walked through as an array, not by index: where it is an expression it is not computed again for every edge.
    """

    def step(state: Column, b: Column) -> Column:
        a = state["at"]
        cross = (b["x"] - a["x"]) * (y - a["y"]) - (x - a["x"]) * (b["y"] - a["y"])
        on = (cross == 0) & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))
        crossed = ((a["y"] > y) != (b["y"] > y)) & ((cross > 0) == (b["y"] > a["y"]))
        return F.struct(b.alias("at"), (state["on"] | on).alias("on"), (state["odd"] != crossed).alias("odd"))

    start = F.struct(F.get(ring, F.lit(0)).alias("at"), F.lit(False).alias("on"), F.lit(False).alias("odd"))
    return F.aggregate(F.slice(ring, 2, F.size(ring)), start, step, lambda s: s["on"] | s["odd"])


def held_points(rings: pa.ListArray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """:func:`inside` for a batch: row ``i`` of ``x`` and ``y`` are points, true where they lie in ring ``i`` or on its edge."""
    points = np.nan_to_num(rings.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    ends = np.cumsum(points) - points
    flat = rings.flatten()
    vx, vy = (flat.field(v).to_numpy(zero_copy_only=False) for v in (0, 1))
    held = np.zeros(x.shape, bool)
    # rectangles along the axes hold what their boxes hold, as in :func:`upright`
    four = np.flatnonzero(points == 5)
    cx, cy = (v[ends[four, None] + np.arange(5)] for v in (vx, vy))
    ways = [(a[:, 0] == a[:, 1]) & (b[:, 1] == b[:, 2]) & (a[:, 2] == a[:, 3]) & (b[:, 3] == b[:, 0]) for a, b in ((cx, cy), (cy, cx))]
    straight = (cx[:, 0] == cx[:, 4]) & (cy[:, 0] == cy[:, 4]) & (ways[0] | ways[1])
    box, cx, cy = four[straight], cx[straight], cy[straight]
    lows, highs = ([f(c, axis=1)[:, None] for c in (cx, cy)] for f in (np.min, np.max))
    held[box] = (x[box] >= lows[0]) & (x[box] <= highs[0]) & (y[box] >= lows[1]) & (y[box] <= highs[1])
    size = np.maximum(points - 1, 0)
    size[box] = 0
    some = np.flatnonzero(size)
    first = np.concatenate(([0], np.cumsum(size[some])))
    row, a = np.repeat(some, size[some]), np.arange(first[-1])
    a = a + np.repeat(ends[some] - first[:-1], size[some])
    ax, ay, bx, by, x_, y_ = vx[a, None], vy[a, None], vx[a + 1, None], vy[a + 1, None], x[row], y[row]
    cross = (bx - ax) * (y_ - ay) - (x_ - ax) * (by - ay)
    on = (cross == 0) & (x_ >= np.minimum(ax, bx)) & (x_ <= np.maximum(ax, bx)) & (y_ >= np.minimum(ay, by)) & (y_ <= np.maximum(ay, by))
    crossed = ((ay > y_) != (by > y_)) & ((cross > 0) == (by > ay))
    if len(some):
        held[some] = np.logical_or.reduceat(on, first[:-1]) | np.logical_xor.reduceat(crossed, first[:-1])
    return held


def where_inside(rows: DataFrame, x: str, y: str) -> DataFrame:
    """``rows`` whose point ``x, y`` lies in their ``ring`` or on its edge, or that have none, without that column; in batches of Arrow."""
    ship(rows.sparkSession)
    kind = StructType([f for f in rows.schema if f.name != "ring"])

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [batch.column(c).to_numpy(zero_copy_only=False)[:, None] for c in (x, y)]
            rings = batch.column("ring")
            bare = rings.is_null().to_numpy(zero_copy_only=False)
            yield batch.drop_columns(["ring"]).filter(pa.array(bare | held_points(rings, *at)[:, 0]))

    return rows.mapInArrow(kept, kind)


def with_tiles(df: DataFrame, west: Column, east: Column, south: Column, north: Column, size: float) -> DataFrame:
    """One row for each tile of side ``size`` that a box touches: ``tx, ty``."""
    index = lambda c: F.floor(c / size).cast("int")
    return df.withColumn("tx", F.explode(F.sequence(index(west), index(east)))).withColumn("ty", F.explode(F.sequence(index(south), index(north))))


def with_tile(df: DataFrame, x: Column, y: Column, size: float) -> DataFrame:
    """The one tile that a point lies in."""
    return df.withColumn("tx", F.floor(x / size).cast("int")).withColumn("ty", F.floor(y / size).cast("int"))


def interval_union(segments: Column) -> Column:
    """Disjoint intervals of ``array<struct<lo,hi>>``; touching ones are joined."""

    def step(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], s["hi"]).alias("hi"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["hi"] >= s["lo"]), joined).otherwise(F.concat(done, F.array(s)))

    def safe(done: Column, s: Column) -> Column:
        return F.when(F.size(done) == 0, F.array(s)).otherwise(step(done, s))

    return F.aggregate(F.array_sort(segments), F.array().cast("array<struct<lo:double,hi:double>>"), safe)


def total_length(segments: Column) -> Column:
    """Summed length of the union of intervals; 0 for none."""

    def step(state: Column, s: Column) -> Column:
        gain = F.greatest(F.lit(0.0), s["hi"] - F.greatest(s["lo"], state["end"]))
        return F.struct(F.greatest(state["end"], s["hi"]).alias("end"), (state["total"] + gain).alias("total"))

    start = F.struct(F.lit(-1e300).alias("end"), F.lit(0.0).alias("total"))
    return F.aggregate(F.array_sort(segments), start, step, lambda s: s["total"])
