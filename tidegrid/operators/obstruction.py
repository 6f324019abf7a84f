"""Sub-grid obstruction: how much of each cell's width and height small islands block."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.geometry import total_length
from tidegrid.operators.bathymetry import points_in_cells
from tidegrid.plans.shared import materialise
from tidegrid.plans.ship import ship

_SEGS = "array<struct<lo:double,hi:double>>"


def extents(polygons: DataFrame, cells: DataFrame, mask: DataFrame, tile: float) -> DataFrame:
    """Span of each polygon's vertices in each wet cell: ``k, j, poly_id, x_lo, x_hi, y_lo, y_hi``.

    Spans are along the cell's own axes from its lower left corner, as shares of
    height (``x_``: what blocks motion along x) and width (``y_``).
    """
    wet = materialise(cells.join(mask.where("mask <> 0").select("k", "j"), ["k", "j"]), "wet")
    # dealt out first: a small file of polygons is one partition, and many vertices; the outer explode, as Spark
    # would compute rings that are expressions once more, uncompiled, to drop the empty ones before it
    vertices = polygons.select("poly_id", "ring").repartition("poly_id").select("poly_id", F.explode_outer("ring").alias("p"))
    vertices = vertices.where("p is not null").select("poly_id", F.col("p.x").alias("lon"), F.col("p.y").alias("lat"))
    met = points_in_cells(vertices, wet, tile).select("k", "j", "poly_id", "lon", "lat")
    at = met.join(wet.select("k", "j", "c4", "width", "height", "angle"), ["k", "j"])
    dx, dy, a = F.col("lon") - F.col("c4.x"), F.col("lat") - F.col("c4.y"), F.col("angle")
    along = (dx * F.cos(a) + dy * F.sin(a)) / F.col("width")
    up = (dy * F.cos(a) - dx * F.sin(a)) / F.col("height")
    bound = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    return at.groupBy("k", "j", "poly_id").agg(bound(F.min(up)).alias("x_lo"), bound(F.max(up)).alias("x_hi"), bound(F.min(along)).alias("y_lo"), bound(F.max(along)).alias("y_hi"))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``across, poly_id, at, lo, hi`` of sorted rows of these, with adjacent cells of a polygon counted in one.

    One span is open at a time; it goes on over the ends of batches, so a polygon's row may be of any length.
    """
    open_: tuple | None = None
    schema = None

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        schema, done = batch.schema, []
        for across, poly, at, lo, hi in zip(*(c.to_pylist() for c in batch.columns)):
            if open_ is not None and open_[:2] == (across, poly) and at == open_[2] + 1:
                # the place reached goes on with the walk: a widened span stays where it was
                place = open_[2] if open_[4] - open_[3] >= hi - lo else at
                open_ = across, poly, place, min(lo, open_[3]), max(hi, open_[4])
                continue
            if open_ is not None:
                done.append(open_)
            open_ = across, poly, at, lo, hi
        if done:
            yield made(done)
    if open_ is not None:
        yield made([open_])


def merge_neighbours(found: DataFrame, axis: str) -> DataFrame:
    """A polygon in adjacent cells of a row (column) counts in one of them.

    From left to right (below to above) the longer span takes in the other, ties
    going to the first; the widened span is what the next cell is compared with.
    Rows are dealt out by row and polygon, sorted, and walked through once.
    """
    ship(found.sparkSession)
    along, across = ("j", "k") if axis == "x" else ("k", "j")
    rows = found.select(across, "poly_id", along, F.col(f"{axis}_lo").alias("lo"), F.col(f"{axis}_hi").alias("hi"))
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    folded = rows.repartition(across, "poly_id").sortWithinPartitions(across, "poly_id", along).mapInArrow(_fold, kind)
    return folded.select("k", "j", "poly_id", "lo", "hi")


def net_segments(merged: DataFrame) -> DataFrame:
    """Disjoint spans of each cell: ``k, j, segs``.

    A span that begins beyond all before it starts an island; only islands are
    gathered, of which a cell has few however many polygons touch it.
    """
    order = Window.partitionBy("k", "j").orderBy("lo", "hi")
    reached = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begun = merged.withColumn("begins", F.coalesce((F.col("lo") > reached).cast("int"), F.lit(1)))
    islands = begun.withColumn("island", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    islands = islands.groupBy("k", "j", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return islands.groupBy("k", "j").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("segs"))


def _shadow(own: Column, other: Column) -> Column:
    """Own spans not within one of the neighbour's, and then the neighbour's not within own."""
    none = F.array().cast(_SEGS)
    other = F.coalesce(other, none)
    left = F.filter(own, lambda s: ~F.exists(other, lambda t: (t["lo"] <= s["lo"]) & (t["hi"] >= s["hi"])))
    more = F.filter(other, lambda t: ~F.exists(left, lambda s: (s["lo"] <= t["lo"]) & (s["hi"] >= t["hi"])))
    return F.when(F.size(left) == 0, none).otherwise(F.concat(left, more))


def obstruction(cells: DataFrame, mask: DataFrame, segments: DataFrame, axis: str, before: int = 0, after: int = 0) -> DataFrame:
    """The blocked share of each cell along an axis: ``k, j, value``.

    Spans within those of the ``before`` cells on the left (below) and ``after`` cells
    on the right (above) are in their shadow; what remains of those cells' spans adds
    to the cell's own. Cells next to a dry cell on the axis have 0, as have dry cells.
    """
    along, across = ("j", "k") if axis == "x" else ("k", "j")
    at = Window.partitionBy(across).orderBy(along)
    full = cells.select("k", "j").join(mask.select("k", "j", "mask"), ["k", "j"]).join(segments, ["k", "j"], "left")
    near = {("b", n): F.lag("segs", n).over(at) for n in range(1, before + 1)} | {("a", n): F.lead("segs", n).over(at) for n in range(1, after + 1)}
    full = full.select("*", *[c.alias(f"{s}{n}") for (s, n), c in near.items()], F.lag("mask").over(at).alias("left"), F.lead("mask").over(at).alias("right"))
    own = F.col("segs")
    for s, n in near:
        full = full.withColumn("segs", F.when(F.size(own) > 0, _shadow(own, F.col(f"{s}{n}"))).otherwise(own))
    open_ = (F.coalesce("left", F.lit(1)) != 0) & (F.coalesce("right", F.lit(1)) != 0) & (F.col("mask") != 0)
    return full.select("k", "j", F.when(open_, F.coalesce(total_length(own), F.lit(0.0))).otherwise(0.0).alias("value"))


def sub_grid(polygons: DataFrame, cells: DataFrame, mask: DataFrame, tile: float, before: int = 0, after: int = 0) -> DataFrame:
    """``k, j, sx, sy`` of every cell.

    Both axes start from the same spans, which are stored; ``cells`` and ``mask`` are
    read several times.
    """
    found = materialise(extents(polygons, cells, mask, tile), "extents")
    both = [
        obstruction(cells, mask, net_segments(merge_neighbours(found, axis)), axis, before, after).withColumnRenamed("value", f"s{axis}") for axis in "xy"
    ]
    return both[0].join(both[1], ["k", "j"])
