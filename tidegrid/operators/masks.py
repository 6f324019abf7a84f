"""Land and sea masks (0 dry, 1 wet) and the water bodies in them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from tidegrid.functions.geometry import held_points, ring_box, with_tile, with_tiles
from tidegrid.operators.components import connected_components
from tidegrid.operators.ordering import numbered
from tidegrid.plans.shared import broadcast_if_small, materialise
from tidegrid.plans.ship import ship

_POINTS = ArrayType(StructType([StructField("pt", IntegerType()), StructField("x", DoubleType()), StructField("y", DoubleType())]))


def initial_mask(depth: DataFrame, dry: float) -> DataFrame:
    """M1: wet wherever the depth is not the dry value."""
    return depth.withColumn("mask", F.when(F.col("depth") == dry, 0).otherwise(1))


def _sampled(cells: DataFrame, n: int) -> DataFrame:
    """``cells`` with ``points`` in place of ``ring``: ``pt, x, y`` of ``n`` x ``n`` points over the box of the ring, those within it."""
    ship(cells.sparkSession)
    kind = StructType([*(f for f in cells.schema if f.name != "ring"), StructField("points", _POINTS)])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pt = np.arange(n * n)
        # a batch has n * n points for each of its rows
        for batch in (b.slice(o, 1000) for b in batches for o in range(0, b.num_rows, 1000)):
            rings = batch.column("ring")
            full = np.flatnonzero(np.nan_to_num(rings.value_lengths().to_numpy(zero_copy_only=False)) > 0)
            x, y = np.full((batch.num_rows, n * n), np.nan), np.full((batch.num_rows, n * n), np.nan)
            if len(full):
                first = rings.take(pa.array(full)).offsets.to_numpy()[:-1]
                for at, v, i in ((x, 0, pt % n), (y, 1, pt // n)):
                    c = rings.flatten().field(v).to_numpy(zero_copy_only=False)
                    low, high = (f.reduceat(c, first)[:, None] for f in (np.minimum, np.maximum))
                    at[full] = low + (high - low) * i / (n - 1)
            held = held_points(rings, x, y)
            row, number = np.nonzero(held)
            offsets = pa.array(np.concatenate(([0], np.cumsum(held.sum(axis=1)))), pa.int32())
            points = pa.StructArray.from_arrays([pa.array(number, pa.int32()), pa.array(x[row, number]), pa.array(y[row, number])], ["pt", "x", "y"])
            rest = batch.drop_columns(["ring"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.ListArray.from_arrays(offsets, points)], [*rest.schema.names, "points"])

    return cells.mapInArrow(placed, kind)


def samples(cells: DataFrame, n: int = 6) -> DataFrame:
    """M4: ``n`` x ``n`` points over the box of each cell, those within its ring: ``pt, x, y``."""
    return _sampled(cells.select("k", "j", "ring"), n).select("k", "j", F.explode("points").alias("p")).select("k", "j", "p.pt", "p.x", "p.y")


def clean_mask(cells: DataFrame, mask: DataFrame, polygons: DataFrame, limit: float, offset: float, tile: float, n: int = 6) -> DataFrame:
    """M2-M7: wet cells whose samples lie in polygons to the share ``limit`` become dry.

    Only polygons whose box, widened by ``offset``, holds the cell's node count. A
    sample is covered by any of them, so the order of polygons has no effect. The
    share is rounded to tenths. ``cells`` has ``lon, lat, ring``; ``polygons`` has
    ``poly_id, ring`` (ids may repeat, as the pieces of a polygon do). ``mask`` is
    read twice.

    Candidates are found by tiles of boxes, which rings do not go to. Samples meet the
    edges of their candidates in bands of latitude, and whether one lies inside follows
    from how many edges it has on its right: a long ring is as many rows as it has edges.
    """
    wet = materialise(_sampled(cells.join(mask.where("mask = 1").select("k", "j"), ["k", "j"]), n), "sampled")
    # dealt out: a small file of polygons is one partition, and many edges
    dealt = polygons.select("ring").repartition(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rings = materialise(dealt.select(F.monotonically_increasing_id().alias("piece"), "ring"), "rings")
    boxed = rings.select("piece", *ring_box(F.col("ring")))
    wide = with_tiles(boxed, F.col("west") - offset, F.col("east") + offset, F.col("south") - offset, F.col("north") + offset, tile)
    near = with_tile(wet, F.col("lon"), F.col("lat"), tile).join(wide, ["tx", "ty"]).where(
        F.col("lon").between(F.col("west") - offset, F.col("east") + offset) & F.col("lat").between(F.col("south") - offset, F.col("north") + offset)
    )
    held = F.expr("filter(points, p -> p.x BETWEEN west AND east AND p.y BETWEEN south AND north)")
    asked = near.select("k", "j", F.size("points").alias("all"), "piece", F.explode(held).alias("p")).select("k", "j", "all", "piece", "p.pt", "p.x", "p.y")

    size = tile / 8
    ends = F.transform(F.sequence(F.lit(1), F.size("ring") - 1), lambda i: F.struct(F.col("ring")[i - 1].alias("a"), F.col("ring")[i].alias("b")))
    edges = rings.select("piece", F.explode(ends).alias("e")).select("piece", *[F.col(f"e.{c}.{v}").alias(f"{c}{v}") for c in "ab" for v in "xy"])
    band = lambda c: F.floor(c / size).cast("long")
    edges = edges.withColumn("band", F.explode(F.sequence(band(F.least("ay", "by")), band(F.greatest("ay", "by")))))
    met = asked.withColumn("band", band(F.col("y"))).join(edges, ["piece", "band"])
    cross = "(bx - ax) * (y - ay) - (x - ax) * (by - ay)"
    on = F.expr(f"{cross} = 0 AND x BETWEEN least(ax, bx) AND greatest(ax, bx) AND y BETWEEN least(ay, by) AND greatest(ay, by)")
    crossed = F.expr(f"(ay > y) <> (by > y) AND ({cross} > 0) = (by > ay)")
    within = met.groupBy("k", "j", "all", "piece", "pt").agg(F.count_if(crossed).alias("times"), F.max(on).alias("on")).where("on OR times % 2 = 1")
    share = within.select("k", "j", "all", "pt").distinct().groupBy("k", "j", "all").agg(F.count("*").alias("n"))
    dried = share.where(F.round(F.col("n") / F.col("all") * 10) / 10 >= limit).select("k", "j", F.lit(True).alias("dried"))
    return mask.join(dried, ["k", "j"], "left").select("k", "j", F.when(F.col("dried"), 0).otherwise(F.col("mask")).alias("mask"))


def _tile_labels(table: pa.Table, ny: int) -> pa.Table:
    """``k, j, mask, label`` of a tile: the least cell number of each cell's body within the tile; null where dry."""
    k, j = (table[c].to_numpy().astype(np.int64) for c in "kj")
    wet = np.flatnonzero(table["mask"].to_numpy() == 1)
    lin = (j[wet] - 1) * ny + k[wet]
    order = np.argsort(lin)
    lin, wet = lin[order], wet[order]
    least = np.arange(len(lin))
    # neighbours above follow in the number, those on the right by a column
    sides = []
    for step, near in ((1, k[wet] < ny), (ny, np.ones(len(lin), bool))):
        at = np.minimum(np.searchsorted(lin, lin + step), max(len(lin) - 1, 0))
        a = np.flatnonzero(near & (lin[at] == lin + step)) if len(lin) else at
        sides.append((a, at[a]))
    a, b = (np.concatenate(x) for x in zip(*sides))
    while len(a):
        pa_, pb = least[a], least[b]
        if (pa_ == pb).all():
            break
        np.minimum.at(least, np.maximum(pa_, pb), np.minimum(pa_, pb))
        while not (least == least[least]).all():
            least = least[least]
    label = np.zeros(len(k), np.int64)
    label[wet] = lin[least]
    return pa.table({"k": table["k"], "j": table["j"], "mask": table["mask"], "label": pa.array(label, mask=label == 0)})


def water_bodies(mask: DataFrame, nx: int, ny: int, wrap: bool = False, tile: int = 64) -> DataFrame:
    """``body_id`` of each wet cell's body, -1 for dry cells.

    Bodies are connected by sides; with ``wrap`` the last column touches the first.
    Numbers follow the first cell of a body in column-major order.

    Cells are dealt out by tiles of ``tile`` cells a side, which one task labels at once.
    Only cells on borders of tiles then meet their neighbours, and only labels that these
    join are looked at again, see ``connected_components``.
    """
    ship(mask.sparkSession)
    kinds = {c: mask.schema[c].dataType.simpleString() for c in ("k", "j", "mask")}
    placed = mask.select("k", "j", "mask", F.expr(f"(k - 1) div {tile}").alias("tk"), F.expr(f"(j - 1) div {tile}").alias("tj"))
    kind = ", ".join(f"{c} {t}" for c, t in kinds.items()) + ", label long"
    cells = materialise(placed.groupBy("tk", "tj").applyInArrow(lambda table: _tile_labels(table, ny), kind), "tiles")
    wet = cells.where("label is not null")
    last = F.lit(wrap) & (F.col("j") == nx)
    right = wet.where(last | (F.col("j") % tile == 0)).select("k", F.when(last, 1).otherwise(F.col("j") + 1).alias("j"), F.col("label").alias("a"))
    above = wet.where(F.col("k") % tile == 0).select((F.col("k") + 1).alias("k"), "j", F.col("label").alias("a"))
    edges = right.unionByName(above).join(wet.where(f"(j - 1) % {tile} = 0 or (k - 1) % {tile} = 0").select("k", "j", F.col("label").alias("b")), ["k", "j"])
    joined = connected_components(edges.select("a", "b").distinct())
    labels = wet.select("label").distinct().join(joined.toDF("label", "component"), "label", "left")
    labels = materialise(labels.select("label", F.coalesce("component", "label").alias("component")), "labels")
    names = numbered(labels.select("component").distinct(), "component").select("component", (F.col("n") + 1).cast("int").alias("body_id"))
    found = broadcast_if_small(materialise(labels.join(names, "component").select("label", "body_id"), "bodies"))
    return cells.join(found, "label", "left").select("k", "j", F.coalesce("body_id", F.lit(-1)).alias("body_id"))


def body_sizes(bodies: DataFrame) -> DataFrame:
    """Cells of each water body."""
    return bodies.where("body_id > 0").groupBy("body_id").agg(F.count("*").alias("cells"))


def keep_bodies(bodies: DataFrame, tolerance: int) -> DataFrame:
    """The mask with the largest body only (below 0; the lowest id of equals), or without bodies smaller than ``tolerance``."""
    sizes = body_sizes(bodies)
    kept = sizes.orderBy(F.desc("cells"), "body_id").limit(1) if tolerance < 0 else sizes.where(F.col("cells") >= tolerance)
    return bodies.join(kept.select("body_id", F.lit(1).alias("m")), "body_id", "left").select("k", "j", F.coalesce("m", F.lit(0)).alias("mask"))


def enable_bodies(mask: DataFrame, bodies: DataFrame, ids: list[int]) -> DataFrame:
    """The mask with some bodies wet again."""
    return mask.join(bodies, ["k", "j"]).select("k", "j", F.when(F.col("body_id").isin(ids), 1).otherwise(F.col("mask")).alias("mask"))
