"""Shoreline polygons ``poly_id, level, ring``; rings are closed and counter-clockwise."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.geometry import inside, point, ring_box
from tidegrid.operators.rings import BOX, ENDS, clip_edges, edges_of, rings_of, split_edges
from tidegrid.plans.shared import materialise
from tidegrid.plans.ship import ship

Box = tuple[float, float, float, float]  # west, east, south, north
Point = tuple[float, float]


def measured(polygons: DataFrame) -> DataFrame:
    """Number of vertices, box, width and height."""
    out = polygons.select("*", F.size("ring").alias("n"), *ring_box(F.col("ring")))
    return out.withColumn("width", F.col("east") - F.col("west")).withColumn("height", F.col("north") - F.col("south"))


def of_level(polygons: DataFrame, level: int = 1) -> DataFrame:
    """B1: polygons of one level: 1 land, 2 lakes, 3 islands in lakes."""
    return polygons.where(F.col("level") == level)


def box_class(measured_: DataFrame, box: Box) -> DataFrame:
    """``outside``, ``inside`` or ``crossing`` a box; touching is not outside."""
    west, east, south, north = box
    out = (F.col("west") > east) | (F.col("east") < west) | (F.col("south") > north) | (F.col("north") < south)
    within = (F.col("west") >= west) & (F.col("east") <= east) & (F.col("south") >= south) & (F.col("north") <= north)
    return measured_.withColumn("class", F.when(out, "outside").when(within, "inside").otherwise("crossing"))


def _in_box(p: Column, box: Box) -> Column:
    return p["x"].between(box[0], box[1]) & p["y"].between(box[2], box[3])


def vertex_flags(polygons: DataFrame, box: Box) -> DataFrame:
    """One row for each vertex but the closing one: in the box, on its edge, grazing.

    A vertex on the edge grazes if neither neighbour along the ring is in the box.
    """
    n = F.size("ring") - 1
    flags = F.transform(F.slice("ring", 1, n), lambda p: _in_box(p, box))
    rows = polygons.select("poly_id", "ring", flags.alias("f"), n.alias("n")).select("poly_id", "f", "n", F.posexplode(F.slice("ring", 1, F.size("ring") - 1)).alias("seq", "p"))
    on = _in_box(F.col("p"), box) & (F.col("p.x").isin(box[0], box[1]) | F.col("p.y").isin(box[2], box[3]))
    before, after = (F.expr(f"f[(seq + n {s} 1) % n]") for s in "-+")
    return rows.select("poly_id", "seq", F.expr("f[seq]").alias("in_box"), on.alias("on_box"), (on & ~before & ~after).alias("grazing"))


def crossings(polygons: DataFrame, box: Box) -> DataFrame:
    """Edges of each ring that lead into or out of the box, in ring order."""
    i = F.sequence(F.lit(1), F.size("ring") - 1)
    edge = F.transform(i, lambda i: F.struct(i.alias("seq"), F.col("ring")[i - 1].alias("a"), F.col("ring")[i].alias("b")))
    rows = polygons.select("poly_id", F.explode(edge).alias("e")).select("poly_id", "e.seq", "e.a", "e.b")
    a, b = _in_box(F.col("a"), box), _in_box(F.col("b"), box)
    return rows.where(a != b).withColumn("way", F.when(a, "out").otherwise("in"))


def edge_points(crossed: DataFrame, box: Box) -> DataFrame:
    """Where crossing edges meet the box, and its distance around the box.

    ``position`` counts sides counter-clockwise from the lower left corner: 0-1 south,
    1-2 east, 2-3 north, 3-4 west. Edges of over 90 degrees are taken the short way.
    """
    west, east, south, north = box
    ax, ay, bx, by = F.col("a.x"), F.col("a.y"), F.col("b.x"), F.col("b.y")
    turn = F.when(F.abs(bx - ax) > 90, 360 * F.signum(bx - ax)).otherwise(0)
    # the end in the box stays where it is
    ax, bx = F.when(F.col("way") == "in", ax + turn).otherwise(ax), F.when(F.col("way") == "out", bx - turn).otherwise(bx)
    dx, dy = bx - ax, by - ay

    def horizontal(y: float, side: int) -> Column:
        t = (F.lit(y) - ay) / F.nullif(dy, F.lit(0.0))
        x = ax + t * dx
        along = (x - west) / (east - west) if side == 0 else (east - x) / (east - west)
        return F.when(t.between(0, 1) & x.between(west, east), F.struct(x.alias("x"), F.lit(y).alias("y"), (side + along).alias("position")))

    def vertical(x: float, side: int) -> Column:
        t = (F.lit(x) - ax) / F.nullif(dx, F.lit(0.0))
        y = ay + t * dy
        along = (y - south) / (north - south) if side == 1 else (north - y) / (north - south)
        return F.when(t.between(0, 1) & y.between(south, north), F.struct(F.lit(x).alias("x"), y.alias("y"), (side + along).alias("position")))

    met = F.coalesce(horizontal(south, 0), vertical(east, 1), horizontal(north, 2), vertical(west, 3))
    return crossed.withColumn("p", met).select("poly_id", "seq", "way", F.col("p.x").alias("x"), F.col("p.y").alias("y"), F.pmod(F.col("p.position"), F.lit(4.0)).alias("position"))


def _meet(a: tuple[float, float], b: tuple[float, float], box: Box) -> tuple[float, float, float]:
    """Point and position where the edge from inside point ``a`` to outside point ``b`` leaves the box."""
    west, east, south, north = box
    bx = b[0] - math.copysign(360, b[0] - a[0]) if abs(b[0] - a[0]) > 90 else b[0]
    dx, dy = bx - a[0], b[1] - a[1]
    ways = [(south, dy < 0, 0), (north, dy > 0, 2)], [(west, dx < 0, 3), (east, dx > 0, 1)]
    exits = [((v - a[1]) / dy, s) for v, leaves, s in ways[0] if leaves] + [((v - a[0]) / dx, s) for v, leaves, s in ways[1] if leaves]
    t, side = min(exits)
    x, y = min(max(a[0] + t * dx, west), east), min(max(a[1] + t * dy, south), north)
    along = {0: (x - west) / (east - west), 1: (y - south) / (north - south), 2: (east - x) / (east - west), 3: (north - y) / (north - south)}
    return x, y, (side + along[side]) % 4


def _encloses(ring: list[tuple[float, float]], x: float, y: float) -> bool:
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        cross = (bx - ax) * (y - ay) - (x - ax) * (by - ay)
        if cross == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return True
        if (ay > y) != (by > y) and (cross > 0) == (by > ay):
            odd = not odd
    return odd


def vertex_clipped_rings(ring: list[Point], box: Box) -> list[list[Point]]:
    """B5-B12 as older grids have them: only stretches with a vertex in the box count.

    Stretches of vertices inside are joined along the box, counter-clockwise, from
    where one leaves to where the next enters, over the box's corners in between. A
    ring without a vertex inside gives the box if it holds all corners, else nothing.
    """
    west, east, south, north = box
    corners = [(west, south), (east, south), (east, north), (west, north)]
    nodes = ring[:-1]
    n = len(nodes)
    within = [west <= x <= east and south <= y <= north for x, y in nodes]
    on = [w and (x in (west, east) or y in (south, north)) for w, (x, y) in zip(within, nodes)]
    kept = list(within)
    for i in range(n):
        if on[i] and not kept[i - 1] and not kept[(i + 1) % n]:
            kept[i] = False
    if all(kept):
        return [ring]
    if not any(kept):
        covered = not any(within) and all(_encloses(ring, *c) for c in corners)
        return [[*corners, corners[0]]] if covered else []
    parts = []  # entry position, exit position, points
    for first in (i for i in range(n) if kept[i] and not kept[i - 1]):
        last = first
        while kept[(last + 1) % n]:
            last += 1
        points = [nodes[i % n] for i in range(first, last + 1)]
        x, y, entry = _meet(points[0], nodes[first - 1], box)
        if (x, y) != points[0]:
            points.insert(0, (x, y))
        x, y, leave = _meet(points[-1], nodes[(last + 1) % n], box)
        if (x, y) != points[-1]:
            points.append((x, y))
        parts.append((entry, leave, points))
    out, left = [], sorted(parts)
    while left:
        start = entry, leave, points = left.pop(0)
        points = list(points)
        while True:
            ahead = lambda p, leave=leave: (p - leave) % 4 or 4.0
            following = min([*left, start], key=lambda s: ahead(s[0]))
            reach = ahead(following[0])
            points += [corners[int(c) % 4] for c in range(math.floor(leave) + 1, math.floor(leave) + 6) if 0 < c - leave < reach]
            if following is start:
                break
            left.remove(following)
            points += following[2]
            leave = following[1]
        out.append([*points, points[0]])
    return out


def clip_rows(polygons: DataFrame, box: Box) -> DataFrame:
    """Edges of polygons within a box: ``poly_id, level, part, whole, i, n, ax, ay, bx, by``.

    Disjoint polygons go by their boxes and those inside are copied; the edges of all others
    are cut one by one (``clip_edges``). No row holds a ring, and no Python is involved.
    """
    # dealt out and measured once: a small file is one partition, and a filter on the class would measure every ring again
    dealt = polygons.select("poly_id", "level", "ring").repartition(int(polygons.sparkSession.conf.get("spark.sql.shuffle.partitions")), "poly_id")
    known = materialise(box_class(measured(dealt), box).select("poly_id", "level", "class", F.when(F.col("class") != "outside", F.col("ring")).alias("ring")), "classed")
    columns = ["poly_id", F.col("level").cast("int").alias("level"), F.col("part").cast("int").alias("part"), "whole", "i", "n", *ENDS]
    copied = edges_of(known.where("class = 'inside'")).withColumns({"part": F.lit(0), "whole": F.lit(True)})
    edges = edges_of(known.where("class = 'crossing'")).withColumns({"tile": F.lit(0), **{name: F.lit(float(v)) for name, v in zip(BOX, box)}})
    return copied.select(columns).unionByName(clip_edges(edges).withColumn("whole", F.lit(False)).select(columns))


def clip(polygons: DataFrame, box: Box, compat: bool = False) -> DataFrame:
    """Polygons within a box: ``poly_id, level, part, whole, ring``; for large ones see :func:`clip_rows`.

    With ``compat`` parts of a polygon that cross the box without a vertex in it are
    lost, as are grazing vertices; each crossing polygon is then walked on its own.
    """
    if not compat:
        return rings_of(clip_rows(polygons, box), "poly_id", "level", "part", "whole")
    ship(polygons.sparkSession)
    known = box_class(measured(polygons), box)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = [
                (i, level, part, False, [{"x": x, "y": y} for x, y in ring])
                for i, level, r in zip(rows["poly_id"], rows["level"], rows["ring"])
                for part, ring in enumerate(vertex_clipped_rings([(p["x"], p["y"]) for p in r], box))
            ]
            yield pd.DataFrame(out, columns=["poly_id", "level", "part", "whole", "ring"])

    kind = f"poly_id {polygons.schema['poly_id'].dataType.simpleString()}, level int, part int, whole boolean, ring array<struct<x:double,y:double>>"
    level = F.col("level").cast("int").alias("level")
    copied = known.where("class = 'inside'").select("poly_id", level, F.lit(0).alias("part"), F.lit(True).alias("whole"), "ring")
    crossing = known.where("class = 'crossing'").select("poly_id", level, "ring").mapInPandas(walk, kind)
    return copied.unionByName(crossing)


def ring_area(ring: Column) -> Column:
    """Signed area of a ring (positive when counter-clockwise)."""
    i = F.sequence(F.lit(1), F.size(ring) - 1)
    return F.aggregate(F.transform(i, lambda i: ring[i - 1]["x"] * ring[i]["y"] - ring[i]["x"] * ring[i - 1]["y"]), F.lit(0.0), lambda a, x: a + x) / 2


def densify(rings: DataFrame, step: float = 0.25) -> DataFrame:
    """Edges of over two steps get a point at each step, the last gap being longer."""
    ring = F.col("ring")

    def edge(i: Column) -> Column:
        a, b = ring[i - 1], ring[i]
        d = F.sqrt(F.pow(b["x"] - a["x"], 2) + F.pow(b["y"] - a["y"], 2))
        n = F.when(d > 2 * step, (F.floor(d / step) - 1).cast("int")).otherwise(0)
        new = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda s: point(a["x"] + s * step * (b["x"] - a["x"]) / d, a["y"] + s * step * (b["y"] - a["y"]) / d)))
        return F.concat(F.coalesce(new, F.array().cast("array<struct<x:double,y:double>>")), F.array(point(b["x"], b["y"])))

    points = F.flatten(F.transform(F.sequence(F.lit(1), F.size(ring) - 1), edge))
    return rings.withColumn("ring", F.concat(F.array(point(ring[0]["x"], ring[0]["y"])), points))


def split_tiles(measured_: DataFrame, limit: float) -> DataFrame:
    """Tiles that wide or high polygons are to be cut into; others have none.

    Tiles are ``limit`` on a side from the whole degrees around the polygon; the last
    of a row or column takes what remains.
    """
    axis = lambda low, high: F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), (F.ceil((F.ceil(high) - F.floor(low)) / limit) - 1).cast("int"))),
        lambda i: F.struct((F.floor(low) + i * limit).alias("a"), F.least(F.floor(low) + (i + 1) * limit, F.ceil(high).cast("double")).alias("b")),
    )
    large = measured_.where((F.col("width") > limit) | (F.col("height") > limit))
    xs = large.withColumn("tx", F.explode(axis(F.col("west"), F.col("east"))))
    return xs.withColumn("ty", F.explode(axis(F.col("south"), F.col("north"))))


def split_rows(polygons: DataFrame, limit: float) -> DataFrame:
    """Edges of polygons cut to their tiles: ``piece, poly_id, level, i, n, ax, ay, bx, by``; small ones as they are."""
    return split_edges(edges_of(polygons), limit)


def split(polygons: DataFrame, limit: float, compat: bool = False) -> DataFrame:
    """Large polygons clipped to their tiles: ``poly_id, level, ring``; small ones as they are.

    The pieces cover the polygon, but with ``compat``, which loses those that have no
    vertex in their tile and sends a ring to each of its tiles.
    """
    if not compat:
        return rings_of(split_rows(polygons, limit), "piece", "poly_id", "level").drop("piece")
    ship(polygons.sparkSession)
    known = measured(polygons)
    small = known.where((F.col("width") <= limit) & (F.col("height") <= limit)).select("poly_id", "level", "ring")
    tiles = split_tiles(known, limit).select("poly_id", "level", "ring", F.array("tx.a", "tx.b", "ty.a", "ty.b").cast("array<double>").alias("box"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = [
                (i, level, [{"x": x, "y": y} for x, y in ring])
                for i, level, r, box in zip(rows["poly_id"], rows["level"], rows["ring"], rows["box"])
                for ring in vertex_clipped_rings([(p["x"], p["y"]) for p in r], tuple(box))
            ]
            yield pd.DataFrame(out, columns=["poly_id", "level", "ring"])

    return small.unionByName(tiles.mapInPandas(walk, small.schema))


def enabled(polygons: DataFrame, flags: DataFrame) -> DataFrame:
    """S3: user polygons whose flag is 1: ``flags`` has ``id, flag, label``."""
    return polygons.join(flags.where("flag = 1").select(F.col("id").alias("poly_id"), "label"), "poly_id")


def covers_box(polygons: DataFrame, box: Box) -> DataFrame:
    """Polygons that hold all corners of a box."""
    # stored as they are dealt out: Spark would filter the one partition of a small file before
    polygons = materialise(polygons.repartition(int(polygons.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "dealt")
    west, east, south, north = box
    corners = [(west, south), (east, south), (east, north), (west, north)]
    held = F.lit(True)
    for x, y in corners:
        held = held & inside(F.col("ring"), F.lit(x), F.lit(y))
    return polygons.where(held)
