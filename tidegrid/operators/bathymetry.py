"""Depth of target cells from a base raster ``ilon, ilat, lon, lat, z``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.geometry import ring_box, upright, where_inside, with_tile, with_tiles
from tidegrid.plans.shared import broadcast_if_small, materialise

#: Rounds in which a tile with many points is quartered; points that a tile has without being looked at.
DEPTH, MOST = 5, 20_000


def window_bounds(lon0: float, lat0: float, dx: float, dy: float, nx: int, ny: int, box: tuple[float, float, float, float], cell: tuple[float, float]) -> tuple[int, int, int, int]:
    """First and last column and row, from 0, within two cells of ``box`` (lon_start, lon_end, lat_start, lat_end).

    A box outside the base raster is an error.
    """
    west, east, south, north = box
    if min(west, east) < lon0 or south < lat0 or max(west, east) > lon0 + dx * (nx - 1) or north > lat0 + dy * (ny - 1):
        raise ValueError("the target reaches beyond the base raster")
    low = lambda a, base, d, c: max(0, int((a - 2 * c - base) // d))
    high = lambda a, base, d, c, n: min(n - 1, -int(-(a + 2 * c - base) // d))
    return low(west, lon0, dx, cell[0]), high(east, lon0, dx, cell[0], nx), low(south, lat0, dy, cell[1]), high(north, lat0, dy, cell[1], ny)


def window(bathy: DataFrame, lon0: float, lat0: float, dx: float, dy: float, nx: int, ny: int, box: tuple[float, float, float, float], cell: tuple[float, float]) -> DataFrame:
    """Base points within two cells of ``box``.

    The filter is on ``ilon`` and ``ilat``; where these are stored it reaches the scan, and
    in the layout of ``rasters.write_raster`` only row groups that the window touches are
    read. A box whose west lies beyond its east crosses the ends of a raster that goes
    round: both ends are read (S1c).
    """
    first, last, low, high = window_bounds(lon0, lat0, dx, dy, nx, ny, box, cell)
    across = F.col("ilon").between(first, last) if box[0] <= box[1] else (F.col("ilon") >= first) | (F.col("ilon") <= last)
    return bathy.where(across & F.col("ilat").between(low, high))


def unique_longitudes(bathy: DataFrame) -> DataFrame:
    """S1d: one point for each place on the globe, that of the smallest longitude."""
    keyed = bathy.withColumn("turn", F.pmod(F.col("lon"), F.lit(360.0)))
    first = keyed.groupBy("turn", "lat").agg(F.min_by(F.struct("lon", "z"), "lon").alias("p"))
    return first.select(F.col("p.lon").alias("lon"), "lat", F.col("p.z").alias("z"))


def dealt_tiles(points: DataFrame, cells: DataFrame, tile: float, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Points ``lon, lat`` and cells ``west, east, south, north`` with ``key``: a point has one, a cell each where one of its points can be.

    A key is a tile of side ``tile``. A tile with more than ``most`` points (a small part of what a
    task has on average) is quartered, and its quarters again, as far as they hold more; those
    that still do after ``DEPTH`` rounds, as many points of one place do, are dealt out by
    chance, with their cells in each share. The counts come from a histogram of all points.
    """
    spark = points.sparkSession
    tiled = with_tile(points, F.col("lon"), F.col("lat"), tile)
    counts = tiled.groupBy("tx", "ty").agg(F.count("*").alias("n"))
    total, largest = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if most is None:
        most = max(MOST, total // (8 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    boxed = with_tiles(cells, *(F.col(c) for c in ("west", "east", "south", "north")), tile)
    plain = F.struct(F.col("tx").alias("x"), F.col("ty").alias("y"), F.lit(-1).alias("level"), F.lit(0).alias("share"))
    if largest <= most:
        return tiled.withColumn("key", plain).drop("tx", "ty"), boxed.withColumn("key", plain).drop("tx", "ty")
    hot = broadcast_if_small(materialise(counts.where(F.col("n") > most).select("tx", "ty"), "hot_tiles"))
    fine, side = tile / 2**DEPTH, 2**DEPTH
    small = lambda c, d: (F.floor(c / d)).cast("int")

    warm = tiled.join(hot, ["tx", "ty"], "left_semi").withColumns({"fx": small(F.col("lon"), fine), "fy": small(F.col("lat"), fine)})
    level = warm.groupBy("fx", "fy").agg(F.count("*").alias("n"))
    # of each square of the histogram the largest quarter around it that holds few enough
    for up in range(DEPTH):
        around = Window.partitionBy(F.shiftright("fx", up), F.shiftright("fy", up))
        level = level.withColumn(f"n{up}", F.sum("n").over(around))
    ups = F.coalesce(*[F.when(F.col(f"n{up}") <= most, up) for up in range(DEPTH - 1, -1, -1)], F.lit(0))
    leaves = level.select("fx", "fy", ups.alias("up"), F.ceil(F.col("n0") / most).cast("int").alias("shares"))
    leaves = broadcast_if_small(materialise(leaves, "leaves"))
    key = lambda share: F.struct(F.expr("shiftright(fx, up)").alias("x"), F.expr("shiftright(fy, up)").alias("y"), F.col("up").alias("level"), share.alias("share"))
    warm = warm.join(leaves, ["fx", "fy"]).withColumn("key", key(F.pmod(F.xxhash64(*points.columns), F.col("shares")).cast("int")))
    cold = tiled.join(hot, ["tx", "ty"], "left_anti").withColumn("key", plain)

    # a cell's squares within its hot tiles
    ends = {"ax": F.greatest(small(F.col("west"), fine), F.col("tx") * side), "bx": F.least(small(F.col("east"), fine), F.col("tx") * side + side - 1)}
    ends |= {"ay": F.greatest(small(F.col("south"), fine), F.col("ty") * side), "by": F.least(small(F.col("north"), fine), F.col("ty") * side + side - 1)}
    over = boxed.join(hot, ["tx", "ty"], "left_semi").withColumns(ends)
    over = over.withColumn("fx", F.explode(F.expr("sequence(ax, bx)"))).withColumn("fy", F.explode(F.expr("sequence(ay, by)"))).join(leaves, ["fx", "fy"])
    over = over.withColumn("key", F.explode(F.transform(F.sequence(F.lit(0), F.col("shares") - 1), key)))
    over = over.select(*cells.columns, "key").dropDuplicates(["k", "j", "key"])
    under = boxed.join(hot, ["tx", "ty"], "left_anti").withColumn("key", plain)
    return cold.select(*points.columns, "key").unionByName(warm.select(*points.columns, "key")), under.select(*cells.columns, "key").unionByName(over)


def points_in_cells(points: DataFrame, cells: DataFrame, tile: float, most: int | None = None) -> DataFrame:
    """Pairs of a point ``lon, lat, ...`` and the ``k, j`` of cells ``k, j, ring`` that hold it.

    Points lie in one tile and cells in every tile they touch, so that an equi-join
    on tiles finds the pairs and no pair twice; see :func:`dealt_tiles` for uneven points, which are read twice.
    Rings that are their own boxes need no other test, and only others go with their pairs.
    """
    boxed = cells.where("size(ring) > 0").select("k", "j", F.when(~upright(F.col("ring")), F.col("ring")).alias("ring"), *ring_box(F.col("ring")))
    boxed = materialise(boxed, "boxes")
    slanted = not boxed.where("ring is not null").isEmpty()
    placed, held = dealt_tiles(points, boxed if slanted else boxed.drop("ring"), tile, most)
    # a small file is one partition, however much there is to do for its points
    pairs = placed.repartition("key").join(held, "key")
    near = F.col("lon").between(F.col("west"), F.col("east")) & F.col("lat").between(F.col("south"), F.col("north"))
    found = pairs.where(near).select(*points.columns, "k", "j", *["ring"] * slanted)
    return where_inside(found, "lon", "lat") if slanted else found


def cell_average(bathy: DataFrame, cells: DataFrame, cut_off: float, limit: float, dry: float, tile: float, wrap: bool = False) -> DataFrame:
    """Mean depth of the wet base points of each cell, or ``dry``.

    A cell is wet if more than ``limit`` of its base points are at or below
    ``cut_off``; without points it is dry. With ``wrap`` cells may reach over the
    meridian where the base raster begins; its points count once.
    """
    base = bathy.select("lon", "lat", "z")
    if wrap:
        turns = F.explode(F.array(F.lit(-360.0), F.lit(0.0), F.lit(360.0))).alias("turn")
        base = unique_longitudes(base).select("*", turns).select((F.col("lon") + F.col("turn")).alias("lon"), "lat", "z")
    wet = F.col("z") <= cut_off
    found = points_in_cells(base, cells, tile).groupBy("k", "j").agg(
        F.count("*").alias("n"), F.count_if(wet).alias("n_wet"), F.avg(F.when(wet, F.col("z"))).alias("mean")
    )
    depth = F.when(F.col("n_wet") / F.col("n") > limit, F.col("mean")).otherwise(F.lit(float(dry)))
    n = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return cells.select("k", "j").join(found, ["k", "j"], "left").select("k", "j", n("n"), n("n_wet"), depth.alias("depth"))


def bilinear(bathy: DataFrame, grid: DataFrame, lon0: float, lat0: float, dx: float, dy: float, compat: bool = False, wrap: int | None = None) -> DataFrame:
    """Depth of each node from its four base points; null beyond the raster.

    ``wrap`` is the number of columns of a raster that closes in longitude: the last
    one and the first are then neighbours, and a node may lie on any turn.

    With ``compat`` a node nearer to its left (lower) base point is extrapolated
    from the pair before it.
    """
    part = lambda v, base, d: (F.col(v) - base) / d
    index = lambda t: (F.round(t) - 1 if compat else F.floor(t)).cast("int")
    u, v = part("lon", lon0, dx), part("lat", lat0, dy)
    at = grid.select("k", "j", index(u).alias("a"), index(v).alias("b"), u.alias("u"), v.alias("v"))
    at = at.withColumn("fx", F.col("u") - F.col("a")).withColumn("fy", F.col("v") - F.col("b")).drop("u", "v")
    if wrap:
        at, bathy = at.withColumn("a", F.pmod("a", F.lit(wrap))), bathy.where(F.col("ilon").between(0, wrap - 1))
    # every base point goes to the four squares it is a corner of, so that a node needs one row, that of its square
    corners = [(i, n) for i in (0, 1) for n in (0, 1)]
    column = lambda i: F.pmod(F.col("ilon") - i, F.lit(wrap)) if wrap else F.col("ilon") - i
    sent = F.array(*[F.struct(column(i).alias("a"), (F.col("ilat") - n).alias("b"), F.lit(2 * i + n).alias("c")) for i, n in corners])
    squares = bathy.select("z", F.explode(sent).alias("s")).select("z", "s.a", "s.b", "s.c").groupBy("a", "b")
    squares = squares.agg(*[F.max(F.when(F.col("c") == c, F.col("z"))).alias(f"z{c}") for c in range(4)])
    weight = lambda i, n: (F.col("fx") if i else 1 - F.col("fx")) * (F.col("fy") if n else 1 - F.col("fy"))
    terms = [F.when(weight(i, n) != 0, weight(i, n) * F.col(f"z{2 * i + n}")).otherwise(0.0) for i, n in corners]
    # as many tasks as were asked for: put together to Spark's size of a partition, the rows that a task sorts take far more memory
    at = at.repartition(int(grid.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "b")
    return at.join(squares, ["a", "b"], "left").select("k", "j", (terms[0] + terms[1] + terms[2] + terms[3]).alias("depth"))


def resample(bathy: DataFrame, cells: DataFrame, lon0: float, lat0: float, dx: float, dy: float, cut_off: float, limit: float, dry: float, tile: float) -> DataFrame:
    """G1: average where a cell is coarser than the base raster, interpolate elsewhere."""
    fine = (F.round(F.col("width") / dx) <= 1) & (F.round(F.col("height") / dy) <= 1)
    # the corners of all cells are found once; only coarse ones need their rings
    placed = materialise(cells.select("k", "j", "lon", "lat", fine.alias("fine"), F.when(~fine, F.col("ring")).alias("ring")), "resampled")
    coarse = cell_average(bathy, placed.where("not fine"), cut_off, limit, dry, tile).select("k", "j", "depth", F.lit("average").alias("mode"))
    return coarse.unionByName(bilinear(bathy, placed.where("fine"), lon0, lat0, dx, dy).select("k", "j", "depth", F.lit("interpolate").alias("mode")))
