"""Target grids: ``k`` (south to north), ``j`` (west to east), both from 1, ``lon``, ``lat``."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.functions.geometry import point, unwrapped


def _nodes(spark: SparkSession, nx: int, ny: int) -> DataFrame:
    n = F.col("id")
    return spark.range(nx * ny).select((F.floor(n / nx) + 1).cast("int").alias("k"), (n % nx + 1).cast("int").alias("j"))


def rectilinear(spark: SparkSession, lon0: float, dx: float, nx: int, lat0: float, dy: float, ny: int) -> DataFrame:
    """Equally spaced nodes; coordinates are multiples of the spacing, not running sums."""
    return _nodes(spark, nx, ny).select("k", "j", (F.lit(lon0) + (F.col("j") - 1) * dx).alias("lon"), (F.lit(lat0) + (F.col("k") - 1) * dy).alias("lat"))


def annulus(spark: SparkSession, x0: float, y0: float, r0: float, dr: float, nr: int, theta0: float, dtheta: float, nt: int) -> DataFrame:
    """A part of a ring; ``j`` counts radii, ``k`` angles in degrees."""
    r, t = F.lit(r0) + (F.col("j") - 1) * dr, F.radians(F.lit(theta0) + (F.col("k") - 1) * dtheta)
    return _nodes(spark, nr, nt).select("k", "j", (x0 + r * F.cos(t)).alias("lon"), (y0 + r * F.sin(t)).alias("lat"))


def polar_inverse(df: DataFrame, radius: float = 6378.273, eccentricity: float = 0.081816153, north: bool = True) -> DataFrame:
    """``lon, lat`` of polar stereographic ``x, y`` (same unit as ``radius``), true at 70 degrees.

    Conformal latitude from the projection, then the series in powers of the eccentricity.
    """
    e2 = eccentricity**2
    true = math.radians(70)
    t_true = math.tan(math.pi / 4 - true / 2) / ((1 - eccentricity * math.sin(true)) / (1 + eccentricity * math.sin(true))) ** (eccentricity / 2)
    m_true = math.cos(true) / math.sqrt(1 - e2 * math.sin(true) ** 2)
    x, y = (F.col("x"), F.col("y")) if north else (-F.col("x"), -F.col("y"))
    rho = F.sqrt(x * x + y * y)
    chi = math.pi / 2 - 2 * F.atan(rho * t_true / (radius * m_true))
    terms = [
        e2 / 2 + 5 * e2**2 / 24 + e2**3 / 12 + 13 * e2**4 / 360,
        7 * e2**2 / 48 + 29 * e2**3 / 240 + 811 * e2**4 / 11520,
        7 * e2**3 / 120 + 81 * e2**4 / 1120,
        4279 * e2**4 / 161280,
    ]
    lat: Column = chi
    for n, c in enumerate(terms, 1):
        lat = lat + c * F.sin(2 * n * chi)
    lon = F.atan2(x, -y)
    sign = 1 if north else -1
    return df.withColumn("lon", F.pmod(F.degrees(sign * lon), F.lit(360.0))).withColumn("lat", F.degrees(sign * lat))


def polar(spark: SparkSession, lat_min: float, resolution: float, radius: float = 6378.273, eccentricity: float = 0.081816153, north: bool = True) -> DataFrame:
    """A square mesh around a pole, at half steps so that no node is the pole."""
    half = math.floor(radius * math.radians(90 - lat_min) / resolution)
    n = 2 * half + 2
    at = lambda c: (F.col(c) - 1 - half - 0.5) * resolution
    mesh = _nodes(spark, n, n).withColumn("x", at("j")).withColumn("y", at("k"))
    return polar_inverse(mesh, radius, eccentricity, north).select("k", "j", "lon", "lat")


def extent(grid: DataFrame, dx: float, dy: float) -> DataFrame:
    """P5: the box around a grid, one spacing wider on each side."""
    return grid.agg((F.min("lat") - dy).alias("lat_start"), (F.min("lon") - dx).alias("lon_start"), (F.max("lat") + dy).alias("lat_end"), (F.max("lon") + dx).alias("lon_end"))


def spacing(grid: DataFrame) -> DataFrame:
    """The least over columns of the largest step in longitude between rows."""
    step = F.abs(F.col("lon") - F.lag("lon").over(Window.partitionBy("j").orderBy("k")))
    return grid.select("j", step.alias("step")).groupBy("j").agg(F.max("step").alias("most")).agg(F.min("most").alias("spacing"))


def _mid(p: Column, x0: Column, y0: Column) -> Column:
    return F.when(p.isNotNull(), point((unwrapped(p["x"], x0) + x0) / 2, (p["y"] + y0) / 2))


def cells(grid: DataFrame, compat: bool = False) -> DataFrame:
    """Corners, ring, width, height and angle of each node's cell.

    Each node sends its place to its four diagonal neighbours, so that one shuffle
    brings every cell its corners. Missing corners mirror their opposites about the
    node; at the four corners of the grid the one known corner is mirrored in x and
    in y, or with ``compat`` turned by right angles as older grids have it.
    """
    sent = F.array(*[F.struct(F.lit(role).alias("role"), (F.col("k") + dk).alias("k"), (F.col("j") + dj).alias("j")) for role, (dk, dj) in enumerate(((0, 0), (1, -1), (-1, -1), (-1, 1), (1, 1)))])
    near = grid.select(F.explode(sent).alias("s"), "lon", "lat").select("s.role", "s.k", "s.j", "lon", "lat")
    # greatest values of numbers, not of structs, which Spark would sort all rows for
    roles = [F.max(F.when(F.col("role") == r, F.col(v))).alias(f"{a}{r}") for r in range(5) for a, v in (("x", "lon"), ("y", "lat"))]
    found = near.groupBy("k", "j").agg(*roles, F.count_if(F.col("role") == 0).alias("own")).where("own > 0")
    sides = [F.when(F.col(f"x{i}").isNotNull(), point(F.col(f"x{i}"), F.col(f"y{i}"))).alias(f"m{i}") for i in range(1, 5)]
    found = found.select("k", "j", point(F.col("x0"), F.col("y0")).alias("o"), *sides)
    x0, y0 = F.col("o.x"), F.col("o.y")
    found = found.select("k", "j", "o", *[_mid(F.col(f"m{i}"), x0, y0).alias(f"m{i}") for i in range(1, 5)])
    c = {i: F.col(f"m{i}") for i in range(1, 5)}
    mirror = lambda p: point(2 * x0 - p["x"], 2 * y0 - p["y"])
    known = sum((m.isNotNull().cast("int") for m in c.values()), F.lit(0))
    flat = {1: lambda p: point(p["x"], 2 * y0 - p["y"]), 3: lambda p: point(2 * x0 - p["x"], p["y"])}
    # of a corner node: how each corner follows from the known one
    lone = {1: {2: flat[1], 4: flat[3]}, 2: {1: flat[1], 3: flat[3]}, 3: {4: flat[1], 2: flat[3]}, 4: {3: flat[1], 1: flat[3]}}
    if compat:
        dx, dy = lambda p: p["x"] - x0, lambda p: p["y"] - y0
        turn = lambda p: point(x0 - dy(p), y0 + dx(p))
        back = lambda p: point(x0 + dy(p), y0 - dx(p))
        # fixed values: the turns used at each corner of the grid
        lone = {1: {4: turn, 2: back}, 2: {1: back, 3: turn}, 3: {4: back, 2: turn}, 4: {3: turn, 1: back}}
    corner = {}
    for i in range(1, 5):
        opposite = c[(i + 1) % 4 + 1]
        value = F.coalesce(c[i], F.when(opposite.isNotNull(), mirror(opposite)))
        for j in range(1, 5):
            if i in lone[j]:
                value = F.coalesce(value, F.when((known == 1) & c[j].isNotNull(), lone[j][i](c[j])))
        corner[i] = value.alias(f"c{i}")
    out = found.select("k", "j", x0.alias("lon"), y0.alias("lat"), *corner.values())
    gap = lambda a, b: F.sqrt(F.pow(F.col(f"{a}.x") - F.col(f"{b}.x"), 2) + F.pow(F.col(f"{a}.y") - F.col(f"{b}.y"), 2))
    return out.select(
        "*",
        F.array("c4", "c1", "c2", "c3", "c4").alias("ring"),
        gap("c1", "c4").alias("width"),
        gap("c2", "c1").alias("height"),
        F.atan2(F.col("c1.y") - F.col("c4.y"), F.col("c1.x") - F.col("c4.x")).alias("angle"),
    )
