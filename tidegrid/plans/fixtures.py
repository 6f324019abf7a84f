"""Grids, rasters and polygons derived from the driver's tables, in Spark and in SQL."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.geometry import point
from tidegrid.operators.grids import cells, rectilinear

#: Corners of the octagon that stands for every polygon.
OCTAGON = [(1, -0.5), (1, 0.5), (0.5, 1), (-0.5, 1), (-1, 0.5), (-1, -0.5), (-0.5, -1), (0.5, -1), (1, -0.5)]
STEP = 0.0625


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bathy(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    ilon, ilat = (F.col("event_id") % 100).cast("int"), F.floor(F.col("event_id") / 100).cast("int")
    z = (2000 - F.floor(F.col("value") * 100 + 0.5)).cast("int")
    return e.select(ilon.alias("ilon"), ilat.alias("ilat"), (ilon * STEP).alias("lon"), (ilat * STEP).alias("lat"), z.alias("z"))


def rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the base raster."""
    return (_table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] + 1) // 100


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rectilinear(spark, 0.09375, 0.25, 25, 0.09375, 0.25, rows(spark, sf_dir) // 4)


def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(grid(spark, sf_dir))


def octagon(x: Column, y: Column, r: Column) -> Column:
    return F.array(*[point(x + r * a, y + r * b) for a, b in OCTAGON])


#: A star with four points: concave, of area 1.
STAR = [(1, 0), (0.25, 0.25), (0, 1), (-0.25, 0.25), (-1, 0), (-0.25, -0.25), (0, -1), (0.25, -0.25), (1, 0)]


def _scaled(table: DataFrame, key: str, r: Column, n: int, shape: list[tuple[float, float]], level: Column | None = None) -> DataFrame:
    """``poly_id, level, ring`` of a polygon for each row.

    The centre and size are columns of their own, so that the code for a row stays small enough to be compiled.
    """
    x, y = (F.col(key) * 37 % 100) * STEP + 1 / 128, (F.col(key) * 7 % n) * STEP + 3 / 256
    at = table.select(F.col(key).alias("poly_id"), (F.lit(1) if level is None else level).alias("level"), x.alias("x"), y.alias("y"), r.alias("r"))
    return at.select("poly_id", "level", F.array(*[point(F.col("x") + F.col("r") * a, F.col("y") + F.col("r") * b) for a, b in shape]).alias("ring"))


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.floor(F.abs(F.col("c_acctbal")) * 100 + 0.5).cast("long")
    level = (F.col("c_nationkey") % 3 + 1).cast("int")
    return _scaled(_table(spark, sf_dir, "customer"), "c_custkey", (cents % 7 + 1) / 32, rows(spark, sf_dir), OCTAGON, level)


def user_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(_table(spark, sf_dir, "supplier"), "s_suppkey", (F.col("s_nationkey") % 5 + 2) / 8, rows(spark, sf_dir), OCTAGON)


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 2).cast("int").alias("flag"), F.col("s_name").alias("label"))


def shores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large concave polygons, of one to three degrees."""
    return _scaled(_table(spark, sf_dir, "supplier"), "s_suppkey", (F.col("s_nationkey") % 3 + 1).cast("double"), rows(spark, sf_dir), STAR)


def tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small stars, some of whose points touch a side of TOUCHED from outside."""
    return _scaled(_table(spark, sf_dir, "customer"), "c_custkey", (F.col("c_nationkey") % 4 + 1) / 4, rows(spark, sf_dir), STAR)


def isles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Islands smaller than a cell."""
    cents = F.floor(F.abs(F.col("c_acctbal")) * 100 + 0.5).cast("long")
    return _scaled(_table(spark, sf_dir, "customer"), "c_custkey", (cents % 7 + 1) / 128, rows(spark, sf_dir), OCTAGON)


def reefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User polygons of about a cell."""
    return _scaled(_table(spark, sf_dir, "supplier"), "s_suppkey", (F.col("s_nationkey") % 5 + 2) / 32, rows(spark, sf_dir), OCTAGON)


def coast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One polygon with a vertex for each event, as rows of edges."""
    e = _table(spark, sf_dir, "events").select(F.col("event_id").alias("i"), (2 + F.col("value") % 1).alias("r"))
    n = rows(spark, sf_dir) * 100
    at = lambda v, f: (3 + F.col("r") * f(F.col("i") * (2 * math.pi / n))).alias(v)
    a = e.where(F.col("i") < n).select("i", at("ax", F.cos), at("ay", F.sin))
    edges = a.join(a.select(F.pmod(F.col("i") - 1, F.lit(n)).alias("i"), F.col("ax").alias("bx"), F.col("ay").alias("by")), "i")
    return edges.select(F.lit("0").alias("piece"), F.lit(0).alias("poly_id"), F.lit(1).alias("level"), "i", F.lit(n).cast("long").alias("n"), "ax", "ay", "bx", "by")


BOX = (1.0, 5.0, 0.2, 4.0)
#: A box on whose sides some vertices lie.
TOUCHED = (1.0078125, 5.0078125, 0.26171875, 4.01171875)

#: The same fixtures for DuckDB, as common table expressions.
CTE = {
    "bathy": "bathy AS (SELECT (event_id % 100)::INT AS ilon, (event_id // 100)::INT AS ilat, (event_id % 100) * 0.0625::DOUBLE AS lon, (event_id // 100) * 0.0625::DOUBLE AS lat, (2000 - floor(value * 100 + 0.5))::INT AS z FROM events)",
    "size": "size AS (SELECT ((max(event_id) + 1) // 100)::BIGINT AS n FROM events)",
    "grid": "grid AS (SELECT k::INT AS k, j::INT AS j, 0.09375::DOUBLE + 0.25::DOUBLE * (j - 1) AS lon, 0.09375::DOUBLE + 0.25::DOUBLE * (k - 1) AS lat FROM (SELECT unnest(range(1, n // 4 + 1)) AS k FROM size), (SELECT unnest(range(1, 26)) AS j))",
    "poly": "poly AS (SELECT c_custkey AS poly_id, (c_nationkey % 3 + 1)::INT AS level, (c_custkey * 37 % 100) * 0.0625::DOUBLE + 1.0::DOUBLE / 128 AS x, (c_custkey * 7 % n) * 0.0625::DOUBLE + 3.0::DOUBLE / 256 AS y, (floor(abs(c_acctbal) * 100 + 0.5)::BIGINT % 7 + 1) / 32.0::DOUBLE AS r FROM customer, size)",
    "users": "users AS (SELECT s_suppkey AS poly_id, s_name, (s_suppkey * 37 % 100) * 0.0625::DOUBLE + 1.0::DOUBLE / 128 AS x, (s_suppkey * 7 % n) * 0.0625::DOUBLE + 3.0::DOUBLE / 256 AS y, (s_nationkey % 5 + 2) / 8.0::DOUBLE AS r FROM supplier, size)",
    "corner": "corner AS (SELECT * FROM (VALUES (0, 1.0::DOUBLE, -0.5::DOUBLE), (1, 1, 0.5), (2, 0.5, 1), (3, -0.5, 1), (4, -1, 0.5), (5, -1, -0.5), (6, -0.5, -1), (7, 0.5, -1), (8, 1, -0.5)) t(seq, a, b))",
    "shores": "shores AS (SELECT s_suppkey AS poly_id, (s_suppkey * 37 % 100) * 0.0625::DOUBLE + 1.0::DOUBLE / 128 AS x, (s_suppkey * 7 % n) * 0.0625::DOUBLE + 3.0::DOUBLE / 256 AS y, (s_nationkey % 3 + 1)::DOUBLE AS r FROM supplier, size)",
    "star": "star AS (SELECT poly_id, seq, x + r * a AS vx, y + r * b AS vy FROM shores, (VALUES (0, 1.0::DOUBLE, 0.0::DOUBLE), (1, 0.25, 0.25), (2, 0, 1), (3, -0.25, 0.25), (4, -1, 0), (5, -0.25, -0.25), (6, 0, -1), (7, 0.25, -0.25), (8, 1, 0)) t(seq, a, b))",
    "tip": "tip AS (SELECT c_custkey AS poly_id, seq, (c_custkey * 37 % 100) * 0.0625::DOUBLE + 1.0::DOUBLE / 128 + (c_nationkey % 4 + 1) / 4.0::DOUBLE * a AS vx, (c_custkey * 7 % n) * 0.0625::DOUBLE + 3.0::DOUBLE / 256 + (c_nationkey % 4 + 1) / 4.0::DOUBLE * b AS vy FROM customer, size, (VALUES (0, 1.0::DOUBLE, 0.0::DOUBLE), (1, 0.25, 0.25), (2, 0, 1), (3, -0.25, 0.25), (4, -1, 0), (5, -0.25, -0.25), (6, 0, -1), (7, 0.25, -0.25), (8, 1, 0)) t(seq, a, b))",
    "isles": "isles AS (SELECT c_custkey AS poly_id, 1 AS level, (c_custkey * 37 % 100) * 0.0625::DOUBLE + 1.0::DOUBLE / 128 AS x, (c_custkey * 7 % n) * 0.0625::DOUBLE + 3.0::DOUBLE / 256 AS y, (floor(abs(c_acctbal) * 100 + 0.5)::BIGINT % 7 + 1) / 128.0::DOUBLE AS r FROM customer, size)",
    "shoal": "shoal AS (SELECT poly_id, level, seq, x + r * a AS vx, y + r * b AS vy FROM isles, corner)",
    "reefs": "reefs AS (SELECT s_suppkey AS poly_id, (s_suppkey * 37 % 100) * 0.0625::DOUBLE + 1.0::DOUBLE / 128 AS x, (s_suppkey * 7 % n) * 0.0625::DOUBLE + 3.0::DOUBLE / 256 AS y, (s_nationkey % 5 + 2) / 32.0::DOUBLE AS r FROM supplier, size WHERE s_suppkey % 2 = 1)",
    "coast": "coast AS (SELECT event_id AS i, 3 + (2 + value % 1) * cos(event_id * (2 * pi() / (n * 100))) AS ax, 3 + (2 + value % 1) * sin(event_id * (2 * pi() / (n * 100))) AS ay, n * 100 AS n FROM events, size WHERE event_id < n * 100)",
    "seaavg": "seaavg AS (SELECT k, j, CASE WHEN count(z) FILTER (z <= 0) > 0.5 * count(z) THEN avg(z) FILTER (z <= 0) ELSE 999999 END AS depth FROM grid g LEFT JOIN bathy b ON b.lon BETWEEN g.lon - 0.125 AND g.lon + 0.125 AND b.lat BETWEEN g.lat - 0.125 AND g.lat + 0.125 GROUP BY k, j)",
    "sea": "sea AS (SELECT k, j, (CASE WHEN depth = 999999 THEN 0 ELSE 1 END)::INT AS mask FROM seaavg)",
    "vertex": "vertex AS (SELECT poly_id, level, seq, x + r * a AS vx, y + r * b AS vy FROM poly, corner)",
    "cellavg": "cellavg AS (SELECT k, j, count(z) AS n, count(z) FILTER (z <= 0) AS n_wet, CASE WHEN count(z) FILTER (z <= 0) > 0.7 * count(z) THEN avg(z) FILTER (z <= 0) ELSE 999999 END AS depth FROM grid g LEFT JOIN bathy b ON b.lon BETWEEN g.lon - 0.125 AND g.lon + 0.125 AND b.lat BETWEEN g.lat - 0.125 AND g.lat + 0.125 GROUP BY k, j)",
    "mask": "mask AS (SELECT k, j, (CASE WHEN depth = 999999 THEN 0 ELSE 1 END)::INT AS mask FROM cellavg)",
}
_NEEDS = {"grid": ["size"], "poly": ["size"], "users": ["size"], "shores": ["size"], "tip": ["size"], "isles": ["size"], "shoal": ["isles", "corner"], "reefs": ["size"], "coast": ["size"], "seaavg": ["grid", "bathy"], "sea": ["seaavg"], "star": ["shores"], "vertex": ["poly", "corner"], "cellavg": ["grid", "bathy"], "mask": ["cellavg"]}


def with_(*names: str, extra: str = "", recursive: bool = False) -> str:
    """A WITH clause of the named fixtures, with what they need, and more expressions."""
    order: list[str] = []

    def add(name: str) -> None:
        for x in _NEEDS.get(name, []):
            add(x)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join([*(CTE[n] for n in order), *([extra] if extra else [])]) + "\n"
