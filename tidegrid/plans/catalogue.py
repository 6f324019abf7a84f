"""Queries over the driver's tables, one or more for each operator, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.geometry import total_length
from tidegrid.operators import bathymetry, grids, masks, nesting, obstruction, polygons, rings
from tidegrid.plans import fixtures as fx
from tidegrid.plans.fixtures import with_
from tidegrid.plans.shared import materialise, new_folder
from tidegrid.sources import netcdf, rasters, text

FLAGSHIP = "pipeline_regional"
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
#: Side of the tiles of spatial joins, in degrees; DRY is the depth of dry cells.
TILE, DRY = 1.0, 999999.0


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def micro(c: Column | str) -> Column:
    """Millionths as a whole number, so that results compare exactly."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * 1e6 + 0.5).cast("long")


def _micros(df: DataFrame, *names: str) -> DataFrame:
    return df.select("k", "j", *[micro(n).alias(n) for n in names])


# ---- grids and cells ----


@query(with_("grid") + "SELECT k, j, lon, lat FROM grid")
def grid_rectilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.grid(spark, sf_dir)


_ANNULUS = "ann AS (SELECT k::INT AS k, j::INT AS j, 10 + (1 + (j - 1) * 0.25::DOUBLE) * cos(radians((k - 1) * 0.75::DOUBLE)) AS lon, 5 + (1 + (j - 1) * 0.25::DOUBLE) * sin(radians((k - 1) * 0.75::DOUBLE)) AS lat FROM (SELECT unnest(range(1, 122)) AS k), (SELECT unnest(range(1, 122)) AS j))"


def _annulus(spark: SparkSession) -> DataFrame:
    return grids.annulus(spark, 10.0, 5.0, 1.0, 0.25, 121, 0.0, 0.75, 121)


def m(expr: str, name: str) -> str:
    return f"floor(({expr}) * 1e6 + 0.5)::BIGINT AS {name}"


@query(f"WITH {_ANNULUS} SELECT k, j, {m('lon', 'lon')}, {m('lat', 'lat')} FROM ann")
def grid_annulus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(_annulus(spark), "lon", "lat")


# Snyder's inverse by iteration, where the operator has a series
_POLAR = """
c AS (SELECT 0.081816153::DOUBLE AS e, 6378.273::DOUBLE AS a, radians(70) AS t),
q AS (SELECT e, a, tan(pi() / 4 - t / 2) / pow((1 - e * sin(t)) / (1 + e * sin(t)), e / 2) AS tt, cos(t) / sqrt(1 - e * e * sin(t) * sin(t)) AS mt FROM c),
p0 AS (SELECT k, j, x, y, e, sqrt(x * x + y * y) * tt / (a * mt) AS tau FROM xy, q),
p1 AS (SELECT *, pi() / 2 - 2 * atan(tau) AS f FROM p0),
p2 AS (SELECT * REPLACE (pi() / 2 - 2 * atan(tau * pow((1 - e * sin(f)) / (1 + e * sin(f)), e / 2)) AS f) FROM p1),
p3 AS (SELECT * REPLACE (pi() / 2 - 2 * atan(tau * pow((1 - e * sin(f)) / (1 + e * sin(f)), e / 2)) AS f) FROM p2),
p4 AS (SELECT * REPLACE (pi() / 2 - 2 * atan(tau * pow((1 - e * sin(f)) / (1 + e * sin(f)), e / 2)) AS f) FROM p3),
p5 AS (SELECT * REPLACE (pi() / 2 - 2 * atan(tau * pow((1 - e * sin(f)) / (1 + e * sin(f)), e / 2)) AS f) FROM p4),
p6 AS (SELECT * REPLACE (pi() / 2 - 2 * atan(tau * pow((1 - e * sin(f)) / (1 + e * sin(f)), e / 2)) AS f) FROM p5),
polar AS (SELECT k, j, CASE WHEN degrees(atan2(x, -y)) < 0 THEN degrees(atan2(x, -y)) + 360 ELSE degrees(atan2(x, -y)) END AS lon, degrees(f) AS lat FROM p6)
"""


@query(f"WITH xy AS (SELECT k::INT AS k, j::INT AS j, (j - 6.5::DOUBLE) * 317 AS x, (k - 6.5::DOUBLE) * 411 AS y FROM (SELECT unnest(range(1, 13)) AS k), (SELECT unnest(range(1, 13)) AS j)), {_POLAR} SELECT k, j, {m('lon', 'lon')}, {m('lat', 'lat')} FROM polar")
def polar_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    mesh = grids.rectilinear(spark, -5.5 * 317, 317.0, 12, -5.5 * 411, 411.0, 12).withColumnsRenamed({"lon": "x", "lat": "y"})
    return _micros(grids.polar_inverse(mesh), "lon", "lat")


@query(f"WITH h AS (SELECT floor(6378.273 * radians(90 - 49.9058::DOUBLE) / 40) AS h), xy AS (SELECT k::INT AS k, j::INT AS j, (j - 1.5 - h) * 40.0::DOUBLE AS x, (k - 1.5 - h) * 40.0::DOUBLE AS y FROM h, (SELECT unnest(range(1, 225)) AS k), (SELECT unnest(range(1, 225)) AS j)), {_POLAR} SELECT k, j, {m('lon', 'lon')}, {m('lat', 'lat')} FROM polar")
def polar_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(grids.polar(spark, 49.9058, 40.0), "lon", "lat")


@query(with_("grid") + "SELECT min(lat) - 0.25 AS lat_start, min(lon) - 0.25 AS lon_start, max(lat) + 0.25 AS lat_end, max(lon) + 0.25 AS lon_end FROM grid")
def grid_extent_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grids.extent(fx.grid(spark, sf_dir), 0.25, 0.25)


@query(f"WITH {_ANNULUS}, s AS (SELECT j, abs(lon - lag(lon) OVER (PARTITION BY j ORDER BY k)) AS d FROM ann) SELECT {m('min(w)', 'spacing')} FROM (SELECT max(d) AS w FROM s GROUP BY j)")
def grid_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grids.spacing(_annulus(spark)).select(micro("spacing").alias("spacing"))


_CORNERS = ", ".join(f"c{i}{a}" for i in range(1, 5) for a in "xy")


@query(with_("grid") + "SELECT k, j, lon + 0.125 AS c1x, lat - 0.125 AS c1y, lon + 0.125 AS c2x, lat + 0.125 AS c2y, lon - 0.125 AS c3x, lat + 0.125 AS c3y, lon - 0.125 AS c4x, lat - 0.125 AS c4y FROM grid")
def cell_corners_rect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.grid_cells(spark, sf_dir).select("k", "j", *[F.col(f"c{i}.{a}").alias(f"c{i}{a}") for i in range(1, 5) for a in "xy"])


# in SQL every node sees its diagonal neighbours through windows along both diagonals
_CURV = (
    f"WITH {_ANNULUS}, n AS (SELECT k, j, lon AS x, lat AS y, "
    + ", ".join(f"({f}(lon) OVER {w} + lon) / 2 AS x{i}, ({f}(lat) OVER {w} + lat) / 2 AS y{i}" for i, f, w in ((1, "lag", "p"), (2, "lead", "m"), (3, "lead", "p"), (4, "lag", "m")))
    + " FROM ann WINDOW p AS (PARTITION BY k + j ORDER BY k), m AS (PARTITION BY k - j ORDER BY k)), c AS (SELECT k, j, "
    + ", ".join(
        f"coalesce({a}{i}, 2 * {a} - {a}{(i + 1) % 4 + 1}, " + (f"{a}{s}, 2 * {a} - {a}{o})" if a == "x" else f"{a}{o}, 2 * {a} - {a}{s})") + f" AS {a}{i}"
        # of a corner node: s has the same x, o the same y
        for i, s, o in ((1, 2, 4), (2, 1, 3), (3, 4, 2), (4, 3, 1))
        for a in "xy"
    )
    + " FROM n)"
)


@query(_CURV + " SELECT k, j, " + ", ".join(m(f"{a}{i}", f"c{i}{a}") for i in range(1, 5) for a in "xy") + " FROM c")
def cell_corners_curv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grids.cells(_annulus(spark)).select("k", "j", *[micro(f"c{i}.{a}").alias(f"c{i}{a}") for i in range(1, 5) for a in "xy"])


@query(_CURV + f" SELECT k, j, {m('sqrt(pow(x1 - x4, 2) + pow(y1 - y4, 2))', 'width')}, {m('sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2))', 'height')}, {m('atan2(y1 - y4, x1 - x4)', 'angle')} FROM c")
def cell_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(grids.cells(_annulus(spark)), "width", "height", "angle")


# the grid goes over the meridian where longitudes begin again
@query(
    "WITH g AS (SELECT k::INT AS k, j::INT AS j, (350 + 2.0::DOUBLE * (j - 1)) % 360 AS lon, 40 + 1.0::DOUBLE * (k - 1) AS lat FROM (SELECT unnest(range(1, 8)) AS k), (SELECT unnest(range(1, 13)) AS j)) "
    "SELECT k, j, lon + 1 AS c1x, lat - 0.5 AS c1y, lon + 1 AS c2x, lat + 0.5 AS c2y, lon - 1 AS c3x, lat + 0.5 AS c3y, lon - 1 AS c4x, lat - 0.5 AS c4y FROM g"
)
def cell_corners_meridian(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = grids.rectilinear(spark, 350.0, 2.0, 12, 40.0, 1.0, 7).withColumn("lon", F.pmod("lon", F.lit(360.0)))
    return grids.cells(g).select("k", "j", *[F.col(f"c{i}.{a}").alias(f"c{i}{a}") for i in range(1, 5) for a in "xy"])


# ---- base raster ----


@query(with_("bathy") + "SELECT ilon, ilat, z FROM bathy WHERE ilon BETWEEN 12 AND 69 AND ilat BETWEEN 0 AND 8 + 8 AND ilat <= 17")
def bathy_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = fx.rows(spark, sf_dir)
    return bathymetry.window(fx.bathy(spark, sf_dir), 0.0, 0.0, fx.STEP, fx.STEP, 100, n, (1.25, 3.8, 0.2, 0.5), (0.25, 0.25)).select("ilon", "ilat", "z")


@query(with_("bathy") + "SELECT lon, lat, z FROM bathy")
def bathy_dedup_lon(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fx.bathy(spark, sf_dir).select("lon", "lat", "z")
    return bathymetry.unique_longitudes(b.unionByName(b.where("lon = 0").withColumn("lon", F.lit(360.0))))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of the grid, which are read several times, stored."""
    return materialise(fx.grid_cells(spark, sf_dir), "cells")


def _average(spark: SparkSession, sf_dir: str, cells: DataFrame | None = None) -> DataFrame:
    return bathymetry.cell_average(fx.bathy(spark, sf_dir), _cells(spark, sf_dir) if cells is None else cells, 0.0, 0.7, DRY, TILE)


@query(with_("cellavg") + f"SELECT k, j, n, n_wet, {m('depth', 'depth')} FROM cellavg")
def bathy_cell_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _average(spark, sf_dir).select("k", "j", "n", "n_wet", micro("depth").alias("depth"))


# the raster covers 0 to 360 degrees here: columns are 3.6 degrees apart
_ROUND = "g AS (SELECT k::INT AS k, j::INT AS j, 1.8::DOUBLE + 14.4::DOUBLE * (j - 1) AS lon, 0.09375 + 0.25 * (k - 1) AS lat FROM (SELECT unnest(range(1, n // 4 + 1)) AS k FROM size), (SELECT unnest(range(1, 26)) AS j)), w AS (SELECT (ilon * 3.6::DOUBLE + o) AS lon, lat, z FROM bathy, (VALUES (-360.0::DOUBLE), (0), (360)) t(o))"
_WRAP = with_("bathy", "size", extra=_ROUND) + f"SELECT k, j, count(z) AS n, count(z) FILTER (z <= 0) AS n_wet, {m('CASE WHEN count(z) FILTER (z <= 0) > 0.6 * count(z) THEN avg(z) FILTER (z <= 0) ELSE 999999 END', 'depth')} FROM g LEFT JOIN w ON w.lon BETWEEN g.lon - 7.2 AND g.lon + 7.2 AND w.lat BETWEEN g.lat - 0.125 AND g.lat + 0.125 GROUP BY k, j"


@query(_WRAP)
def bathy_wrap_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fx.bathy(spark, sf_dir).withColumn("lon", F.col("ilon") * 3.6)
    again = base.where("ilon = 0").withColumn("lon", F.lit(360.0))
    g = grids.rectilinear(spark, 1.8, 14.4, 25, 0.09375, 0.25, fx.rows(spark, sf_dir) // 4)
    out = bathymetry.cell_average(base.unionByName(again), grids.cells(g), 0.0, 0.6, DRY, 16.0, wrap=True)
    return out.select("k", "j", "n", "n_wet", micro("depth").alias("depth"))


_FINE = "fine AS (SELECT k::INT AS k, j::INT AS j, 0.140625 + 0.03125 * (j - 1) AS lon, 0.140625 + 0.03125 * (k - 1) AS lat FROM (SELECT unnest(range(1, 2 * n - 11)) AS k FROM size), (SELECT unnest(range(1, 121)) AS j))"


def _fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grids.rectilinear(spark, 0.140625, 0.03125, 120, 0.140625, 0.03125, 2 * fx.rows(spark, sf_dir) - 12)


def _bilinear_sql(index: str) -> str:
    four = " + ".join(f"z{a}{b} * {'fx' if a else '(1 - fx)'} * {'fy' if b else '(1 - fy)'}" for a in (0, 1) for b in (0, 1))
    joins = " ".join(f"LEFT JOIN bathy z{a}{b} ON z{a}{b}.ilon = a + {a} AND z{a}{b}.ilat = b + {b}" for a in (0, 1) for b in (0, 1))
    at = f"located AS (SELECT k, j, {index.format('lon')} AS a, {index.format('lat')} AS b, lon / 0.0625 AS u, lat / 0.0625 AS v FROM fine)"
    zs = ", ".join(f"z{a}{b}.z AS z{a}{b}" for a in (0, 1) for b in (0, 1))
    return with_("bathy", "size", extra=f"{_FINE}, {at}, p AS (SELECT k, j, u - a AS fx, v - b AS fy, {zs} FROM located {joins})") + f"SELECT k, j, {m(four, 'depth')} FROM p"


@query(_bilinear_sql("floor({} / 0.0625)::INT"))
def bathy_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(bathymetry.bilinear(fx.bathy(spark, sf_dir), _fine(spark, sf_dir), 0.0, 0.0, fx.STEP, fx.STEP), "depth")


@query(_bilinear_sql("round({} / 0.0625)::INT - 1"))
def bathy_bilinear_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(bathymetry.bilinear(fx.bathy(spark, sf_dir), _fine(spark, sf_dir), 0.0, 0.0, fx.STEP, fx.STEP, compat=True), "depth")


@query(with_("cellavg") + f"SELECT k, j, {m('depth', 'depth')}, 'average' AS mode FROM cellavg")
def bathy_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bathymetry.resample(fx.bathy(spark, sf_dir), fx.grid_cells(spark, sf_dir), 0.0, 0.0, fx.STEP, fx.STEP, 0.0, 0.7, DRY, TILE)
    return out.select("k", "j", micro("depth").alias("depth"), "mode")


@query(_bilinear_sql("floor({} / 0.0625)::INT").replace("AS depth FROM p", "AS depth, 'interpolate' AS mode FROM p"))
def bathy_auto_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1's other branch: cells finer than the base raster."""
    out = bathymetry.resample(fx.bathy(spark, sf_dir), grids.cells(_fine(spark, sf_dir)), 0.0, 0.0, fx.STEP, fx.STEP, 0.0, 0.7, DRY, TILE)
    return out.select("k", "j", micro("depth").alias("depth"), "mode")


_FINE_SQL = f"SELECT k, (j + 100)::INT AS j, depth, 'interpolate' AS mode FROM ({_bilinear_sql('floor({} / 0.0625)::INT')})"


@query(f"SELECT * FROM ({with_('cellavg')}SELECT k, j, {m('depth', 'depth')}, 'average' AS mode FROM cellavg) UNION ALL SELECT * FROM ({_FINE_SQL})")
def bathy_auto_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 on a grid with cells of both kinds: coarser than the base raster, and finer."""
    cells = fx.grid_cells(spark, sf_dir).unionByName(grids.cells(_fine(spark, sf_dir)).withColumn("j", F.col("j") + 100))
    out = bathymetry.resample(fx.bathy(spark, sf_dir), cells, 0.0, 0.0, fx.STEP, fx.STEP, 0.0, 0.7, DRY, TILE)
    return out.select("k", "j", micro("depth").alias("depth"), "mode")


_TURN = "nodes AS (SELECT k::INT AS k, j::INT AS j, 1.2::DOUBLE + 5.76::DOUBLE * (j - 1) AS lon, 0.140625 + 0.25 * (k - 1) AS lat FROM (SELECT unnest(range(1, n // 4)) AS k FROM size), (SELECT unnest(range(1, 63)) AS j)), located AS (SELECT k, j, floor(lon / 3.6)::INT AS a, floor(lat / 0.0625)::INT AS b, lon / 3.6 AS u, lat / 0.0625 AS v FROM nodes)"
_TURNED = ", ".join(f"z{a}{b}.z AS z{a}{b}" for a in (0, 1) for b in (0, 1))
_TURNS = " ".join(f"JOIN bathy z{a}{b} ON z{a}{b}.ilon = (l.a + {a}) % 100 AND z{a}{b}.ilat = l.b + {b}" for a in (0, 1) for b in (0, 1))


@query(
    with_("bathy", "size", extra=f"{_TURN}, p AS (SELECT k, j, u - a AS fx, v - b AS fy, {_TURNED} FROM located l {_TURNS})")
    + f"SELECT k, j, {m('(1 - fy) * (z00 * (1 - fx) + z10 * fx) + fy * (z01 * (1 - fx) + z11 * fx)', 'depth')} FROM p"
)
def bathy_bilinear_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raster goes round, so nodes after its last column lie between that and the first."""
    nodes = grids.rectilinear(spark, 1.2, 5.76, 62, 0.140625, 0.25, fx.rows(spark, sf_dir) // 4 - 1)
    return _micros(bathymetry.bilinear(fx.bathy(spark, sf_dir), nodes, 0.0, 0.0, 3.6, fx.STEP, wrap=100), "depth")


@query(with_("bathy") + "SELECT ilon, ilat, z FROM bathy WHERE (ilon >= 92 OR ilon <= 11) AND ilat BETWEEN 0 AND 16")
def bathy_window_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window over both ends of a raster that goes round."""
    n = fx.rows(spark, sf_dir)
    return bathymetry.window(fx.bathy(spark, sf_dir), 0.0, 0.0, 3.6, fx.STEP, 100, n, (346.0, 25.0, 0.2, 0.5), (7.2, 0.25)).select("ilon", "ilat", "z")


@query(with_("bathy") + "SELECT s.source, ilon, ilat, lon, lat, z FROM bathy, (VALUES ('etopo2'), ('own')) s(source)")
def bathy_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1e: a raster known by name, and one whose variables the caller names."""
    folder = new_folder(spark, "rasters")
    base = fx.bathy(spark, sf_dir)
    base.withColumnsRenamed({"lon": "x", "lat": "y"}).write.parquet(f"{folder}/etopo2")
    base.withColumnsRenamed({"lon": "east", "lat": "north", "z": "depth"}).write.parquet(f"{folder}/own")
    own = [rasters.read_raster(spark, folder, name, ("east", "north", "depth")).withColumn("source", F.lit(name)) for name in ("etopo2", "own")]
    return own[0].unionByName(own[1])


@query(with_("poly") + "SELECT poly_id, level FROM poly WHERE poly_id % 3 = 0")
def shoreline_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One resolution of a shoreline, here every third polygon."""
    path, shores = new_folder(spark, "shoreline"), fx.polygons(spark, sf_dir)
    rasters.write_shoreline(shores, "full", path)
    rasters.write_shoreline(shores.where("poly_id % 3 = 0"), "low", path)
    return rasters.read_shoreline(spark, path, "low").select("poly_id", "level")


# ---- polygons ----


@query(with_("poly") + "SELECT poly_id, 9 AS n, x - r AS west, x + r AS east, y - r AS south, y + r AS north, 2 * r AS width, 2 * r AS height FROM poly")
def poly_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polygons.measured(fx.polygons(spark, sf_dir)).drop("ring", "level")


@query(with_("poly") + "SELECT poly_id, level FROM poly WHERE level = 1")
def poly_level_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polygons.of_level(fx.polygons(spark, sf_dir)).select("poly_id", "level")


_OUTSIDE = "x - r > 5 OR x + r < 1 OR y - r > 4 OR y + r < 0.2"
_WITHIN = "x - r >= 1 AND x + r <= 5 AND y - r >= 0.2 AND y + r <= 4"


@query(with_("poly") + f"SELECT poly_id, CASE WHEN {_OUTSIDE} THEN 'outside' WHEN {_WITHIN} THEN 'inside' ELSE 'crossing' END AS class FROM poly")
def poly_box_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polygons.box_class(polygons.measured(fx.polygons(spark, sf_dir)), fx.BOX).select("poly_id", "class")


_FLAGGED = "f AS (SELECT poly_id, seq, vx, vy, vx BETWEEN 1 AND 5 AND vy BETWEEN 0.2 AND 4 AS w FROM vertex)"


@query(with_("vertex", extra=_FLAGGED) + "SELECT poly_id, seq, w AS in_box, w AND (vx IN (1, 5) OR vy IN (0.2, 4)) AS on_box, false AS grazing FROM f WHERE seq < 8")
def poly_vertex_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polygons.vertex_flags(fx.polygons(spark, sf_dir), fx.BOX)


_TOUCHED = "f AS (SELECT poly_id, seq, vx, vy, vx BETWEEN 1.0078125 AND 5.0078125 AND vy BETWEEN 0.26171875 AND 4.01171875 AS w FROM tip WHERE seq < 8)"


@query(
    with_("tip", extra=_TOUCHED + ", o AS (SELECT *, w AND (vx IN (1.0078125, 5.0078125) OR vy IN (0.26171875, 4.01171875)) AS e FROM f)")
    + "SELECT o.poly_id, o.seq, o.w AS in_box, o.e AS on_box, o.e AND NOT a.w AND NOT b.w AS grazing FROM o JOIN f a ON a.poly_id = o.poly_id AND a.seq = (o.seq + 7) % 8 JOIN f b ON b.poly_id = o.poly_id AND b.seq = (o.seq + 1) % 8"
)
def poly_grazing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stars some of whose points touch a side of the box from outside."""
    return polygons.vertex_flags(fx.tips(spark, sf_dir), fx.TOUCHED)


_CROSSED = _FLAGGED + ", e AS (SELECT a.poly_id, b.seq, a.vx AS ax, a.vy AS ay, b.vx AS bx, b.vy AS by_, a.w AS aw FROM f a JOIN f b ON b.poly_id = a.poly_id AND b.seq = a.seq + 1 WHERE a.w <> b.w)"


@query(with_("vertex", extra=_CROSSED) + "SELECT poly_id, seq, CASE WHEN aw THEN 'out' ELSE 'in' END AS way FROM e")
def poly_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polygons.crossings(fx.polygons(spark, sf_dir), fx.BOX).select("poly_id", "seq", "way")


_MET = _CROSSED + """, t AS (SELECT *, ay + (1 - ax) / nullif(bx - ax, 0) * (by_ - ay) AS yw, ay + (5 - ax) / nullif(bx - ax, 0) * (by_ - ay) AS ye,
  ax + (0.2 - ay) / nullif(by_ - ay, 0) * (bx - ax) AS xs, ax + (4 - ay) / nullif(by_ - ay, 0) * (bx - ax) AS xn FROM e),
p AS (SELECT poly_id, seq, CASE WHEN aw THEN 'out' ELSE 'in' END AS way,
  CASE WHEN least(ay, by_) <= 0.2 AND greatest(ay, by_) >= 0.2 AND xs BETWEEN 1 AND 5 THEN 0 WHEN least(ax, bx) <= 5 AND greatest(ax, bx) >= 5 AND ye BETWEEN 0.2 AND 4 THEN 1
    WHEN least(ay, by_) <= 4 AND greatest(ay, by_) >= 4 AND xn BETWEEN 1 AND 5 THEN 2 ELSE 3 END AS side, yw, ye, xs, xn FROM t)"""


@query(
    with_("vertex", extra=_MET)
    + f"SELECT poly_id, seq, way, {m('CASE side WHEN 0 THEN xs WHEN 1 THEN 5 WHEN 2 THEN xn ELSE 1 END', 'x')}, {m('CASE side WHEN 0 THEN 0.2 WHEN 1 THEN ye WHEN 2 THEN 4 ELSE yw END', 'y')}, {m('side + CASE side WHEN 0 THEN (xs - 1) / 4 WHEN 1 THEN (ye - 0.2) / 3.8 WHEN 2 THEN (5 - xn) / 4 ELSE (4 - yw) / 3.8 END', 'position')} FROM p"
)
def poly_edge_intersections(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = polygons.edge_points(polygons.crossings(fx.polygons(spark, sf_dir), fx.BOX), fx.BOX)
    return found.select("poly_id", "seq", "way", *[micro(c).alias(c) for c in ("x", "y", "position")])


# octagons around the meridian, whose western vertices have longitudes of almost 360; SQL counts these from below 0
_ROUND_BOX = (357.0, 359.984375, 0.2, 4.0)
_LONG = """f AS (SELECT poly_id, seq, vx - 3 AS vx, vy, vx - 3 BETWEEN -3 AND -0.015625 AND vy BETWEEN 0.2 AND 4 AS w FROM vertex),
e AS (SELECT a.poly_id, b.seq, a.vx AS ax, a.vy AS ay, b.vx AS bx, b.vy AS by_, a.w AS aw FROM f a JOIN f b ON b.poly_id = a.poly_id AND b.seq = a.seq + 1 WHERE a.w <> b.w),
t AS (SELECT *, ay + (-3 - ax) / nullif(bx - ax, 0) * (by_ - ay) AS yw, ay + (-0.015625 - ax) / nullif(bx - ax, 0) * (by_ - ay) AS ye,
  ax + (0.2 - ay) / nullif(by_ - ay, 0) * (bx - ax) AS xs, ax + (4 - ay) / nullif(by_ - ay, 0) * (bx - ax) AS xn FROM e),
p AS (SELECT poly_id, seq, CASE WHEN aw THEN 'out' ELSE 'in' END AS way,
  CASE WHEN least(ay, by_) <= 0.2 AND greatest(ay, by_) >= 0.2 AND xs BETWEEN -3 AND -0.015625 THEN 0 WHEN least(ax, bx) <= -0.015625 AND greatest(ax, bx) >= -0.015625 AND ye BETWEEN 0.2 AND 4 THEN 1
    WHEN least(ay, by_) <= 4 AND greatest(ay, by_) >= 4 AND xn BETWEEN -3 AND -0.015625 THEN 2 ELSE 3 END AS side, yw, ye, xs, xn FROM t)"""


@query(
    with_("vertex", extra=_LONG)
    + f"SELECT poly_id, seq, way, {m('360 + CASE side WHEN 0 THEN xs WHEN 1 THEN -0.015625 WHEN 2 THEN xn ELSE -3 END', 'x')}, {m('CASE side WHEN 0 THEN 0.2 WHEN 1 THEN ye WHEN 2 THEN 4 ELSE yw END', 'y')} FROM p"
)
def poly_long_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges that seem to go round the globe."""
    turned = fx.polygons(spark, sf_dir).withColumn("ring", F.transform("ring", lambda p: fx.point(F.pmod(p["x"] - 3, F.lit(360.0)), p["y"])))
    found = polygons.edge_points(polygons.crossings(turned, _ROUND_BOX), _ROUND_BOX)
    return found.select("poly_id", "seq", "way", micro("x").alias("x"), micro("y").alias("y"))


@query(with_("users") + "SELECT poly_id FROM users, size WHERE abs(3 - x) + 0.05 <= r AND abs(n * 0.03125 - y) + 0.05 <= r AND abs(3 - x) + abs(n * 0.03125 - y) + 0.1 <= 1.5 * r")
def poly_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box of a tenth of a degree in the middle, which some polygons cover."""
    y = _middle(spark, sf_dir)
    return polygons.covers_box(fx.user_polygons(spark, sf_dir), (2.95, 3.05, y - 0.05, y + 0.05)).select("poly_id")


# Sutherland and Hodgman's half-plane clipping, side by side, as an independent way
def _half_plane(src: str, dst: str, axis: str, bound: float, sign: str) -> str:
    other = "vy" if axis == "vx" else "vx"
    keep = f"{axis} {sign} {bound}"
    return f"""{dst}n AS (SELECT *, lead(vx) OVER w AS nx, lead(vy) OVER w AS ny FROM {src} WINDOW w AS (PARTITION BY poly_id ORDER BY seq)),
{dst}p AS (
  SELECT poly_id, seq * 2 AS seq, vx, vy FROM {dst}n WHERE {keep}
  UNION ALL
  SELECT poly_id, seq * 2 + 1, {'%s, vy + (%s - vx) / (nx - vx) * (ny - vy)' % (bound, bound) if axis == 'vx' else 'vx + (%s - vy) / (ny - vy) * (nx - vx), %s' % (bound, bound)}
  FROM {dst}n WHERE nx IS NOT NULL AND ({keep}) <> ({keep.replace('vx', 'nx').replace('vy', 'ny')})),
{dst} AS (
  SELECT poly_id, row_number() OVER (PARTITION BY poly_id ORDER BY z, seq) AS seq, vx, vy FROM (
    SELECT 0 AS z, * FROM {dst}p UNION ALL SELECT 1, poly_id, seq, vx, vy FROM (SELECT DISTINCT ON (poly_id) * FROM {dst}p ORDER BY poly_id, seq)))"""


def _clipped_sql(source: str, box: tuple[float, float, float, float]) -> str:
    west, east, south, north = box
    return ",\n".join(
        [
            f"cand AS (SELECT poly_id, seq, vx, vy FROM {source})",
            _half_plane("cand", "h1", "vx", west, ">="),
            _half_plane("h1", "h2", "vx", east, "<="),
            _half_plane("h2", "h3", "vy", south, ">="),
            _half_plane("h3", "h4", "vy", north, "<="),
            "l AS (SELECT poly_id, seq, vx, vy, lead(vx) OVER w AS nx, lead(vy) OVER w AS ny FROM h4 WINDOW w AS (PARTITION BY poly_id ORDER BY seq))",
        ]
    )


_AREAS = f"SELECT poly_id, {m('sum(vx * ny - nx * vy) / 2', 'area')} FROM l WHERE nx IS NOT NULL GROUP BY poly_id HAVING abs(sum(vx * ny - nx * vy)) > 1e-9"


def _areas(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("poly_id").agg(micro(F.sum(polygons.ring_area(F.col("ring")))).alias("area"))


def _row_areas(edges: DataFrame) -> DataFrame:
    return rings.areas(edges, "poly_id").select("poly_id", micro("area").alias("area"))


@query(with_("vertex", extra=_clipped_sql("vertex", fx.BOX)) + _AREAS)
def poly_clip_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _row_areas(polygons.clip_rows(fx.polygons(spark, sf_dir), fx.BOX))


@query(with_("vertex", extra=_clipped_sql("vertex WHERE poly_id IN (SELECT poly_id FROM vertex WHERE vx BETWEEN 1 AND 5 AND vy BETWEEN 0.2 AND 4)", fx.BOX)) + _AREAS)
def poly_clip_area_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only polygons with a vertex in the box; octagons are convex, so none of these loses a part."""
    return _areas(polygons.clip(fx.polygons(spark, sf_dir), fx.BOX, compat=True))


@query(with_("star", extra=_clipped_sql("star", fx.BOX)) + _AREAS)
def poly_clip_concave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stars: parts without a vertex in the box, and several parts of one polygon."""
    return _row_areas(polygons.clip_rows(fx.shores(spark, sf_dir), fx.BOX))


@query(with_("star", extra=_clipped_sql("star", fx.BOX)) + _AREAS)
def poly_two_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of two halves of a domain, put together."""
    west, east, south, north = fx.BOX
    halves = [polygons.clip_rows(fx.shores(spark, sf_dir), box) for box in ((west, 3.0, south, north), (3.0, east, south, north))]
    return _row_areas(halves[0].unionByName(halves[1]))


# in SQL a ring begins with its least vertex, and vertices that half-planes find twice are one
_ORDERED = """c AS (SELECT poly_id, seq, floor(vx * 1e6 + 0.5)::BIGINT AS x, floor(vy * 1e6 + 0.5)::BIGINT AS y FROM l
  WHERE nx IS NOT NULL AND poly_id IN (SELECT poly_id FROM l WHERE nx IS NOT NULL GROUP BY poly_id HAVING abs(sum(vx * ny - nx * vy)) > 1e-9)),
u AS (SELECT * FROM (SELECT *, lag(ROW(x, y)) OVER w AS z, last_value(ROW(x, y)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS e, row_number() OVER w AS pos FROM c WINDOW w AS (PARTITION BY poly_id ORDER BY seq))
  WHERE ROW(x, y) <> CASE WHEN pos = 1 THEN e ELSE z END),
r AS (SELECT poly_id, x, y, row_number() OVER (PARTITION BY poly_id ORDER BY seq) AS pos, count(*) OVER (PARTITION BY poly_id) AS n FROM u),
s AS (SELECT *, min_by(pos, ROW(x, y)) OVER (PARTITION BY poly_id) AS b FROM r)"""


@query(
    with_("vertex", extra=f"{_clipped_sql('vertex', fx.BOX)}, {_ORDERED}")
    + f"SELECT s.poly_id, level, 0::INT AS part, {_WITHIN.replace('x -', 'poly.x -').replace('x +', 'poly.x +').replace('y -', 'poly.y -').replace('y +', 'poly.y +')} AS whole, (pos - b + s.n) % s.n AS seq, s.x, s.y FROM s JOIN poly ON poly.poly_id = s.poly_id"
)
def poly_clip_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vertices of clipped rings in their order, from the least one on."""
    edges = polygons.clip_rows(fx.polygons(spark, sf_dir), fx.BOX)
    least = edges.groupBy("poly_id", "part").agg(F.min(F.struct(micro("ax").alias("x"), micro("ay").alias("y"), "i")).alias("b"))
    seq = F.pmod(F.col("i") - F.col("b.i"), F.col("n")).alias("seq")
    return edges.join(least, ["poly_id", "part"]).select("poly_id", "level", "part", "whole", seq, micro("ax").alias("x"), micro("ay").alias("y"))


_DENSE = """e AS (SELECT a.poly_id, a.vx AS ax, a.vy AS ay, b.vx AS bx, b.vy AS by_, sqrt(pow(b.vx - a.vx, 2) + pow(b.vy - a.vy, 2)) AS d FROM uv a JOIN uv b ON b.poly_id = a.poly_id AND b.seq = a.seq + 1),
s AS (SELECT *, CASE WHEN d > 0.5 THEN floor(d / 0.25)::INT - 1 ELSE 0 END AS ns FROM e)"""


_DENSE_SUM = ", ".join(m(f"sum(b{v} + ns * a{v.rstrip('_')} + 0.25 * (b{v} - a{v.rstrip('_')}) / d * ns * (ns + 1) / 2)", f"sum_{v.rstrip('_')}") for v in ("x", "y_"))


@query(with_("users", "corner", extra="uv AS (SELECT poly_id, seq, x + r * a AS vx, y + r * b AS vy FROM users, corner), " + _DENSE) + f"SELECT poly_id, (1 + sum(ns + 1))::INT AS points, {_DENSE_SUM} FROM s GROUP BY poly_id")
def poly_densify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many points, and where they are on the whole."""
    total = lambda v: micro(F.aggregate(F.slice("ring", 2, F.size("ring") - 1), F.lit(0.0), lambda s, p: s + p[v])).alias(f"sum_{v}")
    return polygons.densify(fx.user_polygons(spark, sf_dir)).select("poly_id", F.size("ring").alias("points"), total("x"), total("y"))


@query(
    with_("users", extra="b AS (SELECT poly_id, floor(x - r) AS w, ceil(x + r) AS e, floor(y - r) AS s, ceil(y + r) AS n FROM users WHERE 2 * r > 0.75), c AS (SELECT *, unnest(range(0, ceil((e - w) / 0.75)::INT)) AS a FROM b), t AS (SELECT *, unnest(range(0, ceil((n - s) / 0.75)::INT)) AS o FROM c)")
    + "SELECT poly_id, w + a * 0.75 AS west, least(w + (a + 1) * 0.75, e) AS east, s + o * 0.75 AS south, least(s + (o + 1) * 0.75, n) AS north FROM t"
)
def poly_split_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = polygons.measured(fx.user_polygons(spark, sf_dir))
    ends = [F.col(c).cast("double").alias(n) for c, n in (("tx.a", "west"), ("tx.b", "east"), ("ty.a", "south"), ("ty.b", "north"))]
    return polygons.split_tiles(known, 0.75).select("poly_id", *ends)


@query(with_("shores") + f"SELECT poly_id, {m('r * r', 'area')} FROM shores")
def poly_split_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stars cut at tiles, in many of which they have no vertex: the pieces make up the whole."""
    return _row_areas(polygons.split_rows(fx.shores(spark, sf_dir), 0.75))


@query(
    with_("coast", extra="e AS (SELECT a.ax, a.ay, b.ax AS bx, b.ay AS by_ FROM coast a JOIN coast b ON b.i = (a.i + 1) % a.n), t AS (SELECT floor(ax / 0.75)::INT AS tx, floor(ay / 0.75)::INT AS ty FROM coast)")
    + f"SELECT {m('sum(ax * by_ - bx * ay) / 2', 'area')}, (SELECT count(DISTINCT ROW(tx, ty)) FROM t) AS shore_tiles, (SELECT count(*) FROM t) AS vertices FROM e"
)
def poly_split_coast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A polygon with as many vertices as there are events: the area of its tiles, the tiles that have vertices, and these."""
    edges = materialise(fx.coast(spark, sf_dir), "coast")
    tiles = materialise(rings.split_edges(edges, 0.75), "tiles")
    own = tiles.join(edges.select("ax", "ay"), ["ax", "ay"], "left_semi")
    tile = F.struct(F.floor(F.col("ax") / 0.75), F.floor(F.col("ay") / 0.75))
    return tiles.agg(micro(F.sum(F.expr("ax * by - bx * ay")) / 2).alias("area")).crossJoin(own.agg(F.countDistinct(tile).alias("shore_tiles"), F.countDistinct("ax", "ay").alias("vertices")))


@query(with_("users") + "SELECT poly_id, s_name AS label FROM users WHERE poly_id % 2 = 1")
def user_polygon_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polygons.enabled(fx.user_polygons(spark, sf_dir), fx.flags(spark, sf_dir)).select("poly_id", "label")


# ---- masks ----


def _mask(spark: SparkSession, sf_dir: str, cells: DataFrame | None = None) -> DataFrame:
    return masks.initial_mask(_average(spark, sf_dir, cells), DRY).select("k", "j", "mask")


@query(with_("mask") + "SELECT k, j, mask FROM mask")
def mask_init(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mask(spark, sf_dir)


_SAMPLES = "sample AS (SELECT k, j, lon, lat, pt::INT AS pt, lon - 0.125 + 0.25 * (pt % 6) / 5 AS x, lat - 0.125 + 0.25 * (pt // 6) / 5 AS y FROM grid, (SELECT unnest(range(0, 36)) AS pt))"


@query(with_("grid", extra=_SAMPLES) + f"SELECT k, j, pt, {m('x', 'x')}, {m('y', 'y')} FROM sample")
def mask_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.samples(fx.grid_cells(spark, sf_dir)).select("k", "j", "pt", micro("x").alias("x"), micro("y").alias("y"))


def _clean_sql(src: str, dst: str, shapes: str) -> str:
    octagon = "abs(s.x - p.x) <= r AND abs(s.y - p.y) <= r AND abs(s.x - p.x) + abs(s.y - p.y) <= 1.5 * r"
    near = "s.lon BETWEEN p.x - r - 0.25 AND p.x + r + 0.25 AND s.lat BETWEEN p.y - r - 0.25 AND p.y + r + 0.25"
    return f"""{dst}c AS (SELECT s.k, s.j, count(DISTINCT pt) AS n FROM sample s JOIN {src} m ON m.k = s.k AND m.j = s.j AND m.mask = 1 JOIN {shapes} p ON {near} AND {octagon} GROUP BY s.k, s.j),
{dst} AS (SELECT m.k, m.j, (CASE WHEN round(n / 36 * 10) / 10 >= 0.3 THEN 0 ELSE mask END)::INT AS mask FROM {src} m LEFT JOIN {dst}c c ON c.k = m.k AND c.j = m.j)"""


_LAND = "land AS (SELECT * FROM poly WHERE level = 1)"
_USED = "used AS (SELECT * FROM users WHERE poly_id % 2 = 1)"
_CLEAN = f"{_SAMPLES}, {_LAND}, {_clean_sql('mask', 'clean', 'land')}"
_CLEAN2 = f"{_CLEAN}, {_USED}, {_clean_sql('clean', 'clean2', 'used')}"


def _cleaned(spark: SparkSession, sf_dir: str, cells: DataFrame) -> DataFrame:
    land = polygons.of_level(fx.polygons(spark, sf_dir))
    return masks.clean_mask(cells, materialise(_mask(spark, sf_dir, cells), "mask"), land, 0.3, 0.25, TILE)


def _enabled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: the user polygons that are switched on."""
    return polygons.enabled(fx.user_polygons(spark, sf_dir), fx.flags(spark, sf_dir)).select("poly_id", "ring")


@query(with_("mask", "poly", extra=_CLEAN) + "SELECT k, j, mask FROM clean")
def mask_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir, _cells(spark, sf_dir))


@query(with_("mask", "poly", "users", extra=_CLEAN2) + "SELECT k, j, mask FROM clean2")
def mask_clean_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir)
    return masks.clean_mask(cells, materialise(_cleaned(spark, sf_dir, cells), "mask"), _enabled(spark, sf_dir), 0.3, 0.25, TILE)


# ---- water bodies of the base raster ----


def _bodies_sql(mask: str, nx: int, wrap: bool = False) -> str:
    right = f"(a.j = {nx} AND b.j = 1) OR " if wrap else ""
    return f"""ny AS (SELECT max(k) AS ny FROM {mask}),
wet AS (SELECT k, j, (j - 1) * ny + k AS lin FROM {mask}, ny WHERE mask = 1),
half AS (SELECT a.lin AS a, b.lin AS b FROM wet a JOIN wet b ON a.k = b.k AND ({right}b.j = a.j + 1) UNION ALL SELECT a.lin, b.lin FROM wet a JOIN wet b ON a.j = b.j AND b.k = a.k + 1),
edges AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
cc(lin, c) USING KEY (lin) AS (
  SELECT lin, lin FROM wet
  UNION
  SELECT e.b, min(cc.c) FROM cc JOIN edges e ON e.a = cc.lin JOIN recurring.cc r ON r.lin = e.b WHERE cc.c < r.c GROUP BY e.b),
body AS (SELECT w.k, w.j, dense_rank() OVER (ORDER BY c)::INT AS body_id FROM wet w JOIN cc ON cc.lin = w.lin)"""


_RASTER = "rmask AS (SELECT (ilat + 1)::INT AS k, (ilon + 1)::INT AS j, (CASE WHEN z <= 0 THEN 1 ELSE 0 END)::INT AS mask FROM bathy)"
_BODIES = with_("bathy", extra=f"{_RASTER}, {_bodies_sql('rmask', 100)}", recursive=True)
_ALL_BODIES = "SELECT m.k, m.j, coalesce(body_id, -1)::INT AS body_id FROM rmask m LEFT JOIN body b ON b.k = m.k AND b.j = m.j"


def _raster_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.bathy(spark, sf_dir).select((F.col("ilat") + 1).alias("k"), (F.col("ilon") + 1).alias("j"), F.when(F.col("z") <= 0, 1).otherwise(0).alias("mask"))


def _bodies(spark: SparkSession, sf_dir: str, wrap: bool = False) -> DataFrame:
    return masks.water_bodies(_raster_mask(spark, sf_dir), 100, fx.rows(spark, sf_dir), wrap)


@query(_BODIES + _ALL_BODIES)
def water_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bodies(spark, sf_dir)


@query(with_("bathy", extra=f"{_RASTER}, {_bodies_sql('rmask', 100, True)}", recursive=True) + _ALL_BODIES)
def water_bodies_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bodies(spark, sf_dir, wrap=True)


@query(_BODIES + "SELECT body_id, count(*) AS cells FROM body GROUP BY body_id")
def water_body_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.body_sizes(_bodies(spark, sf_dir))


_KEEP = "SELECT m.k, m.j, (CASE WHEN body_id IN ({}) THEN 1 ELSE 0 END)::INT AS mask FROM rmask m LEFT JOIN body b ON b.k = m.k AND b.j = m.j"


@query(_BODIES + _KEEP.format("SELECT body_id FROM body GROUP BY body_id ORDER BY count(*) DESC, body_id LIMIT 1"))
def lake_largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.keep_bodies(_bodies(spark, sf_dir), -1)


@query(_BODIES + _KEEP.format("SELECT body_id FROM body GROUP BY body_id HAVING count(*) >= 5"))
def lake_min_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.keep_bodies(_bodies(spark, sf_dir), 5)


@query(_BODIES + "SELECT m.k, m.j, (CASE WHEN body_id IN (2, 3, 5) OR body_id IN (SELECT body_id FROM body GROUP BY body_id ORDER BY count(*) DESC, body_id LIMIT 1) THEN 1 ELSE 0 END)::INT AS mask FROM rmask m LEFT JOIN body b ON b.k = m.k AND b.j = m.j")
def lake_enable(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = materialise(_bodies(spark, sf_dir), "bodies")
    return masks.enable_bodies(masks.keep_bodies(bodies, -1), bodies, [2, 3, 5])


# ---- obstruction ----


def _extents_sql(mask: str, shapes: str = "vertex") -> str:
    span = lambda v, c: f"greatest(0, least(1, (min({v}) - ({c} - 0.125)) / 0.25)) AS {{0}}_lo, greatest(0, least(1, (max({v}) - ({c} - 0.125)) / 0.25)) AS {{0}}_hi"
    return f"ext AS (SELECT g.k, g.j, poly_id, {span('vy', 'lat').format('x')}, {span('vx', 'lon').format('y')} FROM grid g JOIN {mask} m ON m.k = g.k AND m.j = g.j AND m.mask <> 0 JOIN {shapes} ON vx BETWEEN lon - 0.125 AND lon + 0.125 AND vy BETWEEN lat - 0.125 AND lat + 0.125 GROUP BY g.k, g.j, poly_id, lon, lat)"


def _merge_sql(axis: str) -> str:
    along, across = ("j", "k") if axis == "x" else ("k", "j")
    t = f"e{axis}"
    return f"""{t} AS (SELECT {across} AS c, {along} AS s, poly_id, {axis}_lo AS lo, {axis}_hi AS hi, row_number() OVER (PARTITION BY {across}, poly_id ORDER BY {along}) AS rn FROM ext),
f{axis}(c, poly_id, rn, s, lo, hi) AS (
  SELECT c, poly_id, rn, s, lo, hi FROM {t} WHERE rn = 1
  UNION ALL
  SELECT e.c, e.poly_id, e.rn, CASE WHEN e.s = f.s + 1 AND f.hi - f.lo >= e.hi - e.lo THEN f.s ELSE e.s END,
    CASE WHEN e.s = f.s + 1 THEN least(e.lo, f.lo) ELSE e.lo END, CASE WHEN e.s = f.s + 1 THEN greatest(e.hi, f.hi) ELSE e.hi END
  FROM f{axis} f JOIN {t} e ON e.c = f.c AND e.poly_id = f.poly_id AND e.rn = f.rn + 1),
merged{axis} AS (SELECT c AS {across}, s AS {along}, poly_id, lo, hi FROM f{axis} f WHERE NOT EXISTS (SELECT 1 FROM {t} e WHERE e.c = f.c AND e.poly_id = f.poly_id AND e.rn = f.rn + 1 AND e.s = f.s + 1)),
i{axis} AS (SELECT k, j, lo, hi, sum(n) OVER (PARTITION BY k, j ORDER BY lo, hi, poly_id ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN lo <= max(hi) OVER (PARTITION BY k, j ORDER BY lo, hi, poly_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM merged{axis})),
net{axis} AS (SELECT k, j, min(lo) AS lo, max(hi) AS hi FROM i{axis} GROUP BY k, j, g)"""


def _value_sql(axis: str, mask: str, before: int, after: int) -> str:
    dk, dj = (0, 1) if axis == "x" else (1, 0)
    out, src = [], f"net{axis}"
    for name, sign in (("b", -1),) * before + (("a", 1),) * after:
        at = f"t.k = s.k + {sign * dk} AND t.j = s.j + {sign * dj}"
        t = f"cut{name}{axis}"
        out.append(f"{t}o AS (SELECT * FROM {src} s WHERE NOT EXISTS (SELECT 1 FROM net{axis} t WHERE {at} AND t.lo <= s.lo AND t.hi >= s.hi))")
        out.append(f"{t} AS (SELECT * FROM {t}o UNION ALL SELECT s.k, s.j, t.lo, t.hi FROM (SELECT DISTINCT k, j FROM {t}o) s JOIN net{axis} t ON {at} WHERE NOT EXISTS (SELECT 1 FROM {t}o o WHERE o.k = s.k AND o.j = s.j AND o.lo <= t.lo AND o.hi >= t.hi))")
        src = t
    out.append(f"gain{axis} AS (SELECT k, j, greatest(0, hi - greatest(lo, coalesce(max(hi) OVER (PARTITION BY k, j ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lo))) AS d FROM {src})")
    out.append(f"sum{axis} AS (SELECT k, j, sum(d) AS v FROM gain{axis} GROUP BY k, j)")
    out.append(
        f"val{axis} AS (SELECT m.k, m.j, CASE WHEN m.mask = 0 OR l.mask = 0 OR r.mask = 0 THEN 0 ELSE coalesce(v, 0) END AS v FROM {mask} m LEFT JOIN {mask} l ON l.k = m.k - {dk} AND l.j = m.j - {dj} LEFT JOIN {mask} r ON r.k = m.k + {dk} AND r.j = m.j + {dj} LEFT JOIN sum{axis} s ON s.k = m.k AND s.j = m.j)"
    )
    return ", ".join(out)


def _obstr_sql(before: int, after: int) -> str:
    extra = ", ".join([_extents_sql("mask"), _merge_sql("x"), _merge_sql("y"), _value_sql("x", "mask", before, after), _value_sql("y", "mask", before, after)])
    return with_("mask", "vertex", extra=extra, recursive=True) + f"SELECT x.k, x.j, {m('x.v', 'sx')}, {m('y.v', 'sy')} FROM valx x JOIN valy y ON y.k = x.k AND y.j = x.j"


def _extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir)
    return obstruction.extents(fx.polygons(spark, sf_dir), cells, _mask(spark, sf_dir, cells), TILE)


def _obstr(spark: SparkSession, sf_dir: str, before: int, after: int) -> DataFrame:
    cells = _cells(spark, sf_dir)
    mask = materialise(_mask(spark, sf_dir, cells), "mask")
    out = obstruction.sub_grid(fx.polygons(spark, sf_dir), cells, mask, TILE, before, after)
    return _micros(out, "sx", "sy")


@query(with_("mask", "vertex", extra=_extents_sql("mask")) + "SELECT k, j, poly_id, x_lo, x_hi, y_lo, y_hi FROM ext")
def obstr_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extents(spark, sf_dir)


def _merged_sql(axis: str, tail: str) -> str:
    return with_("mask", "vertex", extra=f"{_extents_sql('mask')}, {_merge_sql(axis)}", recursive=True) + tail


@query(_merged_sql("x", "SELECT k, j, poly_id, lo, hi FROM mergedx"))
def obstr_neighbor_merge_x(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obstruction.merge_neighbours(_extents(spark, sf_dir), "x")


@query(_merged_sql("y", "SELECT k, j, poly_id, lo, hi FROM mergedy"))
def obstr_neighbor_merge_y(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obstruction.merge_neighbours(_extents(spark, sf_dir), "y")


@query(_merged_sql("x", f"SELECT k, j, count(*)::INT AS segments, {m('sum(hi - lo)', 'total')} FROM netx GROUP BY k, j"))
def obstr_net_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = obstruction.net_segments(obstruction.merge_neighbours(_extents(spark, sf_dir), "x"))
    return net.select("k", "j", F.size("segs").alias("segments"), micro(total_length(F.col("segs"))).alias("total"))


@query(_obstr_sql(0, 0))
def obstr_ob0(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _obstr(spark, sf_dir, 0, 0)


@query(_obstr_sql(1, 0))
def obstr_ob1_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _obstr(spark, sf_dir, 1, 0)


@query(_obstr_sql(0, 1))
def obstr_ob1_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _obstr(spark, sf_dir, 0, 1)


@query(_obstr_sql(1, 1))
def obstr_ob2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _obstr(spark, sf_dir, 1, 1)


@query(with_("mask") + "SELECT m.k, m.j, coalesce(m.mask = 0 OR l.mask = 0 OR r.mask = 0, false) AS reset FROM mask m LEFT JOIN mask l ON l.k = m.k AND l.j = m.j - 1 LEFT JOIN mask r ON r.k = m.k AND r.j = m.j + 1")
def obstr_dry_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells whose obstruction along x is reset, seen through full obstruction everywhere."""
    mask = materialise(_mask(spark, sf_dir), "mask")
    full = mask.select("k", "j", F.expr("array(struct(0D AS lo, 1D AS hi))").alias("segs"))
    return obstruction.obstruction(mask, mask, full, "x").select("k", "j", (F.col("value") == 0).alias("reset"))


# ---- nesting and reconciliation ----


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(fx.grid(spark, sf_dir).join(_mask(spark, sf_dir), ["k", "j"]), "placed")


def _middle(spark: SparkSession, sf_dir: str) -> float:
    return fx.rows(spark, sf_dir) * fx.STEP / 2


def _zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nesting.zone(_placed(spark, sf_dir), fx.octagon(F.lit(3.0), F.lit(_middle(spark, sf_dir)), F.lit(2.0)))


_ZONE = "zone AS (SELECT g.k, g.j, lon, lat, (CASE WHEN abs(lon - 3) <= 2 AND abs(lat - n * 0.03125) <= 2 AND abs(lon - 3) + abs(lat - n * 0.03125) <= 3 THEN mask ELSE 3 END)::INT AS mask FROM grid g JOIN mask USING (k, j), size)"


def _boundary_sql(src: str, dst: str) -> str:
    beside = " OR ".join(f"EXISTS (SELECT 1 FROM {dst}e n WHERE n.k = e.k + {a} AND n.j = e.j + {b} AND n.mask = 1)" for a, b in ((0, 1), (0, -1), (1, 0), (-1, 0)))
    return f"""{dst}e AS (SELECT k, j, lon, lat, (CASE WHEN mask = 1 AND (k IN (1, n // 4) OR j IN (1, 25)) THEN 2 ELSE mask END)::INT AS mask FROM {src}, size),
{dst} AS (SELECT k, j, lon, lat, (CASE WHEN mask = 3 AND ({beside}) THEN 2 ELSE mask END)::INT AS mask FROM {dst}e e)"""


@query(with_("mask", extra=_ZONE) + "SELECT k, j, mask FROM zone")
def zone_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zone(spark, sf_dir).select("k", "j", "mask")


def _bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nesting.boundary(_zone(spark, sf_dir), 25, fx.rows(spark, sf_dir) // 4)


@query(with_("mask", extra=f"{_ZONE}, {_boundary_sql('zone', 'bound')}") + "SELECT k, j, mask FROM bound")
def nested_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bounded(spark, sf_dir).select("k", "j", "mask")


_PARENT = "parent AS (SELECT ((ilat - 4) // 8 + 1)::INT AS k, ((ilon - 4) // 8 + 1)::INT AS j, (CASE WHEN z <= 0 THEN 1 ELSE 0 END)::INT AS mask FROM bathy WHERE ilat >= 4 AND ilon >= 4 AND (ilat - 4) % 8 = 0 AND (ilon - 4) % 8 = 0 AND ilon < 100 AND (ilat - 4) // 8 < (SELECT n // 8 FROM size))"


def _support_sql(src: str, dst: str) -> str:
    snap = lambda r, n: f"CASE WHEN floor({r}) = -1 AND 1 - ({r} - floor({r})) < 0.05 THEN 1 WHEN floor({r}) + 1 = {n} AND {r} - floor({r}) < 0.05 THEN {n} - 1 WHEN floor({r}) >= 0 AND floor({r}) + 1 <= {n} - 1 THEN floor({r}) + 1 END"
    frac = lambda r, n: f"CASE WHEN floor({r}) = -1 AND 1 - ({r} - floor({r})) < 0.05 THEN 0 WHEN floor({r}) + 1 = {n} AND {r} - floor({r}) < 0.05 THEN 1 WHEN floor({r}) >= 0 AND floor({r}) + 1 <= {n} - 1 THEN {r} - floor({r}) END"
    bad = " OR ".join(
        f"({'wx' if i else '(1 - wx)'} * {'wy' if n else '(1 - wy)'} >= 0.05 AND NOT EXISTS (SELECT 1 FROM parent p WHERE p.k = py + {n} AND p.j = px + {i} AND p.mask IN (1, 2)))" for i in (0, 1) for n in (0, 1)
    )
    return f"""{dst}r AS (SELECT *, (lon - 0.25) / 0.5 AS rx, (lat - 0.25) / 0.5 AS ry FROM {src}),
{dst}p AS (SELECT *, {snap('rx', '12')} AS px, {frac('rx', '12')} AS wx, {snap('ry', '(SELECT n // 8 FROM size)')} AS py, {frac('ry', '(SELECT n // 8 FROM size)')} AS wy FROM {dst}r),
{dst} AS (SELECT k, j, lon, lat, (CASE WHEN mask = 2 AND (px IS NULL OR py IS NULL OR {bad}) THEN 3 ELSE mask END)::INT AS mask FROM {dst}p)"""


def _parent(spark: SparkSession, sf_dir: str, wet: int = 0) -> DataFrame:
    """A coarse parent grid: its nodes are every eighth of the raster's, wet up to a depth."""
    at = fx.bathy(spark, sf_dir).where("ilat >= 4 and ilon >= 4 and (ilat - 4) % 8 = 0 and (ilon - 4) % 8 = 0")
    parent = at.select(F.expr("cast((ilat - 4) div 8 + 1 as int)").alias("k"), F.expr("cast((ilon - 4) div 8 + 1 as int)").alias("j"), F.when(F.col("z") <= wet, 1).otherwise(0).alias("mask"))
    return parent.where((F.col("k") <= fx.rows(spark, sf_dir) // 8) & (F.col("j") <= 12))


def _supported(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nesting.parent_support(_bounded(spark, sf_dir), _parent(spark, sf_dir), 0.25, 0.25, 0.5, 0.5, 12, fx.rows(spark, sf_dir) // 8)


_NESTED = f"{_ZONE}, {_boundary_sql('zone', 'bound')}, {_PARENT}, {_support_sql('bound', 'nest')}"


@query(with_("mask", extra=_NESTED) + "SELECT k, j, mask FROM nest")
def nested_parent_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supported(spark, sf_dir).select("k", "j", "mask")


# the grid goes round the globe here, and its parent has twelve columns from 15 degrees; the zone lies across the seam
_AROUND = "around AS (SELECT k, j, (309.6::DOUBLE + 14.4::DOUBLE * (j - 1)) % 360 AS lon, lat, mask FROM bound)"


def _around_sql() -> str:
    low, weights = "floor(rx)::INT", {0: "(1 - (rx - floor(rx)))", 1: "(rx - floor(rx))"}
    bad = " OR ".join(
        f"({weights[i]} * {'wy' if n else '(1 - wy)'} >= 0.05 AND NOT EXISTS (SELECT 1 FROM parent p WHERE p.k = py + {n} AND p.j = (({low} + {i}) % 12 + 12) % 12 + 1 AND p.mask IN (1, 2)))" for i in (0, 1) for n in (0, 1)
    )
    return _support_sql("around", "unused").split("unused AS")[0].replace("(lon - 0.25) / 0.5 AS rx", "(lon - 15) / 30 AS rx") + f"turned AS (SELECT k, j, (CASE WHEN mask = 2 AND (py IS NULL OR {bad}) THEN 3 ELSE mask END)::INT AS mask FROM unusedp)"


@query(with_("mask", extra=f"{_ZONE}, {_boundary_sql('zone', 'bound')}, {_PARENT.replace('z <= 0', 'z <= 1500')}, {_AROUND}, {_around_sql()}") + "SELECT k, j, mask FROM turned")
def nested_parent_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parent that closes in longitude, between whose last and first column some boundary nodes lie."""
    return _around(spark, sf_dir, wrap=True).select("k", "j", "mask")


def _around(spark: SparkSession, sf_dir: str, wrap: bool) -> DataFrame:
    around = _bounded(spark, sf_dir).withColumn("lon", F.pmod(F.lit(309.6) + 14.4 * (F.col("j") - 1), F.lit(360.0)))
    return nesting.parent_support(around, _parent(spark, sf_dir, 1500), 15.0, 0.25, 30.0, 0.5, 12, fx.rows(spark, sf_dir) // 8, wrap=wrap)


_ZONE2 = "zone2 AS (SELECT g.k, g.j, lon, lat, (CASE WHEN lon BETWEEN 4 AND 6 AND lat BETWEEN 0 AND 1.5 THEN mask ELSE 3 END)::INT AS mask FROM grid g JOIN mask USING (k, j))"
_OVER = "SELECT a.k, a.j, (CASE WHEN b.mask <> 3 THEN b.mask ELSE a.mask END)::INT AS mask FROM {} a JOIN {} b ON b.k = a.k AND b.j = a.j"


def _rectangle(spark: SparkSession, sf_dir: str) -> DataFrame:
    corners = [(4.0, 0.0), (6.0, 0.0), (6.0, 1.5), (4.0, 1.5), (4.0, 0.0)]
    return nesting.zone(_placed(spark, sf_dir), F.array(*[fx.point(x, y) for x, y in corners]))


@query(with_("mask", extra=f"{_ZONE}, {_ZONE2}") + _OVER.format("zone", "zone2"))
def zone_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nesting.overlay(_zone(spark, sf_dir), _rectangle(spark, sf_dir)).select("k", "j", "mask")


_PEER = "peer AS (SELECT k, j, (CASE WHEN count(*) FILTER (z <= -1500) * 2 > count(*) THEN 1 ELSE 0 END)::INT AS mask FROM grid g JOIN bathy b ON b.lon BETWEEN g.lon - 0.125 AND g.lon + 0.125 AND b.lat BETWEEN g.lat - 0.125 AND g.lat + 0.125 GROUP BY k, j)"


def _both(a: DataFrame, b: DataFrame) -> DataFrame:
    of = lambda df, n: df.select(F.lit(n).alias("side"), "k", "j", F.col("mask").cast("int").alias("mask"))
    return of(a, 1).unionByName(of(b, 2))


@query(with_("mask", extra=f"{_PEER}, n AS (SELECT m.k, m.j, (CASE WHEN m.mask <> p.mask THEN 0 ELSE m.mask END)::INT AS mask FROM mask m JOIN peer p ON p.k = m.k AND p.j = m.j)") + "SELECT s::INT AS side, k, j, mask FROM n, (VALUES (1), (2)) t(s)")
def reconcile_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    peer = bathymetry.cell_average(fx.bathy(spark, sf_dir), fx.grid_cells(spark, sf_dir), -1500.0, 0.5, DRY, TILE)
    peer = fx.grid(spark, sf_dir).join(masks.initial_mask(peer, DRY).select("k", "j", "mask"), ["k", "j"])
    return _both(*nesting.reconcile(_placed(spark, sf_dir), peer, (0.25, 0.25)))


_MANY = """small AS (SELECT (ilat - 1)::INT AS k, (ilon - 1)::INT AS j, lon, lat, (CASE WHEN z <= 0 THEN 1 ELSE 0 END)::INT AS v FROM bathy, size WHERE ilon BETWEEN 2 AND 21 AND ilat BETWEEN 2 AND n // 8 + 1),
met AS (SELECT s.k, s.j, s.v, g.k AS bk, g.j AS bj, m.mask AS b FROM small s JOIN grid g ON abs(g.lon - s.lon) < 0.125 AND abs(g.lat - s.lat) < 0.125 JOIN mask m ON m.k = g.k AND m.j = g.j),
first AS (SELECT bk, bj, min((j, k)) AS f FROM met WHERE v <> b GROUP BY bk, bj),
done AS (SELECT met.k, met.j, (CASE WHEN f IS NOT NULL AND (met.j, met.k) >= f THEN 0 ELSE v END)::INT AS mask FROM met LEFT JOIN first USING (bk, bj))"""


@query(with_("mask", extra=_MANY) + "SELECT 1::INT AS side, k, j, mask FROM done UNION ALL SELECT 2::INT, m.k, m.j, (CASE WHEN f IS NOT NULL THEN 0 ELSE mask END)::INT FROM mask m LEFT JOIN first ON bk = m.k AND bj = m.j")
def reconcile_many_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small fine grid, a part of the raster so that it has fewer nodes than the other and drives."""
    n = fx.rows(spark, sf_dir)
    small = fx.bathy(spark, sf_dir).where(f"ilon between 2 and 21 and ilat between 2 and {n // 8 + 1}")
    small = small.select((F.col("ilat") - 1).alias("k"), (F.col("ilon") - 1).alias("j"), "lon", "lat", F.when(F.col("z") <= 0, 1).otherwise(0).alias("mask"))
    return _both(*nesting.reconcile(small, _placed(spark, sf_dir), (0.25, 0.25)))


# ---- text formats ----


@query(with_("mask") + "SELECT k, string_agg(' ' || mask || ' ', '' ORDER BY j) AS line FROM mask GROUP BY k")
def ascii_mask_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.lines(_mask(spark, sf_dir), "mask").select("k", "line")


_PAIR = "pair AS (SELECT k, j, mask * 7 AS sx, mask * 3 + 1 AS sy FROM mask)"


@query(with_("mask", extra=_PAIR) + "SELECT 0::INT AS block, k, string_agg(' ' || sx || ' ', '' ORDER BY j) AS line FROM pair GROUP BY k UNION ALL SELECT 0::INT, (max(k) + 1)::INT, '' FROM pair UNION ALL SELECT 1::INT, k, string_agg(' ' || sy || ' ', '' ORDER BY j) FROM pair GROUP BY k")
def ascii_obstr_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = _mask(spark, sf_dir).select("k", "j", (F.col("mask") * 7).alias("sx"), (F.col("mask") * 3 + 1).alias("sy"))
    return text.obstruction_lines(mask)


@query(with_("mask") + "SELECT k, j, mask::BIGINT AS mask FROM mask")
def mask_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "mask")
    text.write_lines(text.lines(_mask(spark, sf_dir), "mask"), path)
    return text.read_block(spark, path, 25, fx.rows(spark, sf_dir) // 4).select("k", "j", F.col("value").alias("mask"))


@query(with_("mask", extra=_PAIR) + "SELECT s::INT AS block, k, j, (CASE s WHEN 0 THEN sx ELSE sy END)::BIGINT AS value FROM pair, (VALUES (0), (1)) t(s)")
def obstr_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "obstr")
    text.write_lines(ascii_obstr_lines(spark, sf_dir), path)
    return text.read_block(spark, path, 25, fx.rows(spark, sf_dir) // 4)


@query(with_("size", "corner") + f"SELECT seq::INT AS seq, {m('3 + 2 * a', 'x')}, {m('n * 0.03125 + 2 * b', 'y')} FROM corner, size")
def zone_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone written as lines of longitude and latitude, and read as a ring."""
    ring = fx.octagon(F.lit(3.0), F.lit(_middle(spark, sf_dir)), F.lit(2.0))
    points = spark.range(1).select(F.posexplode(ring).alias("k", "p")).select(F.lit(0).alias("block"), "k", F.concat_ws("   ", "p.x", "p.y").alias("line"))
    path = new_folder(spark, "zone")
    text.write_lines(points, path)
    return text.read_zone(spark, path).select(F.posexplode("ring").alias("seq", "p")).select("seq", micro("p.x").alias("x"), micro("p.y").alias("y"))


@query("SELECT s_suppkey AS id, (s_suppkey % 2)::INT AS flag, s_name || ' of ' || s_nationkey AS label FROM supplier")
def flags_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the switches of user polygons as lines of number, flag and label."""
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.lit(0).alias("block"), F.col("s_suppkey").alias("k"), F.concat_ws(" ", "s_suppkey", F.col("s_suppkey") % 2, "s_name", F.lit("of"), "s_nationkey").alias("line"))
    path = new_folder(spark, "flags")
    text.write_lines(rows, path)
    return text.read_flags(spark, path)


@query(with_("size") + "SELECT 25::BIGINT AS nx, n // 4 AS ny, 0.25::DOUBLE AS dx, 0.25::DOUBLE AS dy, 0.0938::DOUBLE AS lon0, 0.0938::DOUBLE AS lat0 FROM size")
def meta_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = text.metadata("RECT", 25, fx.rows(spark, sf_dir) // 4, 0.09375, 0.09375, 0.25, 0.25, "regional")
    return spark.createDataFrame([text.parse_metadata(written)], "nx long, ny long, dx double, dy double, lon0 double, lat0 double")


@query(with_("bathy") + "SELECT ilon, ilat, (sign(z) * floor(abs(z) * 0.125 + 0.5))::BIGINT AS v FROM bathy WHERE ilon < 99")
def export_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 and K6: scaled to whole numbers, without the last column."""
    return fx.bathy(spark, sf_dir).where("ilon < 99").select("ilon", "ilat", text.scaled(F.col("z") * 0.125, 1).alias("v"))


@query(with_("bathy", extra="r AS (SELECT unnest([{'name': 'lon', 'v': lon::FLOAT::DOUBLE}, {'name': 'lat', 'v': lat::FLOAT::DOUBLE}, {'name': 'z', 'v': z::FLOAT::DOUBLE}]) AS x FROM bathy)") + "SELECT x.name AS name, min(x.v) AS low, max(x.v) AS high FROM r GROUP BY x.name")
def export_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.ranges(fx.bathy(spark, sf_dir), ["lon", "lat", "z"])


_BLOCKED = "blocked AS (SELECT k, j, depth AS z, mask, mask * 0.5 AS sx, mask * 0.25 AS sy FROM cellavg JOIN mask USING (k, j) WHERE (k + j) % 5 > 0)"


@query(with_("mask", extra=_BLOCKED) + "SELECT (j - 1)::INT AS ilon, (k - 1)::INT AS ilat, (0.09375 + 0.25::DOUBLE * (j - 1))::FLOAT::DOUBLE AS lon, (0.09375 + 0.25::DOUBLE * (k - 1))::FLOAT::DOUBLE AS lat, v.name, v.z::FLOAT::DOUBLE AS z FROM grid LEFT JOIN blocked USING (k, j), LATERAL (SELECT unnest(['z', 'mask', 'sx', 'sy']) AS name, unnest([blocked.z, blocked.mask, sx, sy]) AS z) v")
def netcdf_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: depth, mask and obstruction as one NetCDF file, each variable read back; cells that the grid has not are empty."""
    ny = fx.rows(spark, sf_dir) // 4
    depth = _average(spark, sf_dir).where("(k + j) % 5 > 0").select("k", "j", F.col("depth").alias("z"))
    grid = depth.withColumn("mask", F.when(F.col("z") == DRY, 0).otherwise(1)).withColumns({"sx": F.col("mask") * 0.5, "sy": F.col("mask") * 0.25})
    path = new_folder(spark, "grid") + ".nc"
    netcdf.write_netcdf(materialise(grid, "grid"), [0.09375 + 0.25 * j for j in range(25)], [0.09375 + 0.25 * k for k in range(ny)], path, 25, ny, -1e30)
    each = [netcdf.read_netcdf(spark, path, ("lon", "lat", name), slab=4096).withColumn("name", F.lit(name)) for name in ("z", "mask", "sx", "sy")]
    return reduce(DataFrame.unionByName, each)


@query(with_("bathy") + "SELECT ilon, ilat, z::DOUBLE AS z FROM bathy WHERE ilon BETWEEN 12 AND 69 AND ilat BETWEEN 0 AND 16 AND ilat <= 17")
def netcdf_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same window as bathy_window, of a NetCDF file, of which only its slabs are read."""
    n = fx.rows(spark, sf_dir)
    raster = fx.bathy(spark, sf_dir).select((F.col("ilat") + 1).alias("k"), (F.col("ilon") + 1).alias("j"), "z")
    path = new_folder(spark, "base") + ".nc"
    netcdf.write_netcdf(raster, [i * fx.STEP for i in range(100)], [i * fx.STEP for i in range(n)], path, 100, n)
    return netcdf.read_window(spark, path, (1.25, 3.8, 0.2, 0.5), (0.25, 0.25)).select("ilon", "ilat", "z")


@query(with_("poly") + "SELECT poly_id, level FROM poly WHERE x + r >= 1 AND x - r <= 2 AND y + r >= 0.25 AND y - r <= 0.5")
def shoreline_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The polygons of the nearest resolution whose boxes touch a box."""
    path = new_folder(spark, "shoreline")
    rasters.write_shoreline(fx.polygons(spark, sf_dir), "high", path, rows=200)
    return rasters.read_shoreline(spark, path, "inter", (1.0, 2.0, 0.25, 0.5), nearest=True).select("poly_id", "level")


# ---- whole pipelines ----

_LARGEST = "final AS (SELECT m.k, m.j, (CASE WHEN body_id IN (SELECT body_id FROM body GROUP BY body_id ORDER BY count(*) DESC, body_id LIMIT 1) THEN 1 ELSE 0 END)::INT AS mask FROM clean2 m LEFT JOIN body b ON b.k = m.k AND b.j = m.j)"


_SEA = [_SAMPLES, _clean_sql("sea", "clean", "isles"), _clean_sql("clean", "clean2", "reefs"), _bodies_sql("clean2", 25), _LARGEST, _extents_sql("final", "shoal")]


@query(
    with_("sea", "shoal", "reefs", extra=", ".join([*_SEA, _merge_sql("x"), _merge_sql("y"), _value_sql("x", "final", 1, 1), _value_sql("y", "final", 1, 1)]), recursive=True)
    + f"SELECT f.k, f.j, {m('depth', 'depth')}, f.mask, {m('x.v', 'sx')}, {m('y.v', 'sy')} FROM final f JOIN seaavg c ON c.k = f.k AND c.j = f.j JOIN valx x ON x.k = f.k AND x.j = f.j JOIN valy y ON y.k = f.k AND y.j = f.j"
)
def pipeline_regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth, mask and obstruction of a regional grid: average, clean twice, largest body, obstruction by its islands."""
    cells = _cells(spark, sf_dir)
    shores = fx.isles(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "poly_id")
    shores = materialise(shores, "shores")
    depth = materialise(bathymetry.cell_average(fx.bathy(spark, sf_dir), cells, 0.0, 0.5, DRY, TILE), "depth")
    mask = masks.initial_mask(depth, DRY).select("k", "j", "mask")
    mask = materialise(masks.clean_mask(cells, mask, polygons.of_level(shores), 0.3, 0.25, TILE), "mask")
    reefs = polygons.enabled(fx.reefs(spark, sf_dir), fx.flags(spark, sf_dir)).select("poly_id", "ring")
    mask = materialise(masks.clean_mask(cells, mask, reefs, 0.3, 0.25, TILE), "mask")
    mask = materialise(masks.keep_bodies(masks.water_bodies(mask, 25, fx.rows(spark, sf_dir) // 4), -1), "mask")
    blocked = obstruction.sub_grid(shores, cells, mask, TILE, 1, 1)
    return depth.join(mask, ["k", "j"]).join(blocked, ["k", "j"]).select("k", "j", micro("depth").alias("depth"), "mask", micro("sx").alias("sx"), micro("sy").alias("sy"))


@query(
    with_("bathy", "size", extra=f"{_ROUND}, a AS (SELECT k, j, (CASE WHEN count(z) FILTER (z <= 0) > 0.6 * count(z) THEN 1 ELSE 0 END)::INT AS mask FROM g LEFT JOIN w ON w.lon BETWEEN g.lon - 7.2 AND g.lon + 7.2 AND w.lat BETWEEN g.lat - 0.125 AND g.lat + 0.125 GROUP BY k, j), {_bodies_sql('a', 25, True)}", recursive=True)
    + "SELECT a.k, a.j, a.mask, coalesce(body_id, -1)::INT AS body_id FROM a LEFT JOIN body b ON b.k = a.k AND b.j = a.j WHERE a.j < 25"
)
def pipeline_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mask and water bodies of a grid around the globe, without its last column."""
    base = fx.bathy(spark, sf_dir).withColumn("lon", F.col("ilon") * 3.6)
    ny = fx.rows(spark, sf_dir) // 4
    cells = grids.cells(grids.rectilinear(spark, 1.8, 14.4, 25, 0.09375, 0.25, ny))
    depth = bathymetry.cell_average(base, cells, 0.0, 0.6, DRY, 16.0, wrap=True)
    mask = materialise(masks.initial_mask(depth, DRY).select("k", "j", "mask"), "mask")
    return mask.join(masks.water_bodies(mask, 25, ny, wrap=True), ["k", "j"]).where("j < 25")


@query(with_("mask", extra=f"{_NESTED}, {_ZONE2}, {_boundary_sql('zone2', 'bound2')}, {_support_sql('bound2', 'nest2')}") + _OVER.format("nest", "nest2"))
def pipeline_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two zones of a nested grid, each with its boundary and its parents, laid over each other."""
    n = fx.rows(spark, sf_dir)
    second = nesting.boundary(_rectangle(spark, sf_dir), 25, n // 4)
    second = nesting.parent_support(second, _parent(spark, sf_dir), 0.25, 0.25, 0.5, 0.5, 12, n // 8)
    return nesting.overlay(_supported(spark, sf_dir), second).select("k", "j", "mask")
