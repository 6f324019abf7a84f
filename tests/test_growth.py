"""Plans whose size, and with it their cost a row, once grew with every edge that was looked at."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegrid.functions.geometry import held_points, inside
from tidegrid.operators import bathymetry, grids, masks, obstruction, polygons, rings
from tidegrid.plans import fixtures as fx


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_points_in_batches_equal_the_expression(spark):
    rings = [[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)], [(x, y) for x, y in fx.STAR], [], [(0, 0), (1, 0), (0, 1), (0, 0)], [(1, 1)]]
    points = [(x / 4, y / 4) for x in range(-4, 9) for y in range(-4, 9)]
    kind = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
    ringed = pa.array([[{"x": float(x), "y": float(y)} for x, y in r] for r in rings], kind)
    for sliced in (ringed, ringed.slice(1)):
        x, y = (np.repeat([[p[v] for p in points]], len(sliced), axis=0) for v in (0, 1))
        found = held_points(sliced, x, y)
        rows = [(i, j, r, *points[j]) for i, r in enumerate(sliced.to_pylist()) for j in range(len(points))]
        df = spark.createDataFrame(rows, "i int, j int, ring array<struct<x:double,y:double>>, px double, py double")
        expected = {(r.i, r.j) for r in df.where(inside(F.col("ring"), F.col("px"), F.col("py"))).collect()}
        assert {(int(i), int(j)) for i, j in np.argwhere(found)} == expected
        assert expected


@pytest.mark.parametrize("n", [2, 6])
def test_samples_of_rings_of_any_size(spark, n):
    rings = [fx.STAR, [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)], []]
    cells = spark.createDataFrame([(k, 1, [{"x": float(x), "y": float(y)} for x, y in r]) for k, r in enumerate(rings)], "k int, j int, ring array<struct<x:double,y:double>>")
    found = masks.samples(cells, n).collect()
    assert sorted(r.pt for r in found if r.k == 1) == list(range(n * n))
    assert all(r.x == 2.0 * (r.pt % n) / (n - 1) and r.y == 2.0 * (r.pt // n) / (n - 1) for r in found if r.k == 1)
    grid = [(pt, -1 + 2.0 * (pt % n) / (n - 1), -1 + 2.0 * (pt // n) / (n - 1)) for pt in range(n * n)]
    star = F.array(*[fx.point(float(x), float(y)) for x, y in fx.STAR])
    expected = spark.createDataFrame(grid, "pt int, x double, y double").where(inside(star, F.col("x"), F.col("y"))).collect()
    assert sorted(r.pt for r in found if r.k == 0) == sorted(r.pt for r in expected) and not any(r.k == 2 for r in found)


def test_a_ring_is_not_computed_again_for_every_edge(spark):
    """one point in an octagon that is an expression took a plan of a quarter of a million characters."""
    key = spark.range(3).select("id", fx.octagon(F.col("id") * 1.0, F.col("id") * 2.0, F.lit(1.0)).alias("ring"))
    assert len(_plan(polygons.covers_box(key, (0.0, 0.1, 0.0, 0.1)))) < 40_000
    assert len(_plan(masks.samples(key.select(F.col("id").alias("k"), F.col("id").alias("j"), "ring")))) < 5_000


def test_rings_that_are_expressions_are_not_computed_to_drop_empty_ones(spark):
    """A filter before the explode held the whole ring, in code too large to be compiled."""
    key = spark.range(3).select(F.col("id").alias("poly_id"), F.lit(1).alias("level"), fx.octagon(F.col("id") * 1.0, F.col("id") * 1.0, F.lit(0.5)).alias("ring"))
    cells = grids.cells(grids.rectilinear(spark, 0.0, 1.0, 3, 0.0, 1.0, 3))
    mask = cells.select("k", "j", F.lit(1).alias("mask"))
    found = obstruction.extents(key, cells, mask, 1.0)
    edges = rings.edges_of(key)
    for df in (found, edges):
        assert "Filter (size(array(" not in _plan(df) and "Filter ((size(array(" not in _plan(df)
    assert edges.count() == 24 and {(r.k, r.j) for r in found.collect()} >= {(1, 1), (2, 2), (3, 3)}
    odd = spark.createDataFrame([(1, 1, []), (2, 1, None), (3, 1, [{"x": 1.0, "y": 1.0}])], "poly_id long, level int, ring array<struct<x:double,y:double>>")
    assert rings.edges_of(odd).count() == 0
    assert [(r.k, r.j, r.poly_id) for r in obstruction.extents(odd, cells, mask, 1.0).collect()] == [(2, 2, 3)]


def test_cells_along_the_axes_need_no_test_but_their_box(spark):
    """The ring of every cell went to Python with each of its points."""
    rings_ = [
        [(0, 0), (2, 0), (2, 1), (0, 1), (0, 0)], [(1, 1), (1, 2), (3, 2), (3, 1), (1, 1)], [(2, 2), (2, 0), (0, 0), (0, 2), (2, 2)],
        [(1, 0), (2, 1), (1, 2), (0, 1), (1, 0)], [(0, 0), (2, 0), (2, 2), (0, 0)], [(0, 0), (2, 0), (0, 2), (2, 2), (0, 0)], [(1, 1), (1, 1), (1, 1), (1, 1), (1, 1)], [(0, 1), (2, 1), (2, 1), (0, 1), (0, 1)],
    ]
    kind = "k int, j int, ring array<struct<x:double,y:double>>"
    cells = spark.createDataFrame([(k, 1, [{"x": float(x), "y": float(y)} for x, y in r]) for k, r in enumerate(rings_)], kind)
    points = spark.createDataFrame([(x / 4, y / 4) for x in range(-1, 14) for y in range(-1, 10)], "lon double, lat double")
    straight = cells.where("k < 3 or k > 5")
    for some in (cells, straight, cells.where("k between 3 and 5"), straight.union(spark.createDataFrame([(9, 1, None), (10, 1, [])], kind))):
        found = sorted((r.k, r.lon, r.lat) for r in bathymetry.points_in_cells(points, some, 1.0).collect())
        expected = sorted((r.k, r.lon, r.lat) for r in points.join(some).where(inside(F.col("ring"), F.col("lon"), F.col("lat"))).collect())
        assert found == expected and found
    assert "MapInArrow" not in _plan(bathymetry.points_in_cells(points, straight, 1.0))


def test_polygons_of_one_partition_are_dealt_out_before_masks_are_cleaned(spark, monkeypatch):
    """one task made the edges of all polygons."""
    parts, stored = {}, masks.materialise

    def counted(df, name="step"):
        parts[name] = df.rdd.getNumPartitions()
        return stored(df, name)

    monkeypatch.setattr(masks, "materialise", counted)
    land = spark.range(40, numPartitions=1).select(F.col("id").alias("poly_id"), fx.octagon(F.col("id") % 3 * 1.0, F.col("id") % 2 * 1.0, F.lit(0.75)).alias("ring"))
    cells = grids.cells(grids.rectilinear(spark, 0.0, 1.0, 3, 0.0, 1.0, 3))
    found = masks.clean_mask(cells, cells.select("k", "j", F.lit(1).alias("mask")), land, 0.3, 0.25, 1.0)
    assert sorted((r.k, r.j) for r in found.where("mask = 0").collect()) == [(k, j) for k in (1, 2, 3) for j in (1, 2, 3)]
    assert parts["rings"] == 4


def test_polygons_of_one_partition_are_dealt_out_before_they_are_held_against_a_box(spark):
    """one task looked at all polygons of a small file, as a filter goes before any dealing out."""
    land = spark.range(40, numPartitions=1).select(F.col("id").alias("poly_id"), fx.octagon(F.col("id") % 3 * 1.0, F.lit(0.0), F.lit(0.75)).alias("ring"))
    found = polygons.covers_box(land, (0.9, 1.1, -0.1, 0.1))
    assert sorted(r.poly_id for r in found.collect()) == list(range(1, 40, 3))
    assert "Range" not in _plan(found) and len(found.inputFiles()) > 1
