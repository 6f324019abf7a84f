"""Uneven input: many points in one tile or place, one polygon over a whole row."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from tidegrid.functions.geometry import ring_box
from tidegrid.operators import bathymetry, grids, obstruction


def _points(spark, n, place):
    """Nine of ten points in one tile, or in one place of it."""
    near = F.rand(1) < 0.9
    at = lambda seed, here: F.when(near, 3 + here).otherwise(F.rand(seed) * 8)
    here = (F.lit(0.3), F.lit(0.7)) if place else (F.rand(4) ** 2, F.rand(5))
    return spark.range(n).select(F.col("id"), at(2, here[0]).alias("lon"), at(3, here[1]).alias("lat"))


@pytest.mark.parametrize("place", [False, True])
def test_largest_task_has_less_than_twice_the_mean(spark, place):
    points = _points(spark, 200_000, place).cache()
    cells = grids.cells(grids.rectilinear(spark, 0.1, 0.2, 40, 0.1, 0.2, 40)).select("k", "j", "ring", *ring_box(F.col("ring")))
    placed, held = bathymetry.dealt_tiles(points, cells, 1.0, 200_000 // (8 * 16))
    assert placed.count() == 200_000
    tasks = placed.repartition(16, "key").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in tasks) < 2 * 200_000 / 16
    assert held.groupBy("k", "j", "key").count().where("count > 1").isEmpty()
    points.unpersist()


@pytest.mark.parametrize("most", [None, 50, 1])
def test_pairs_do_not_depend_on_how_tiles_are_dealt(spark, most):
    points = spark.createDataFrame([(i, (x := random.Random(i)).choice([0.3, x.random() * 3 - 1, 1.0]), x.choice([0.2, x.random() * 3 - 1])) for i in range(800)], "id int, lon double, lat double")
    cells = grids.cells(grids.rectilinear(spark, -0.95, 0.15, 20, -0.95, 0.15, 20))
    found = sorted((r.id, r.k, r.j) for r in bathymetry.points_in_cells(points, cells, 1.0, most).collect())
    boxes = [(r.k, r.j, r.west, r.east, r.south, r.north) for r in cells.select("k", "j", *ring_box(F.col("ring"))).collect()]
    assert found == sorted((p.id, k, j) for p in points.collect() for k, j, w, e, s, n in boxes if w <= p.lon <= e and s <= p.lat <= n)
    assert bathymetry.points_in_cells(points.limit(0), cells, 1.0, most).count() == 0


def _folded(cells):
    """Left to right, one span after the other."""
    done = []
    for at, lo, hi in cells:
        if done and at == done[-1][0] + 1:
            last = done.pop()
            done.append((last[0] if last[2] - last[1] >= hi - lo else at, min(lo, last[1]), max(hi, last[2])))
        else:
            done.append((at, lo, hi))
    return done


@pytest.mark.parametrize("axis", ["x", "y"])
def test_merged_neighbours_equal_a_walk(spark, axis):
    draw, rows, wanted = random.Random(2), [], []
    for line in range(6):
        for poly in range(5):
            cells = [(at, lo := draw.choice([0.0, 0.25, draw.random()]), max(lo, draw.choice([1.0, 0.5, draw.random()]))) for at in range(1, 60) if draw.random() < 0.8]
            wanted += [(line, poly, *c) for c in _folded(cells)]
            rows += [((line, at) if axis == "x" else (at, line)) + (poly, lo, hi) for at, lo, hi in cells]
    found = spark.createDataFrame(rows, f"k int, j int, poly_id long, {axis}_lo double, {axis}_hi double").repartition(5)
    merged = obstruction.merge_neighbours(found, axis).collect()
    assert sorted(wanted) == sorted(((r.k, r.poly_id, r.j) if axis == "x" else (r.j, r.poly_id, r.k)) + (r.lo, r.hi) for r in merged)
    assert obstruction.merge_neighbours(found.limit(0), axis).count() == 0


def test_one_polygon_in_a_row_of_many_cells_is_linear(spark):
    n, took = 100_000, []
    for cells in (n, 3 * n):
        found = spark.range(cells).select(F.lit(1).alias("k"), F.col("id").cast("int").alias("j"), F.lit(7).cast("long").alias("poly_id"), F.lit(0.25).alias("x_lo"), (0.25 + F.rand(1) / 2).alias("x_hi"))
        began = time.time()
        kept = obstruction.merge_neighbours(found, "x").count()
        took.append(time.time() - began)
        assert cells / 3 < kept < 2 * cells / 3
    assert took[1] < 20
