"""Small cases worked out by hand."""

from __future__ import annotations

import math
import random

import plain_rings
import pytest
from pyspark.sql import functions as F

from tidegrid.functions.geometry import inside, interval_union, point, total_length
from tidegrid.operators import bathymetry, grids, masks, nesting, obstruction, polygons
from tidegrid.operators.components import connected_components
from tidegrid.sources import rasters, text

BOX = (0.0, 10.0, 0.0, 10.0)


def _area(ring):
    return sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(ring, ring[1:])) / 2


def test_inside_is_closed_on_a_concave_ring(spark):
    ring = F.array(*[point(x, y) for x, y in [(0, 0), (4, 0), (4, 4), (2, 2), (0, 4), (0, 0)]])
    rows = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (2.0, 3.0), (4.0, 2.0), (3.0, 3.5), (5.0, 1.0)], "x double, y double")
    found = [r[0] for r in rows.select(inside(ring, F.col("x"), F.col("y"))).collect()]
    assert found == [True, True, False, True, False, False]


@pytest.mark.parametrize("segs,union,total", [([(0, 1), (1, 2)], 1, 2), ([(0, 0.2), (0.5, 1)], 2, 0.7), ([(0, 1), (0.2, 0.3)], 1, 1), ([], 0, 0)])
def test_interval_union(spark, segs, union, total):
    row = spark.createDataFrame([([{"lo": float(a), "hi": float(b)} for a, b in segs],)], "s array<struct<lo:double,hi:double>>")
    got = row.select(F.size(interval_union(F.col("s"))), total_length(F.col("s"))).first()
    assert got[0] == union and math.isclose(got[1], total, abs_tol=1e-12)


def test_corner_cells_mirror_or_turn(spark):
    grid = grids.rectilinear(spark, 0.0, 2.0, 3, 0.0, 1.0, 3)
    lone = {c: grids.cells(grid, compat=c).where("k = 1 and j = 1").first() for c in (False, True)}
    assert lone[False]["c1"].asDict() == {"x": 1.0, "y": -0.5} and lone[False]["c3"].asDict() == {"x": -1.0, "y": 0.5}
    assert lone[True]["c3"].asDict() == {"x": -0.5, "y": 1.0} and lone[True]["c1"].asDict() == {"x": 0.5, "y": -1.0}


@pytest.mark.parametrize("ring,area,rings,older", [
    ([(2, 2), (8, 2), (8, 8), (2, 8), (2, 2)], 36, 1, (36, 1)),
    ([(-5, -5), (20, -5), (20, 20), (-5, 20), (-5, -5)], 100, 1, (100, 1)),
    ([(5, 5), (15, 5), (15, 15), (5, 15), (5, 5)], 25, 1, (25, 1)),
    ([(20, 20), (30, 20), (30, 30), (20, 20)], 0, 0, (0, 0)),
    ([(-5, 2), (2, 2), (2, 3), (-4, 3), (-4, 6), (2, 6), (2, 7), (-5, 7), (-5, 2)], 4, 2, (4, 2)),
    ([(-5, 4), (15, 4), (15, 6), (-5, 6), (-5, 4)], 20, 1, (0, 0)),  # crosses without a vertex inside
    ([(10, 2), (14, 2), (14, 8), (10, 8), (10, 2)], 0, 0, (0, 1)),  # touches a side from outside
    ([(0, 2), (4, 2), (4, 8), (0, 8), (0, 2)], 24, 1, (24, 1)),  # lies on a side from inside
    ([(-3, 5), (5, -3), (13, 5), (5, 13), (-3, 5)], 92, 1, (0, 0)),  # cuts all four corners
])
def test_clip(ring, area, rings, older):
    points = [(float(x), float(y)) for x, y in ring]
    for clipped, wanted in ((plain_rings.clipped_rings, (area, rings)), (polygons.vertex_clipped_rings, older)):
        found = clipped(points, BOX)
        assert len(found) == wanted[1] and math.isclose(sum(map(_area, found)), wanted[0], abs_tol=1e-9)
        assert all(0 <= x <= 10 and 0 <= y <= 10 for r in found for x, y in r)


def _half_planes(ring):
    """Area within BOX by cutting along one side after the other."""
    points = ring[:-1]
    for axis, bound, sign in ((0, 0.0, 1), (0, 10.0, -1), (1, 0.0, 1), (1, 10.0, -1)):
        out = []
        for a, b in zip(points, points[1:] + points[:1]):
            da, db = sign * (a[axis] - bound), sign * (b[axis] - bound)
            if da >= 0:
                out.append(a)
            if (da >= 0) != (db >= 0):
                t = da / (da - db)
                out.append((a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))
        points = out
    return _area([*points, *points[:1]])


def test_concave_clips_have_the_area_of_half_plane_cuts():
    for seed in range(1500):
        draw = random.Random(seed)
        n, x, y, r = draw.choice([3, 5, 8, 24]), draw.uniform(-3, 13), draw.uniform(-3, 13), draw.uniform(1, 15)
        reach = [r * draw.uniform(0.2, 1) for _ in range(n)]
        ring = [(x + d * math.cos(2 * math.pi * i / n), y + d * math.sin(2 * math.pi * i / n)) for i, d in enumerate(reach)]
        ring.append(ring[0])
        found = plain_rings.clipped_rings(ring, BOX)
        assert math.isclose(sum(map(_area, found)), _half_planes(ring), abs_tol=1e-7), seed
        assert all(0 <= px <= 10 and 0 <= py <= 10 for piece in found for px, py in piece)


def test_pieces_of_a_long_edge_lie_on_both_sides_of_the_meridian():
    ring = [(350.0, 2.0), (10.0, 2.0), (10.0, 4.0), (350.0, 4.0), (350.0, 2.0)]
    areas = [sum(map(_area, plain_rings.clipped_rings(ring, (west, west + 20, 0.0, 10.0)))) for west in (345.0, -5.0)]
    assert areas == [pytest.approx(30), pytest.approx(30)]


@pytest.mark.parametrize("length,points", [(0.49, 2), (0.5, 2), (0.51, 3), (0.75, 4), (1.0, 5)])
def test_densify(spark, length, points):
    row = spark.createDataFrame([([{"x": 0.0, "y": 0.0}, {"x": length, "y": 0.0}],)], "ring array<struct<x:double,y:double>>")
    assert polygons.densify(row).select(F.size("ring")).first()[0] == points


def test_bodies_touch_by_sides_and_wrap(spark):
    rows = ["11001", "00000", "00110", "00001", "10000"]
    mask = spark.createDataFrame([(k, j, int(v)) for k, line in enumerate(rows, 1) for j, v in enumerate(line, 1)], "k int, j int, mask int")
    apart = masks.water_bodies(mask, 5, 5)
    assert masks.body_sizes(apart).count() == 5
    assert masks.body_sizes(masks.water_bodies(mask, 5, 5, wrap=True)).agg(F.max("cells")).first()[0] == 3
    assert {(r.k, r.j) for r in masks.keep_bodies(apart, -1).where("mask = 1").collect()} == {(1, 1), (1, 2)}
    dry = mask.withColumn("mask", F.lit(0))
    assert masks.keep_bodies(masks.water_bodies(dry, 5, 5), -1).where("mask = 1").count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_neighbour_fold_prefers_the_longer(spark):
    rows = [(1, 1, 7, 0.1, 0.5), (1, 2, 7, 0.2, 0.6), (1, 3, 7, 0.0, 0.9), (1, 5, 7, 0.3, 0.4)]
    found = spark.createDataFrame(rows, "k int, j int, poly_id long, x_lo double, x_hi double")
    got = sorted((r.j, r.lo, r.hi) for r in obstruction.merge_neighbours(found, "x").collect())
    assert got == [(1, 0.1, 0.6), (3, 0.0, 0.9), (5, 0.3, 0.4)]


def test_equal_neighbours_shadow_each_other(spark):
    cells = spark.createDataFrame([(1, j, 1) for j in range(1, 4)], "k int, j int, mask int")
    segs = spark.createDataFrame([(1, 1, [{"lo": 0.2, "hi": 0.4}]), (1, 2, [{"lo": 0.2, "hi": 0.4}])], "k int, j int, segs array<struct<lo:double,hi:double>>")
    got = {r.j: r.value for r in obstruction.obstruction(cells, cells, segs, "x", 1, 1).collect()}
    assert got == {1: 0.0, 2: 0.0, 3: 0.0}


@pytest.mark.parametrize("ry,lost", [(0.04, False), (0.06, True)])
def test_parent_of_little_weight_may_be_dry(spark, ry, lost):
    parent = spark.createDataFrame([(1, 1, 1), (1, 2, 1), (2, 1, 0), (2, 2, 1)], "k int, j int, mask int")
    mask = spark.createDataFrame([(1, 1, 0.0, ry, 2)], "k int, j int, lon double, lat double, mask int")
    got = nesting.parent_support(mask, parent, 0.0, 0.0, 1.0, 1.0, 2, 2).first()["mask"]
    assert got == (3 if lost else 2)


def test_averaging_needs_more_than_the_limit(spark):
    base = spark.createDataFrame([(x / 4, y / 4, -8 if 4 * x + y < 8 else 5) for x in range(4) for y in range(4)], "lon double, lat double, z int")
    ring = [{"x": float(x), "y": float(y)} for x, y in [(-0.1, -0.1), (0.9, -0.1), (0.9, 0.9), (-0.1, 0.9), (-0.1, -0.1)]]
    cells = spark.createDataFrame([(1, 1, ring)], "k int, j int, ring array<struct<x:double,y:double>>")
    for limit, depth in ((0.5, 99.0), (0.49, -8.0)):
        assert bathymetry.cell_average(base, cells, 0.0, limit, 99.0, 1.0).first()["depth"] == depth


def test_target_beyond_the_raster_is_an_error(spark):
    base = spark.createDataFrame([(0, 0, 0.0, 0.0, 1)], "ilon int, ilat int, lon double, lat double, z int")
    with pytest.raises(ValueError):
        bathymetry.window(base, 0.0, 0.0, 1.0, 1.0, 10, 10, (2.0, 9.5, 0.0, 5.0), (1.0, 1.0))


def test_nodes_too_far_apart_do_not_reconcile(spark):
    grid = lambda at: spark.createDataFrame([(k, j, at + 3.0 * (j - 1), 3.0 * (k - 1), 1) for k in (1, 2) for j in (1, 2)], "k int, j int, lon double, lat double, mask int")
    with pytest.raises(ValueError):
        nesting.reconcile(grid(1.5), grid(0.0), (1.0, 1.0))


def test_south_pole_mirrors_the_north(spark):
    north, south = (grids.polar(spark, 85.0, 100.0, north=n).agg(F.min("lat"), F.max("lat"), F.count("*")).first() for n in (True, False))
    assert north[0] == pytest.approx(-south[1]) and north[1] == pytest.approx(-south[0]) and north[2] == south[2]


def test_curvilinear_metadata():
    shown = text.metadata("CURV", 5, 7, 0, 0, 0, 0, "polar", (0.001, 0.01), 0.5, (".dep", ".obs", ".msk")).split("\n")
    at = [line for line in shown if "NAME" in line]
    assert [line.split()[1] for line in at[:2]] == ["0.5", "0.5"] and [line.split("'")[-2] for line in at] == ["polar.lon", "polar.lat", "polar.dep", "polar.obs", "polar.msk"]
    assert at[2].split()[3] == "0.001" and at[3].split()[1] == "0.01"


def test_shadow_reaches_as_far_as_asked(spark):
    cells = spark.createDataFrame([(1, j, 1) for j in range(1, 5)], "k int, j int, mask int")
    segs = spark.createDataFrame([(1, 2, [{"lo": 0.1, "hi": 0.9}]), (1, 4, [{"lo": 0.2, "hi": 0.4}])], "k int, j int, segs array<struct<lo:double,hi:double>>")
    at = lambda before: {r.j: r.value for r in obstruction.obstruction(cells, cells, segs, "x", before, 0).collect()}[4]
    assert at(1) == pytest.approx(0.2) and at(2) == 0.0


def test_resolutions_and_rasters_are_named(spark, tmp_path):
    with pytest.raises(ValueError):
        rasters.read_shoreline(spark, str(tmp_path), "finest")
    with pytest.raises(ValueError):
        rasters.read_raster(spark, str(tmp_path), "own")


def test_metadata_round_trip():
    assert text.parse_metadata(text.metadata("RECT", 5, 7, -3.5, 44.0, 0.25, 0.5, "g")) == {"nx": 5, "ny": 7, "dx": 0.25, "dy": 0.5, "lon0": -3.5, "lat0": 44.0}
    with pytest.raises(ValueError):
        text.metadata("TRI", 5, 7, 0, 0, 1, 1, "g")


@pytest.mark.parametrize("tile", [64, 5, 1])
@pytest.mark.parametrize("wrap", [False, True])
def test_bodies_equal_a_flood_fill(spark, tile, wrap):
    nx, ny, draw = 23, 17, random.Random(tile)
    wet = {(k, j) for k in range(1, ny + 1) for j in range(1, nx + 1) if draw.random() < 0.6}
    bodies, left = {}, sorted(wet, key=lambda c: (c[1], c[0]))
    for cell in left:
        if cell in bodies:
            continue
        number, todo = max(bodies.values(), default=0) + 1, [cell]
        while todo:
            k, j = todo.pop()
            if (k, j) in wet and (k, j) not in bodies:
                bodies[k, j] = number
                todo += [(k + 1, j), (k - 1, j), *(((k, (j + d - 1) % nx + 1) if wrap else (k, j + d)) for d in (1, -1))]
    mask = spark.createDataFrame([(k, j, int((k, j) in wet)) for k in range(1, ny + 1) for j in range(1, nx + 1)], "k int, j int, mask int")
    found = {(r.k, r.j): r.body_id for r in masks.water_bodies(mask, nx, ny, wrap, tile).collect()}
    assert found == {(k, j): bodies.get((k, j), -1) for k in range(1, ny + 1) for j in range(1, nx + 1)}
    assert masks.water_bodies(mask.limit(0), nx, ny, wrap, tile).count() == 0
