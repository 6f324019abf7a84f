"""Rings as rows of edges against a plain walk along each ring."""

from __future__ import annotations

import math
import random

import pytest
from plain_rings import clipped_rings
from pyspark.sql import functions as F

from tidegrid.operators import polygons, rings
from tidegrid.operators.rings import BOX, areas, clip_edges, cycle_ranks, edges_of, rings_of, split_edges
from tidegrid.plans.shared import materialise

BOUNDS = (1.0, 5.0, 0.2, 4.0)


def _star(draw, x, y, n, r):
    reach = [r * draw.uniform(0.2, 1) for _ in range(n)]
    ring = [(x + d * math.cos(2 * math.pi * i / n), y + d * math.sin(2 * math.pi * i / n)) for i, d in enumerate(reach)]
    return [*ring, ring[0]]


def _shapes():
    draw = random.Random(4)
    shapes = [_star(draw, draw.uniform(0, 6), draw.uniform(0, 5), draw.choice([4, 9, 30, 200]), draw.uniform(0.3, 4)) for _ in range(60)]
    shapes.append([(1.0, 0.5), (3.0, 0.5), (3.0, 3.0), (1.0, 3.0), (1.0, 0.5)])  # lies on a side
    shapes.append([(-9.0, -9.0), (19.0, -9.0), (19.0, 19.0), (-9.0, 19.0), (-9.0, -9.0)])  # covers the box
    shapes.append([(2.0, 2.0), (2.5, 2.0), (2.5, 2.5), (2.0, 2.0)])  # inside
    shapes.append([(0.0, 0.0), (1.0, 2.0), (0.0, 4.0), (-1.0, 2.0), (0.0, 0.0)])  # touches with a vertex
    shapes.append([(6.0, 1.0), (1.0, 2.0), (6.0, 3.0), (6.0, 4.5), (0.5, 4.5), (0.5, 0.5), (6.0, 0.5), (6.0, 1.0)])  # two parts, one vertex on a side
    comb = [(0.5, 0.0), *[(0.5 + 0.05 * i, 4.5 if i % 2 else 1.0) for i in range(1, 90)], (5.5, 0.0), (0.5, 0.0)]
    shapes.append(comb[::-1])  # many parts
    return shapes


def _table(spark, shapes):
    return spark.createDataFrame([(i, 1, [{"x": x, "y": y} for x, y in ring]) for i, ring in enumerate(shapes)], "poly_id long, level int, ring array<struct<x:double,y:double>>")


def _turned(ring):
    points = [(round(x, 9), round(y, 9)) for x, y in ring]
    assert points[0] == points[-1]
    points = [p for p, q in zip(points, [points[-2], *points[:-2]]) if p != q]
    k = points.index(min(points)) if points else 0
    return tuple(points[k:] + points[:k])


@pytest.mark.parametrize("block", [4096, 7])
def test_clipped_rows_are_the_rings_of_a_walk_in_order(spark, block):
    shapes = _shapes()
    edges = edges_of(_table(spark, shapes)).withColumns({"tile": F.lit(0), **{n: F.lit(v) for n, v in zip(BOX, BOUNDS)}})
    found = materialise(clip_edges(edges, block))
    numbered = found.groupBy("poly_id", "part").agg(F.count("*").alias("c"), F.max("n").alias("n"), F.countDistinct("i").alias("d"), F.max("i").alias("m"))
    assert numbered.where("c <> n or d <> n or m <> n - 1").isEmpty()
    ours = {(r.poly_id, r.part): _turned([(p.x, p.y) for p in r.ring]) for r in rings_of(found, "poly_id", "part").collect()}
    theirs = {(i, part): _turned(c) for i, ring in enumerate(shapes) for part, c in enumerate(clipped_rings(ring, BOUNDS))}
    assert len(theirs) > 110 and ours == theirs


def test_split_rows_are_the_tiles_of_a_walk(spark):
    shapes = _shapes()[:30]
    found = materialise(split_edges(edges_of(_table(spark, shapes)), 0.75, block=16))
    ours = sorted((r.poly_id, _turned([(p.x, p.y) for p in r.ring])) for r in rings_of(found, "piece", "poly_id").collect())
    theirs = []
    for i, ring in enumerate(shapes):
        xs, ys = zip(*ring)
        if max(xs) - min(xs) <= 0.75 and max(ys) - min(ys) <= 0.75:
            theirs.append((i, _turned(ring)))
            continue
        ends = [[(low + k * 0.75, min(low + (k + 1) * 0.75, high)) for k in range(math.ceil((high - low) / 0.75))] for low, high in ((math.floor(min(v)), math.ceil(max(v))) for v in (xs, ys))]
        theirs += [(i, _turned(c)) for x in ends[0] for y in ends[1] for c in clipped_rings(ring, (*x, *y))]
    assert ours == sorted(theirs)


def test_ring_of_many_vertices_is_split_without_a_row_that_holds_it(spark):
    """100,000 vertices made by Spark; blocks of its edges are carried on."""
    n = 100_000
    at = lambda i: (F.lit(3.0) + (2 + F.sin(i * 50 * 2 * math.pi / n)) * F.cos(i * 2 * math.pi / n), F.lit(3.0) + (2 + F.sin(i * 50 * 2 * math.pi / n)) * F.sin(i * 2 * math.pi / n))
    (ax, ay), (bx, by) = at(F.col("i")), at((F.col("i") + 1) % n)
    edges = spark.range(n).select(F.lit("0").alias("piece"), F.lit(0).alias("poly_id"), F.lit(1).alias("level"), F.col("id").alias("i"), F.lit(n).cast("long").alias("n"))
    edges = edges.select("*", ax.alias("ax"), ay.alias("ay"), bx.alias("bx"), by.alias("by"))
    found = materialise(split_edges(edges, 0.75))
    whole, parts = areas(edges, "poly_id").first().area, areas(found, "poly_id").first().area
    assert math.isclose(whole, parts, rel_tol=1e-9) and found.count() < 1.1 * n
    spans = found.groupBy("piece").agg((F.max("ax") - F.min("ax")).alias("w"), (F.max("ay") - F.min("ay")).alias("h"), F.count("*").alias("c"), F.max("n").alias("n"))
    assert spans.where("w > 0.75 or h > 0.75 or c <> n").isEmpty() and spans.count() > 60


def test_pieces_of_a_wide_ring(spark):
    """Sides of over 90 degrees that cutting makes are not taken round the globe."""
    ring = [(float(x), -40.0) for x in range(0, 301, 50)] + [(float(x), 40.0) for x in range(300, -1, -50)] + [(0.0, -40.0)]
    found = polygons.split_rows(_table(spark, [ring]), 25.0)
    assert math.isclose(areas(found, "poly_id").first().area, 300 * 80) and found.select("piece").distinct().count() == 48


def test_cycles_are_ranked_from_their_least_node(spark):
    draw, links, wanted = random.Random(3), [], set()
    for g in range(3):
        nodes = list(range(200))
        draw.shuffle(nodes)
        while nodes:
            cycle, nodes = nodes[: (size := draw.choice([1, 2, 7, 60]))], nodes[size:]
            k = cycle.index(min(cycle))
            cycle = cycle[k:] + cycle[:k]
            links += [(g, a, b) for a, b in zip(cycle, [*cycle[1:], cycle[0]])]
            wanted |= {(g, node, cycle[0], rank) for rank, node in enumerate(cycle)}
    found = cycle_ranks(spark.createDataFrame(links, "g int, node long, next long"), ["g"])
    assert {(r.g, r.node, r.leader, r["rank"]) for r in found.collect()} == wanted


def test_polygons_without_edges_and_empty_tables(spark):
    odd = _table(spark, [[(2.0, 2.0)]]).unionByName(spark.createDataFrame([(5, 1, []), (6, 1, None)], "poly_id long, level int, ring array<struct<x:double,y:double>>"))
    assert polygons.clip_rows(odd, BOUNDS).count() == 0 and polygons.split_rows(odd, 1.0).count() == 0
    assert polygons.clip_rows(odd.limit(0), BOUNDS).count() == 0 and polygons.split(odd.limit(0), 1.0).count() == 0


@pytest.mark.parametrize("rows", [1, 8, 64, 100_000])
def test_cycles_cut_into_chains_are_ranked_alike(spark, rows):
    """what meets in one place becomes one link; how much that is changes no rank."""
    draw, links, wanted = random.Random(5), [], set()
    for g in ("a", "b"):
        left = list(range(10, 400))
        while left:
            cycle, left = left[: (size := draw.choice([1, 2, 3, 40, 150]))], left[size:]
            turn = draw.choice([-1, 1])
            links += [(g, a, b, turn * a) for a, b in zip(cycle, [*cycle[1:], cycle[0]])]
            wanted |= {(g, node, cycle[0], rank) for rank, node in enumerate(cycle)}
    found = cycle_ranks(spark.createDataFrame(links, "g string, node long, next long, near long"), ["g"], "near", rows)
    assert {(r.g, r.node, r.leader, r["rank"]) for r in found.collect()} == wanted


def test_links_that_meet_are_not_joined_again(spark, tmp_path, monkeypatch):
    """a cycle of neighbours took a join of all nodes for each doubling; now only its chains are joined."""
    written, n = [], 20_000
    monkeypatch.setattr(rings, "materialise", lambda df, name="step": written.append((name, (out := materialise(df, name)).count())) or out)
    links = spark.range(n).select(F.lit(1).alias("g"), F.col("id").alias("node"), F.pmod(F.col("id") + 1, F.lit(n)).alias("next"))
    found = rings.cycle_ranks(links, ["g"], rows=1000)
    assert found.where("leader = 0 and rank = node").count() == n
    assert sum(rows for name, rows in written) < 2 * n


def test_polygons_are_measured_once_for_a_clip(spark, monkeypatch):
    """rings were made and measured again by every filter on their class; those outside are not stored."""
    written = []
    monkeypatch.setattr(polygons, "materialise", lambda df, name="step": written.append(materialise(df, name)) or written[-1], raising=False)
    shapes = [[(x, 1.0), (x + 2, 1.0), (x + 2, 2.0), (x, 2.0), (x, 1.0)] for x in (0.0, 2.0, 9.0)]
    found = polygons.clip_rows(_table(spark, shapes), BOUNDS)
    assert len(written) == 1 and written[0].count() == 3 and written[0].where("ring is null").count() == 1
    assert {(r.poly_id, r.area) for r in areas(found, "poly_id").collect()} == {(0, 1.0), (1, 2.0)}
