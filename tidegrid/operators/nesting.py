"""Masks of nested grids (0 dry, 1 wet, 2 boundary, 3 inactive) and of grids that overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.geometry import inside
from tidegrid.plans.shared import materialise


def zone(mask: DataFrame, ring: Column) -> DataFrame:
    """Everything outside a ring is inactive; ``mask`` has ``lon, lat``."""
    return mask.withColumn("mask", F.when(inside(ring, F.col("lon"), F.col("lat")), F.col("mask")).otherwise(3))


def boundary(mask: DataFrame, nx: int, ny: int) -> DataFrame:
    """Wet edge cells, and inactive cells beside a wet one, become boundary."""
    edge = F.col("k").isin(1, ny) | F.col("j").isin(1, nx)
    edged = mask.withColumn("mask", F.when(edge & (F.col("mask") == 1), 2).otherwise(F.col("mask")))
    row, column = Window.partitionBy("k").orderBy("j"), Window.partitionBy("j").orderBy("k")
    wet = lambda c: F.coalesce(c == 1, F.lit(False))
    m = F.col("mask")
    beside = edged.withColumn("beside", wet(F.lag(m).over(row)) | wet(F.lead(m).over(row)))
    beside = beside.withColumn("beside", F.col("beside") | wet(F.lag(m).over(column)) | wet(F.lead(m).over(column)))
    return beside.withColumn("mask", F.when((m == 3) & F.col("beside"), 2).otherwise(m)).drop("beside")


def _cells(v: Column, base: float, d: float, n: int, snap: float) -> list[Column]:
    """Lower index from 1 and fraction, snapped at both ends; null outside."""
    r = (v - base) / d
    i, f = F.floor(r) + 1, r - F.floor(r)
    low, high = (i == 0) & (F.abs(f - 1) < snap), (i == n) & (F.abs(f) < snap)
    within = (i >= 1) & (i <= n - 1)
    return [F.when(low, 1).when(high, n - 1).when(within, i).cast("int"), F.when(low, 0.0).when(high, 1.0).when(within, f)]


def parent_support(mask: DataFrame, parent: DataFrame, lon0: float, lat0: float, dx: float, dy: float, nx: int, ny: int, wrap: bool = False, snap: float = 0.05) -> DataFrame:
    """Boundary cells without support of the parent grid become inactive.

    Each of the four parents that weighs at least ``snap`` has to be 1 or 2 (in
    absolute value). ``parent`` has ``k, j, mask`` on a regular grid of ``nx`` x ``ny``
    nodes, which with ``wrap`` closes in longitude.
    """
    jy, ry = _cells(F.col("lat"), lat0, dy, ny, snap)
    if wrap:
        r = (F.col("lon") - lon0) / dx
        jx, rx = (F.pmod(F.floor(r), F.lit(nx)) + 1).cast("int"), r - F.floor(r)
    else:
        jx, rx = _cells(F.col("lon"), lon0, dx, nx, snap)
    edge = mask.where("mask = 2").select("k", "j", jx.alias("px"), jy.alias("py"), rx.alias("rx"), ry.alias("ry"))
    right = (F.col("px") % nx + 1) if wrap else F.col("px") + 1
    four = [
        F.struct((F.col("py") + n).alias("k"), (right if i else F.col("px")).alias("j"), ((F.col("rx") if i else 1 - F.col("rx")) * (F.col("ry") if n else 1 - F.col("ry"))).alias("w"))
        for i in (0, 1)
        for n in (0, 1)
    ]
    lost = edge.where("px is null or py is null").select("k", "j")
    asked = edge.where("px is not null and py is not null").select("k", "j", F.explode(F.array(*four)).alias("p")).where(F.col("p.w") >= snap)
    asked = asked.select(F.col("k").alias("ck"), F.col("j").alias("cj"), F.col("p.k").alias("k"), F.col("p.j").alias("j"))
    bad = asked.join(parent.select("k", "j", F.col("mask").alias("pm")), ["k", "j"], "left").where(~F.coalesce(F.abs("pm").isin(1, 2), F.lit(False)))
    lost = lost.unionByName(bad.select(F.col("ck").alias("k"), F.col("cj").alias("j"))).distinct().withColumn("lost", F.lit(True))
    return mask.join(lost, ["k", "j"], "left").withColumn("mask", F.when(F.col("lost"), 3).otherwise(F.col("mask"))).drop("lost")


def overlay(base: DataFrame, other: DataFrame) -> DataFrame:
    """The second mask wherever it is active, the first elsewhere."""
    return base.join(other.select("k", "j", F.col("mask").alias("over")), ["k", "j"]).withColumn("mask", F.when(F.col("over") != 3, F.col("over")).otherwise(F.col("mask"))).drop("over")


def reconcile(first: DataFrame, second: DataFrame, spacing: tuple[float, float]) -> tuple[DataFrame, DataFrame]:
    """Both masks ``k, j, lon, lat, mask`` where they agree, 0 where they don't.

    The grid of fewer nodes (the first of equals) asks, for its nodes within the other's
    extent, the nearest node of the other; grids are rectilinear, and a node further
    than the smaller spacing is an error. Values conflict if they differ and
    neither is 2. Once a node of the other grid has been in conflict, later nodes in
    column-major order compare with 0.
    """
    first, second = materialise(first, "first"), materialise(second, "second")
    swap = second.count() < first.count()
    driver, base = (second, first) if swap else (first, second)
    axes = {}
    box = base.agg(*(f(c).alias(f"{n}_{c}") for c in ("lon", "lat") for n, f in (("lo", F.min), ("hi", F.max)))).first()
    inner = driver.where(F.col("lon").between(box["lo_lon"], box["hi_lon"]) & F.col("lat").between(box["lo_lat"], box["hi_lat"]))
    for axis, index in (("lon", "j"), ("lat", "k")):
        # axes are as long as a side of a grid; tiles of the nearest distance bound the pairs
        d = min(spacing)
        mine = inner.select(axis).distinct().select(axis, F.explode(F.array(*[(F.floor(F.col(axis) / d) + i).cast("long") for i in (-1, 0, 1)])).alias("t"))
        theirs = base.select(F.col(axis).alias("b"), F.col(index).alias("i")).distinct().withColumn("t", F.floor(F.col("b") / d).cast("long"))
        near = mine.join(theirs, "t").withColumn("d", F.abs(F.col(axis) - F.col("b"))).where(F.col("d") <= d)
        axes[axis] = near.groupBy(axis).agg(F.min_by("i", F.struct("d", "i")).alias(f"b{index}"))
    asked = inner.select("k", "j", "lon", "lat", F.col("mask").alias("v")).join(axes["lon"], "lon", "left").join(axes["lat"], "lat", "left")
    asked = materialise(asked, "asked")
    if not asked.where("bj is null or bk is null").isEmpty():
        raise ValueError("a node has no neighbour in the other grid within its spacing")
    met = asked.join(base.select(F.col("k").alias("bk"), F.col("j").alias("bj"), F.col("mask").alias("b")), ["bk", "bj"])
    conflict = (F.col("v") != F.col("b")) & (F.col("v") != 2) & (F.col("b") != 2)
    earlier = Window.partitionBy("bk", "bj").orderBy("j", "k").rowsBetween(Window.unboundedPreceding, -1)
    met = met.withColumn("conflict", conflict).withColumn("spoilt", F.coalesce(F.max("conflict").over(earlier), F.lit(False)))
    met = materialise(met, "met")
    new = F.when(F.col("conflict") | (F.col("spoilt") & (F.col("v") != 2)), 0).otherwise(F.col("v"))
    changed = met.select("k", "j", new.alias("new"))
    zeroed = met.where("conflict").select(F.col("bk").alias("k"), F.col("bj").alias("j"), F.lit(0).alias("new")).distinct()
    put = lambda grid, to: grid.join(to, ["k", "j"], "left").withColumn("mask", F.coalesce("new", "mask")).drop("new")
    out = put(driver, changed), put(base, zeroed)
    return (out[1], out[0]) if swap else out
