"""Rings as rows of edges: clipping to boxes and splitting along a quadtree, without a row that holds a ring.

A table of edges has ``piece, i, n, ax, ay, bx, by``: edge ``i`` of the ``n`` of a closed,
counter-clockwise ring. Clipping also needs ``tile, west, east, south, north``, one box
for each ``piece, tile``, and carries whatever else these two have.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tidegrid.plans.shared import broadcast_if_small, materialise
from tidegrid.plans.ship import ship

#: Edges of a ring that are looked at in one place; what goes on from one block to the next is carried.
BLOCK = 4096
#: Links of cycles that are put together in one place, about.
ROWS = 100_000
KEY = ["piece", "tile"]
BOX = ["west", "east", "south", "north"]
ENDS = ["ax", "ay", "bx", "by"]


def edges_of(polygons: DataFrame, *carry: str) -> DataFrame:
    """Edges of polygons ``poly_id, level, ring``; ``piece`` is the polygon's number as text."""
    n = F.size("ring") - 1
    ends = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct((i - 1).cast("long").alias("i"), *[F.col("ring")[i - o][v].alias(f"{e}{v}") for e, o in (("a", 1), ("b", 0)) for v in "xy"]))
    rows = polygons.select(F.col("poly_id").cast("string").alias("piece"), "poly_id", "level", *carry, n.cast("long").alias("n"), F.explode_outer(F.when(n > 0, ends)).alias("e"))
    # filtered after the explode: before it, rings that are expressions would be computed once more, uncompiled
    rows = rows.where("e is not null")
    return rows.select("piece", "poly_id", "level", *carry, "n", "e.*")


def rings_of(edges: DataFrame, *keys: str) -> DataFrame:
    """``keys, ring``: edges gathered to arrays, for rings that are known to be small."""
    points = F.transform(F.array_sort(F.collect_list(F.struct("i", *ENDS))), lambda e: F.struct(e["ax"].alias("x"), e["ay"].alias("y")))
    return edges.groupBy(*keys).agg(points.alias("p")).select(*keys, F.concat("p", F.slice("p", 1, 1)).alias("ring"))


def areas(edges: DataFrame, *keys: str) -> DataFrame:
    """``keys, area``: signed areas, each from its edges in any order."""
    return edges.groupBy(*keys).agg((F.sum(F.expr("ax * by - bx * ay")) / 2).alias("area"))


def _linked(links: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    """Chains within some rows of ``keys, node, next``, which are sorted by their keys.

    Every row gets the chain's first node as ``leader`` and its ``rank`` there; a cycle that is
    whole begins at its least node and is ``closed``. The first row of any other chain also has
    where the chain goes on (``to``), its ``length``, and its ``least`` node with its place, ``at``.
    """
    n = len(links)
    group = links[keys].ne(links[keys].shift()).any(axis=1).cumsum().to_numpy()
    node, following = links["node"].to_numpy(), links["next"].to_numpy()
    _, known = np.unique(np.concatenate([node, following]), return_inverse=True)
    own, ahead = group * (2 * n) + known[:n], group * (2 * n) + known[n:]
    order = np.argsort(own)
    found = order[np.minimum(np.searchsorted(own[order], ahead), n - 1)]
    linked = own[found] == ahead
    before = np.arange(n)
    before[found[linked]] = np.flatnonzero(linked)
    first = np.ones(n, bool)
    first[found[linked]] = False

    def walked() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every row the first of its chain, how far it is, and the least node up to there."""
        to, far, least = before.copy(), (~first).astype(np.int64), node.copy()
        for _ in range(n.bit_length()):
            if first[to].all():
                break
            least, far, to = np.minimum(least, least[to]), far + far[to], to[to]
        return to, far, np.minimum(least, least[to])

    to, _, least = walked()
    closed = ~first[to]
    leads = closed & (node == least)
    before[leads], first[leads] = np.flatnonzero(leads), True
    to, far, _ = walked()
    out = links[keys].assign(node=node, leader=node[to], rank=far, closed=closed, to=pd.NA, length=pd.NA, least=pd.NA, at=pd.NA)
    left = np.flatnonzero(~closed)
    chains = pd.DataFrame({"first": to[left], "far": far[left], "node": node[left], "next": following[left]})
    last, low = (chains.sort_values(["first", v]) for v in ("far", "node"))
    last, low = last.drop_duplicates("first", keep="last"), low.drop_duplicates("first")
    for name, rows, value in (("to", last, last["next"]), ("length", last, last["far"] + 1), ("least", low, low["node"]), ("at", low, low["far"])):
        held = np.zeros(n, np.int64)
        held[rows["first"]] = value
        out[name] = pd.array(held, dtype="Int64")
        out.loc[~(first & ~closed), name] = pd.NA
    return out


def cycle_ranks(links: DataFrame, keys: list[str], near: str = "node", rows: int = ROWS) -> DataFrame:
    """``keys, node, leader, rank`` of ``keys, node, next``, where each node is the next of one; ``leader`` is the least of its cycle.

    Nodes that have similar numbers ``near`` meet in one place, where chains of them become one
    link each; what is a cycle there is done. Of the links that are left, pointers double their
    reach in each round: first every one learns the least node of its cycle, then how far it is
    from there. A cycle of n links takes log n rounds of an equi-join, wherever they are.
    """
    spark = links.sparkSession
    ship(spark)

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def made() -> Iterator[pa.RecordBatch]:
            if sum(b.num_rows for b in held):
                out = _linked(pa.Table.from_batches(held).to_pandas(), keys)
                yield from pa.Table.from_pandas(out, schema=types, preserve_index=False).to_batches()

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= rows:
                yield from made()
                held = []
        yield from made()

    columns = [*[(f.name, f.dataType) for f in links.select(*keys).schema], *[(c, LongType()) for c in ("node", "leader", "rank")], ("closed", BooleanType()), *[(c, LongType()) for c in ("to", "length", "least", "at")]]
    kind = StructType([StructField(*c) for c in columns])
    types = to_arrow_schema(kind)
    dealt = links.select(*keys, F.col("node").cast("long"), F.col("next").cast("long"), F.col(near).alias("near")).repartition(*keys, F.expr(f"near div {rows}"))
    chains = materialise(dealt.sortWithinPartitions(*keys, "near").drop("near").mapInArrow(chained, kind), "chains")
    ranked = chains.where("closed").select(*keys, "node", "leader", "rank")
    open_ = chains.where("to is not null").select(*keys, "node", "to", "length", "least", "at")
    if open_.isEmpty():
        return ranked

    now = materialise(open_.select(*keys, "node", "to", "least"), "cycles")
    while True:
        ahead = now.select(*keys, F.col("node").alias("to"), F.col("to").alias("beyond"), F.col("least").alias("other"))
        met = now.join(ahead, [*keys, "to"]).select(*keys, "node", F.col("beyond").alias("to"), F.least("least", "other").alias("least"), (F.col("other") < F.col("least")).alias("moved"))
        met = materialise(met, "cycles")
        now = met.drop("moved")
        if met.where("moved").isEmpty():
            break
    leaders = now.select(*keys, "node", F.col("least").alias("leader"))
    known = materialise(open_.join(leaders, [*keys, "node"]), "leaders")
    # the chain that holds the leader is the last one to be reached
    goals = known.where("least = leader").select(*keys, F.col("node").alias("to"), F.lit(True).alias("goal"))
    left = known.join(goals, [*keys, "to"], "left")
    left = materialise(left.select(*keys, "node", "leader", F.when(F.col("goal").isNull(), F.col("to")).alias("to"), F.col("length").alias("far")), "ranks")
    while not left.where("to is not null").isEmpty():
        ahead = left.select(*keys, F.col("node").alias("to"), F.col("to").alias("beyond"), F.col("far").alias("more"))
        met = left.join(ahead, [*keys, "to"], "left")
        left = materialise(met.select(*keys, "node", "leader", F.col("beyond").alias("to"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far")), "ranks")
    cycle = Window.partitionBy(*keys, "leader")
    left = left.join(known.select(*keys, "node", "least", "at"), [*keys, "node"]).withColumn("whole", F.max("far").over(cycle))
    # places count from the chain's first node; the leader may be further on in it
    begin = F.col("whole") - F.col("far") - F.max(F.when(F.col("least") == F.col("leader"), F.col("at"))).over(cycle)
    begins = left.select(*keys, F.col("node").alias("first"), F.col("leader").alias("least"), begin.alias("begin"), "whole")
    begins = broadcast_if_small(materialise(begins, "begins"))
    rest = chains.where("not closed").select(*keys, "node", F.col("leader").alias("first"), "rank").join(begins, [*keys, "first"])
    return ranked.unionByName(rest.select(*keys, "node", F.col("least").alias("leader"), F.expr("pmod(begin + rank, whole)").alias("rank")))


def _through(edges: DataFrame) -> DataFrame:
    """Edges with ``passes``, whether they pass through the open box, and when they come in and go out, ``low`` and ``high``.

    What is used several times is a column of its own, so that the code for a row stays small enough to be compiled.
    """
    axes = (("x", "west", "east"), ("y", "south", "north"))
    out = edges.withColumns({f"d{v}": F.col(f"b{v}") - F.col(f"a{v}") for v, _, _ in axes})
    near = {f"near_{v}": F.when(F.col(f"d{v}") > 0, F.col(lo)).otherwise(F.col(hi)) for v, lo, hi in axes}
    out = out.withColumns(near | {f"far_{v}": F.when(F.col(f"d{v}") > 0, F.col(hi)).otherwise(F.col(lo)) for v, lo, hi in axes})
    at = lambda side, v: (F.col(f"{side}_{v}") - F.col(f"a{v}")) / F.nullif(F.col(f"d{v}"), F.lit(0.0))
    out = out.withColumns({f"in_{v}": at("near", v) for v in "xy"} | {f"out_{v}": at("far", v) for v in "xy"})
    out = out.withColumns({"low": F.greatest(F.lit(0.0), "in_x", "in_y"), "high": F.least(F.lit(1.0), "out_x", "out_y")})
    inner = [(F.col(f"d{v}") != 0) | ((F.col(f"a{v}") > F.col(lo)) & (F.col(f"a{v}") < F.col(hi))) for v, lo, hi in axes]
    return out.withColumn("passes", inner[0] & inner[1] & (F.col("low") < F.col("high")))


def _end(t: str, time: str, side: str, own: str) -> Column:
    """Where an edge begins (ends) within the box."""
    at = {v: F.least(F.greatest(F.col(f"a{v}") + F.col(t) * F.col(f"d{v}"), F.col(lo)), F.col(hi)) for v, lo, hi in (("x", "west", "east"), ("y", "south", "north"))}
    cut_x = F.struct(F.col(f"{side}_x").alias("x"), at["y"].alias("y"))
    cut_y = F.struct(at["x"].alias("x"), F.col(f"{side}_y").alias("y"))
    kept = F.struct(F.col(f"{own}x").alias("x"), F.col(f"{own}y").alias("y"))
    return F.when(F.col(t) == (0.0 if own == "a" else 1.0), kept).when(F.coalesce(F.col(f"{time}_x") == F.col(t), F.lit(False)), cut_x).otherwise(cut_y)


def _position(p: str) -> Column:
    """Place along a box's sides of a point on them, counter-clockwise from the lower left corner."""
    x, y = F.col(f"{p}.x"), F.col(f"{p}.y")
    wide, high = F.col("east") - F.col("west"), F.col("north") - F.col("south")
    side = F.when(y == F.col("south"), (x - F.col("west")) / wide).when(x == F.col("east"), 1 + (y - F.col("south")) / high)
    return side.when(y == F.col("north"), 2 + (F.col("east") - x) / wide).otherwise(3 + (F.col("north") - y) / high)


def _short(edges: DataFrame) -> DataFrame:
    """Edges of over 90 degrees go the short way, once from each of their ends: ``sub`` 0 and 1."""
    turn = F.expr("360 * signum(bx - ax)")
    ends = lambda s, ax, bx: F.struct(F.lit(s).alias("sub"), ax.alias("ax"), F.col("ay"), bx.alias("bx"), F.col("by"))
    both = F.array(ends(0, F.col("ax"), F.col("bx") - turn), ends(1, F.col("ax") + turn, F.col("bx")))
    one = F.array(ends(0, F.col("ax"), F.col("bx")))
    rest = [c for c in edges.columns if c not in ENDS]
    return edges.select(*rest, F.explode(F.when(F.abs(F.col("bx") - F.col("ax")) > 90, both).otherwise(one)).alias("e")).select(*rest, "e.*")


def _stretched(parts: DataFrame, block: int) -> DataFrame:
    """``head``: the first part of the stretch that each part belongs to; null in a ring that the box does not cut.

    A part goes on from the one before along the ring if both have the vertex between them.
    Parts are dealt out by blocks of their ring; the last of a block is also seen by the next,
    and that of the ring by its first.
    """
    after = F.when(F.col("i") == F.col("n") - 1, F.struct(F.lit(0).cast("long").alias("block"), F.lit(-1).cast("long").alias("o"), F.lit(True).alias("ghost")))
    after = after.when((F.col("i") + 1) % block == 0, F.struct(F.expr(f"(i + 1) div {block}").alias("block"), F.col("i").alias("o"), F.lit(True).alias("ghost")))
    own = F.struct(F.expr(f"i div {block}").alias("block"), F.col("i").alias("o"), F.lit(False).alias("ghost"))
    rows = parts.withColumn("w", F.explode(F.filter(F.array(own, after), lambda x: x.isNotNull()))).select(*parts.columns, "w.*")
    w = Window.partitionBy(*KEY, "block").orderBy("o", "sub")
    joined = (F.lag("o").over(w) == F.col("o") - 1) & F.lag("own_stop").over(w) & F.col("own_start") & (F.lag("q").over(w) == F.col("p"))
    rows = rows.withColumn("head", F.when(~F.coalesce(joined, F.lit(False)) & ~F.col("ghost"), 2 * F.col("i") + F.col("sub")))
    rows = rows.withColumn("top", F.max("head").over(Window.partitionBy(*KEY, "block"))).withColumn("head", F.last("head", True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.where("not ghost")
    small = rows.where(F.col("n") <= block).withColumn("head", F.coalesce("head", "top"))
    if parts.where(F.col("n") > block).isEmpty():
        return small.drop("block", "o", "ghost", "top")
    large = materialise(rows.where(F.col("n") > block), "blocks")
    tops = large.groupBy(*KEY, "block").agg(F.max("top").alias("top"))
    ring = Window.partitionBy(*KEY)
    before = F.last("top", True).over(ring.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    carried = tops.select(*KEY, "block", F.coalesce(before, F.max("top").over(ring)).alias("carried"))
    large = large.join(carried, [*KEY, "block"]).withColumn("head", F.coalesce("head", "carried")).drop("carried")
    return small.unionByName(large).drop("block", "o", "ghost", "top")


def clip_edges(edges: DataFrame, block: int = BLOCK, around: bool = True) -> DataFrame:
    """Edges of the parts of rings within their boxes, with ``part``; ``i, n`` are numbered anew.

    With ``around`` edges of over 90 degrees are taken the short way round the globe.

    Each edge is cut by itself. What goes on from one to the next forms stretches, and each
    stretch leads, along the box's sides and counter-clockwise, to the one that enters next:
    along the sides ends and beginnings take turns, so the next is known by rank. Cycles of
    these successors are the rings. A box that no edge passes through is a part itself where
    its middle lies in the ring.
    """
    carry = [c for c in edges.columns if c not in (*KEY, *BOX, *ENDS, "i", "n")]
    short = _short(edges) if around else edges.withColumn("sub", F.lit(0))
    over = F.expr("(ay > (south + north) / 2) <> (by > (south + north) / 2) AND ((bx - ax) * ((south + north) / 2 - ay) - ((west + east) / 2 - ax) * (by - ay) > 0) = (by > ay)")
    short = _through(short)
    held = short.groupBy(*KEY).agg(F.max("passes").alias("some"), F.count_if(over).alias("over"), *[F.first(c).alias(c) for c in (*BOX, *carry)])
    corners = [("west", "south"), ("east", "south"), ("east", "north"), ("west", "north")]
    sides = [F.struct(F.lit(k).cast("long").alias("i"), *[F.col(c).alias(e) for e, c in zip(ENDS, (*corners[k], *corners[(k + 1) % 4]))]) for k in range(4)]
    full = held.where("not some and over % 2 = 1").select(*KEY, *carry, F.lit(0).alias("part"), F.lit(4).cast("long").alias("n"), F.explode(F.array(*sides)).alias("e")).select(*KEY, *carry, "part", "n", "e.*")

    parts = short.where("passes").select(*KEY, *BOX, *carry, "i", "n", "sub", _end("low", "in", "near", "a").alias("p"), _end("high", "out", "far", "b").alias("q"), (F.col("low") == 0.0).alias("own_start"), (F.col("high") == 1.0).alias("own_stop"))
    parts = materialise(_stretched(materialise(parts, "passes"), block), "parts")
    ends = {"ax": "p.x", "ay": "p.y", "bx": "q.x", "by": "q.y"}
    whole = parts.where("head is null").select(*KEY, *carry, F.lit(0).alias("part"), "n", "i", *[F.col(c).alias(e) for e, c in ends.items()])
    cut = parts.where("head is not null").withColumn("place", F.expr("pmod(i - head div 2, n)"))

    found = cut.groupBy(*KEY, "head").agg(
        F.count("*").alias("m"), F.min_by("p", "place").alias("first"), F.max_by("q", "place").alias("last"),
        F.sum(F.expr("p.x * q.y - q.x * p.y")).alias("twice"), *[F.first(c).alias(c) for c in (*BOX, *carry)],
    )
    found = found.withColumns({"enter": _position("first"), "leave": F.pmod(_position("last"), F.lit(4.0))})
    box = Window.partitionBy(*KEY)
    found = found.withColumn("node", F.row_number().over(box.orderBy("enter", "head")).cast("long")).withColumn("turn", F.row_number().over(box.orderBy("leave", "head")))
    found = found.withColumn("all", F.count("*").over(box)).withColumn("ahead", F.when(F.min("leave").over(box) <= F.min("enter").over(box), 0).otherwise(1))
    found = materialise(found.withColumn("next", F.expr("pmod(turn - 1 + ahead, `all`) + 1")), "stretches")
    several = found.where(F.col("all") > 1)
    ranked = found.where(F.col("all") == 1).select(*KEY, "node", F.col("node").alias("leader"), F.lit(0).cast("long").alias("rank"))
    if not several.isEmpty():
        ranked = ranked.unionByName(cycle_ranks(several.select(*KEY, "node", "next", "head"), KEY, "head"))
    to = found.select(*KEY, F.col("node").alias("next"), F.col("enter").alias("to"), F.col("first").alias("goal"))
    led = found.join(to, [*KEY, "next"]).join(ranked, [*KEY, "node"])
    led = led.withColumn("reach", F.pmod(F.col("to") - F.col("leave"), F.lit(4.0)))

    # the way along the sides: from where a stretch leaves over the corners that come before the next
    corner = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in corners])
    at = F.filter(F.sequence((F.floor("leave") + 1).cast("int"), (F.floor("leave") + 5).cast("int")), lambda c: (c > F.col("leave")) & (c - F.col("leave") < F.col("reach")))

    def way(rows: DataFrame) -> DataFrame:
        path = F.concat(F.array("last"), F.transform(at, lambda c: F.get(corner, F.pmod(c, F.lit(4)))), F.array("goal"))
        steps = F.transform(F.sequence(F.lit(1), F.size("path") - 1), lambda k: F.struct(F.col("path")[k - 1].alias("p"), F.col("path")[k].alias("q")))
        return rows.withColumn("path", path).withColumn("steps", F.filter(steps, lambda s: s["p"] != s["q"])).drop("path")

    led = way(led)
    # a cycle that closes where it began and runs clockwise goes round the whole box
    ring = Window.partitionBy(*KEY, "leader")
    link = F.aggregate("steps", F.lit(0.0), lambda s, e: s + e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"])
    round_ = (F.sum(F.col("twice") + link).over(ring) < 0) & (F.col("next") == F.col("leader")) & (F.col("reach") == 0)
    led = way(led.withColumn("reach", F.when(round_, 4.0).otherwise(F.col("reach"))))
    count = F.col("m") + F.size("steps")
    led = led.withColumn("offset", F.coalesce(F.sum(count).over(ring.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("of", F.sum(count).over(ring))
    led = materialise(led.withColumn("part", F.dense_rank().over(box.orderBy("leader")) - 1).select(*KEY, *carry, "head", "part", "m", "offset", F.col("of").alias("n"), "steps"), "led")

    inner = cut.drop("n", *carry).join(led.drop("m", "steps"), [*KEY, "head"])
    inner = inner.select(*KEY, *carry, "part", "n", (F.col("offset") + F.col("place")).alias("i"), *[F.col(c).alias(e) for e, c in ends.items()])
    along = led.select(*KEY, *carry, "part", "n", "m", "offset", F.posexplode("steps").alias("k", "s"))
    along = along.select(*KEY, *carry, "part", "n", F.expr("offset + m + k").alias("i"), *[F.col(f"s.{c}").alias(e) for e, c in ends.items()])
    return reduce(DataFrame.unionByName, (x.select(*KEY, *carry, "part", "i", "n", *ENDS) for x in (whole, inner, along, full)))


def split_edges(edges: DataFrame, limit: float, block: int = BLOCK) -> DataFrame:
    """Edges of ``piece, poly_id, level``, cut to tiles: ``piece`` is one for each part of each tile.

    Tiles are ``limit`` on a side, from the whole degrees around a ring; the last of a row or
    column takes what remains. Ranges of tiles are halved, both ways at once, and a piece is
    clipped to the up to four ranges it is in, until each is one tile: every vertex moves once
    for each level, as many as the logarithm of the tiles.
    """
    carried = ["poly_id", "level"]
    spans = edges.groupBy("piece").agg(F.min("ax").alias("w"), F.max("ax").alias("e"), F.min("ay").alias("s"), F.max("ay").alias("n_"))
    large = (F.col("e") - F.col("w") > limit) | (F.col("n_") - F.col("s") > limit)
    many = lambda a, b: F.ceil((F.ceil(b) - F.floor(a)) / limit).cast("int")
    as_ = lambda c, f: f(c).cast("double")
    spans = spans.select("piece", large.alias("large"), as_("w", F.floor).alias("x0"), as_("e", F.ceil).alias("x1"), as_("s", F.floor).alias("y0"), as_("n_", F.ceil).alias("y1"), many("w", "e").alias("i1"), many("s", "n_").alias("j1"))
    now = edges.join(spans, "piece").withColumns({"i0": F.lit(0), "j0": F.lit(0)})
    # a small file is one partition, however many edges it has
    now = materialise(now.repartition(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), "piece", "i"), "whole")
    range_, base = ["i0", "i1", "j0", "j1"], ["x0", "x1", "y0", "y1"]
    done = [now.where("not large")]
    now = now.where("large")
    single = "i1 - i0 = 1 and j1 - j0 = 1"
    level = 0
    while level == 0 or not now.isEmpty():
        # one tile from the start is still clipped, to itself
        halves = lambda a, b: F.expr(f"IF({b} - {a} = 1, array(struct({a} AS a, {b} AS b)), array(struct({a} AS a, ({a} + {b}) div 2 AS b), struct(({a} + {b}) div 2 AS a, {b} AS b)))")
        rest = [*carried, *base, "piece", "i", "n", *ENDS]
        dealt = now.select(*rest, "j0", "j1", F.posexplode(halves("i0", "i1")).alias("tx", "h")).select(*rest, "tx", F.col("h.a").cast("int").alias("i0"), F.col("h.b").cast("int").alias("i1"), F.posexplode(halves("j0", "j1")).alias("ty", "v"))
        dealt = dealt.select(*rest, "i0", "i1", F.col("v.a").cast("int").alias("j0"), F.col("v.b").cast("int").alias("j1"), (2 * F.col("tx") + F.col("ty")).alias("tile"))
        low, high = lambda o, i: F.col(o) + F.col(i) * limit, lambda o, i, top: F.least(F.col(o) + F.col(i) * limit, F.col(top))
        dealt = dealt.withColumns({"west": low("x0", "i0"), "east": high("x0", "i1", "x1"), "south": low("y0", "j0"), "north": high("y0", "j1", "y1")})
        clipped = clip_edges(dealt, block, around=level == 0).withColumn("piece", F.concat_ws(".", "piece", F.col("tile").cast("string"), F.col("part").cast("string")))
        clipped = materialise(clipped.select("piece", *carried, *base, *range_, "i", "n", *ENDS), "level")
        done.append(clipped.where(single))
        now, level = clipped.where(f"not ({single})"), level + 1
    return reduce(DataFrame.unionByName, (x.select("piece", *carried, "i", "n", *ENDS) for x in done))
