"""Links between items that share a bucket, without listing a bucket's pairs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.components import connected_components
from tidegrid.plans.shared import broadcast_if_small, discard, materialise, screened, tidy

#: Shared bands, of 8 bytes each, that are broadcast at most: a table of so many takes 4 MB of the driver.
BROADCAST_BANDS = 50_000
#: Items that meet pairwise over one element at most; more make a group of their own.
HOT = 256


def shared_bands(bands: DataFrame) -> DataFrame:
    """Of ``band, id`` the rows of bands that several items have."""
    shared = materialise(bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band"), "shared")
    known = broadcast_if_small(shared, BROADCAST_BANDS)
    if known is shared:
        bands = screened(bands, shared, "band")
    return materialise(bands.join(known, "band", "left_semi"), "bands")


def ranked(sets: DataFrame, percent: int) -> DataFrame:
    """``id, n, c`` of the sets ``id, s`` that can have a link at all: size, and elements that another set has too.

    Two sets have at most ``c`` elements in common, and a link needs ``percent`` of either.
    """
    one = sets.select("id", F.explode("s").alias("g")).groupBy("g").agg(F.count("*").alias("k"), F.min("id").alias("id")).where("k = 1")
    alone = one.groupBy("id").agg(F.count("*").alias("alone"))
    sized = sets.select("id", F.size("s").cast("long").alias("n")).join(alone, "id", "left")
    sized = sized.select("id", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("c"))
    return materialise(sized.where(f"100 * c >= {percent} * n"), "ranked")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` with ``100 * intersection >= percent * union`` on full sets."""
    both = F.size(F.array_intersect("sa", "sb"))
    met = pairs.join(sets.toDF("b", "sb"), "b").join(sets.toDF("a", "sa"), "a")
    return met.where(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def _merged(parts: DataFrame | None, links: DataFrame) -> DataFrame:
    """``node, component`` with new links: only the components they join are looked at again."""
    if parts is None:
        return materialise(connected_components(links), "parts")
    of = lambda end: parts.toDF(end, f"c{end}")
    named = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    joined = materialise(connected_components(named).toDF("component", "least"), "joined")
    moved = parts.join(joined, "component", "left").select("node", F.coalesce("least", "component").alias("component"))
    added = joined.toDF("node", "component").join(parts.select("node"), "node", "left_anti")
    return materialise(moved.unionByName(added), "parts")


def _fits(percent: int) -> Column:
    """Whether sizes, and elements to share, of the sets ``x`` and ``y`` allow a link."""
    n = [F.col("x.n"), F.col("y.n")]
    shared = F.least("x.c", "y.c") * (100 + percent) >= percent * (n[0] + n[1])
    return (100 * F.least(*n) >= percent * F.greatest(*n)) & shared


def _apart(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of items of one ``ref`` and of two components that can be linked, by how they differ from it.

    ``rows`` has ``ref, id, n, c, component``. An item's difference is what it has and its
    reference has not, or the other way round; two items differ in what is in one
    difference only. ``_round`` looks at groups of such items; an element that too many
    differences of a group share makes a group of its own, whose differences are then
    counted from what most of its own items have. Such a group has half the items at
    most, so rounds are few.
    """
    k = (100 - percent) / (100 + percent)
    own = rows.join(sets.toDF("id", "s"), "id").join(sets.toDF("ref", "r"), "ref")
    now = own.select(F.col("ref").alias("g"), "id", "n", "c", "component", F.array_union(F.array_except("s", "r"), F.array_except("r", "s")).alias("e"))
    now, found = materialise(now, "differences"), []
    while True:
        pairs, deeper = _round(now, percent, k)
        found.append(pairs)
        discard(now)
        tidy(now.sparkSession)
        if deeper.isEmpty():
            return reduce(DataFrame.unionByName, found).distinct()
        now = deeper


def _round(now: DataFrame, percent: int, k: float) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b`` of groups ``g, id, n, c, component, e``, and the groups that hot elements make.

    Elements that more than half of a group's differences ``e`` have change sides: the
    differences are then counted from what most items have, and no element is in more than
    half of them. With ``t = d - k * n`` of an item of ``n`` elements and a difference of
    ``d``, a link needs differences to overlap by ``(t + t') / 2``. Where that is no bound the
    item of the least ``t`` is linked with both, so all others are held against that one.
    What overlap any other item allows at least, from the least ``t`` among them, says how
    many of the rarest elements of a difference have to be looked at: these are joined.
    """
    each = now.select("g", "id", F.explode("e").alias("x"))
    most = each.groupBy("g", "x").agg(F.count("*").alias("k")).join(now.groupBy("g").agg(F.count("*").alias("all")), "g").where("2 * k > all")
    # of each group one row: where these are few, no group is gathered to meet its own
    most = broadcast_if_small(materialise(most.groupBy("g").agg(F.collect_list("x").alias("h")), "most"))
    turned = now.join(most, "g", "left").withColumn("h", F.coalesce("h", F.expr("cast(array() as array<bigint>)")))
    turned = turned.withColumn("e", F.array_union(F.array_except("e", "h"), F.array_except("h", "e"))).drop("h")
    turned = materialise(turned.withColumn("d", F.size("e")).withColumn("t", F.expr(f"d - {k}D * n")), "turned")

    first = turned.groupBy("g").agg(F.min(F.struct("t", "id", "n", "c", "d", "component")).alias("y"))
    held = materialise(turned.join(broadcast_if_small(materialise(first, "first")), "g").where("id <> y.id"), "held")
    against = held.select("y", F.struct("id", "n", "c", "d", "component").alias("x")).where(F.col("x.component") != F.col("y.component"))
    against = against.where(_fits(percent) & F.expr(f"abs(x.d - y.d) <= {k}D * (x.n + y.n) + 1e-9"))
    pairs = against.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))

    least = broadcast_if_small(materialise(held.groupBy("g").agg(F.min("t").alias("low")), "least"))
    each = held.select("g", "id", F.explode("e").alias("e"))
    often = each.groupBy("g", "e").agg(F.count("*").alias("often")).where("often > 1")
    # elements of one difference only come first in the order and meet nothing: they need no row
    common = each.join(often, ["g", "e"]).groupBy("g", "id").agg(F.array_sort(F.collect_list(F.struct("often", "e"))).alias("l"))
    slim = held.select("g", "id", "n", "c", "component", "d", "t").join(least, "g").join(common, ["g", "id"])
    slim = slim.withColumn("alone", F.expr("d - size(l)")).withColumn("need", F.expr("greatest(1, ceil((t + low) / 2 - 1e-9))"))
    slim = slim.withColumn("keep", F.expr("d - need + 1 - alone")).where("keep > 0")
    keyed = slim.select("g", "id", "n", "c", "component", "t", "d", "alone", F.posexplode(F.expr("slice(l, 1, cast(keep AS int))")).alias("at", "x"))
    keyed = materialise(keyed.select("g", "id", "n", "c", "component", "t", F.expr("d - alone - at").alias("left"), "x.e"), "prefixes")

    # the same items make the same group, whichever element they share
    same = F.xxhash64("g", F.count("*"), F.bit_xor(F.xxhash64("id")), F.bit_xor(F.xxhash64(F.lit(5), "id"))).alias("group")
    keys = keyed.groupBy("g", "e").agg(F.count("*").alias("rows"), F.min("component").alias("low"), F.max("component").alias("high"), same).where("low < high")
    keys = materialise(keys.select("g", "e", "group", (F.col("rows") > HOT).alias("hot")), "keys")
    of = keyed.join(keys, ["g", "e"])
    cool = of.where("not hot")
    met = cool.alias("x").join(
        cool.alias("y"),
        (F.col("x.g") == F.col("y.g"))
        & (F.col("x.e") == F.col("y.e"))
        & (F.col("x.id") < F.col("y.id"))
        & (F.col("x.component") != F.col("y.component"))
        & _fits(percent)
        & F.expr("2 * least(x.left, y.left) >= x.t + y.t - 1e-9"),
    )
    pairs = materialise(pairs.unionByName(met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))).distinct(), "apart")
    deeper = of.where("hot").select("g", "group", "id").distinct().join(turned, ["g", "id"])
    return pairs, materialise(deeper.select(F.col("group").alias("g"), "id", "n", "c", "component", "e"), "differences")


def linked(bands: DataFrame, rank: DataFrame, percent: int, verify: Callable[[DataFrame], DataFrame], sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Components ``node, component`` of all links between items that share a band.

    ``bands`` has ``band, id``; ``rank`` has of each ``id`` there that can be linked
    ``n``, the size of its set, and ``c``, how many of these elements others may have.
    ``verify`` gives the linked ones of pairs ``a, b``, and ``sets_of`` the sets
    ``id, s`` of a table of ids.

    All items of a band are first held
    against the one that has the largest share of elements in common with others; links
    merge them into components. In bands that still have several, the best item of the
    largest component is the reference, and items of different components meet by how
    they differ from it (``_apart``). So no pair that could join two components is left
    out, copies of one text with changes of their own do not meet each other, and no
    band is gathered in one place.
    """
    placed = materialise(bands.join(rank, "id").select("band", "id", "n", "c"), "placed")
    best = F.min(F.struct((1 - F.col("c") / F.col("n")).alias("own"), "id", "n", "c")).alias("p")

    def found(pairs: DataFrame) -> DataFrame:
        return materialise(verify(pairs), "links")

    def against(rows: DataFrame, chosen: DataFrame) -> DataFrame:
        met = rows.alias("x").join(chosen.alias("y"), (F.col("x.band") == F.col("y.band")) & (F.col("x.id") != F.col("y.id")) & _fits(percent))
        return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))

    chosen = materialise(placed.groupBy("band").agg(best).select("band", "p.id", "p.n", "p.c"), "pivots")
    tested = materialise(against(placed, chosen).distinct(), "pairs")
    links = found(tested)
    parts = _merged(None, links)
    discard(links)
    tidy(bands.sparkSession)

    rest = placed.join(parts.toDF("id", "of"), "id", "left").select("band", "id", "n", "c", F.coalesce("of", "id").alias("component"))
    sizes = rest.groupBy("band", "component").agg(F.count("*").alias("k"), best)
    main = F.max(F.struct("k", F.struct((-F.col("p.own")).alias("own"), F.col("p.id").alias("id"), F.col("p.n").alias("n"), F.col("p.c").alias("c")).alias("p"), "component")).alias("m")
    mixed = sizes.groupBy("band").agg(main, F.count("*").alias("kinds")).where("kinds > 1")
    mixed = materialise(mixed.select("band", "m.p.id", "m.p.n", "m.p.c", "m.component"), "mixed")
    if mixed.isEmpty():
        return parts
    others = rest.join(mixed.select("band", F.col("id").alias("ref"), F.col("component").alias("main")), "band").where("id <> ref")
    others = materialise(others, "others")
    # pairs with the reference aside, a band has pairs where others are of several components
    several = others.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("band")
    rows = materialise(others.join(several, "band", "left_semi").select("ref", "id", "n", "c", "component").distinct(), "rows")
    ends = rows.select("id").unionByName(rows.select(F.col("ref").alias("id"))).distinct()
    apart = _apart(rows, sets_of(ends), percent)
    pairs = apart.unionByName(against(others.where("component <> main"), mixed)).distinct()
    pairs = materialise(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
    return _merged(parts, found(pairs))
