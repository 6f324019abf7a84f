"""Benchmark passages in documents by a prefix-filtered set join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.words import alnum_words
from tidegrid.plans.shared import broadcast_if_small, materialise, scratch

#: Words of the shingles that are ordered by rarity.
PREFIX = 3
#: Shingles of the benchmark that are broadcast at most, and bits of the filter that stands for more.
VOCABULARY, SCREEN = 2_000_000, 27


def _windows(benchmark: DataFrame, size: int) -> DataFrame:
    """``item_id, win, width, words``: every window of every item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.explode(F.array(alnum_words(F.col("text")))).alias("w"))
    items = items.where("size(w) > 0").withColumn("width", F.least(F.size("w"), F.lit(size)))
    items = items.withColumn("o", F.explode(F.expr("sequence(0, size(w) - width)")))
    items = items.select("item_id", "width", F.expr("slice(w, o + 1, width)").alias("words"))
    return items.withColumn("win", F.array_join("words", " "))


def _grams(words: str, n: str, sizes: list[int]) -> str:
    """Hashes of the shingles of ``n`` words, of each size after the other, as a SQL expression."""
    of = lambda g: f"transform(sequence(0, {n} - {g}), i -> xxhash64({g}, {', '.join(f'{words}[i + {k}]' for k in range(g))}))"
    return "concat(" + ", ".join(f"IF({n} >= {g}, {of(g)}, CAST(array() AS array<bigint>))" for g in sizes) + ")"


def _screened(each: DataFrame, known: DataFrame) -> DataFrame:
    """The rows whose ``gram`` may be known: a filter of 2**SCREEN bits, which all tasks have, keeps others from being moved.

    Its words of 64 bits are at most ``2**(SCREEN - 6)`` rows of two numbers, however many are known.
    """
    place, word = f"gram & {2**SCREEN - 1}L", f"(gram & {2**SCREEN - 1}L) div 64"
    words = known.select(F.expr(word).alias("word"), F.expr(f"shiftleft(1L, cast(({place}) % 64 AS int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    met = each.withColumn("word", F.expr(word)).join(F.broadcast(words), "word")
    return met.where(F.expr(f"getbit(bits, cast(({place}) % 64 AS int)) = 1")).drop("word", "bits")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, share: int = 20) -> DataFrame:
    """Which words of each document lie in a window of ``size`` words of a benchmark item.

    Returns one row per row of ``docs``: ``doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated`` (``n_hit > 0`` and ``share * n_hit >= n_words``),
    and ``text_hash`` (``xxhash64`` of the text, to find the row again).
    Null texts and texts of separators only have no words; items of fewer than
    ``size`` words are one window, items without words none. Items without an id
    hit words but are not counted as items. Rows that repeat an id and a text get
    equal results; an empty table on either side gives no hits. No other column
    of either table is read.

    The elements of a window are its shingles of three words (a shorter window is one
    shingle), ordered by how rare they are in all documents. A document that contains
    the window has all of them, so the rarest alone is the prefix to join on. Where it
    stands bounds the window's place, the length of the text bounds its end, and the
    words there must then equal the window's. Words of other documents are read but
    neither stored nor moved: only shingles that the benchmark has leave the scan, or, where it
    has too many for every task to know, those that a filter of fixed size lets through.
    """
    with scratch(docs.sparkSession, "shingle_hits", "covered"):
        return _contamination(docs, benchmark, size, share)


def _contamination(docs: DataFrame, benchmark: DataFrame, size: int, share: int) -> DataFrame:
    windows = materialise(_windows(benchmark, size), "windows")
    distinct = windows.select("win", "width", "words").dropDuplicates(["win"]).withColumn("g", F.least("width", F.lit(PREFIX)))
    sizes = sorted(r["g"] for r in distinct.select("g").distinct().collect())
    grams = materialise(
        distinct.select("win", "width", "g", "words").select("win", "width", F.posexplode(F.expr("CASE g " + " ".join(f"WHEN {g} THEN {_grams('words', 'width', [g])}" for g in sizes or [1]) + " END")).alias("offset", "gram")),
        "grams",
    )
    text = F.col("text").cast("string")
    # explode(array(...)) finds the words once for all that use them
    worded = docs.select("doc_id", F.xxhash64(text).alias("h"), F.explode(F.array(alnum_words(F.col("text")))).alias("w")).withColumn("n", F.size("w"))
    place, before = "CASE", "0"
    for g in sizes:
        after = f"{before} + greatest(0, n - {g - 1})"
        place, before = f"{place} WHEN at < {after} THEN at - ({before})", after
    known = materialise(grams.select("gram").distinct(), "vocabulary").withColumn("known", F.lit(True))
    each = worded.select("doc_id", "h", "n", F.posexplode_outer(F.expr(_grams("w", "n", sizes or [1]))).alias("at", "gram"))
    pos = (F.expr(f"{place} END") if sizes else F.col("at")).cast("int").alias("pos")
    few = broadcast_if_small(known, VOCABULARY)
    if few is not known:
        # one row of each text stays for its number of words, so that one scan gives both
        hits = each.withColumn("first", F.coalesce(F.col("at") == 0, F.lit(True))).join(few, "gram", "left").where("known or first")
        hits = materialise(hits.select("doc_id", "h", "n", "first", "known", "gram", pos), "shingle_hits")
        counted, hits = hits.where("first").select("doc_id", "h", F.col("n").cast("long").alias("n_words")), hits.where("known")
    else:
        counted = materialise(worded.select("doc_id", "h", F.col("n").cast("long").alias("n_words")), "shingle_hits")
        hits = materialise(_screened(each, known).join(known, "gram").select("doc_id", "h", "n", "gram", pos), "shingle_hits")

    rarity = hits.groupBy("gram").agg(F.count("*").alias("k"))
    rarest = grams.join(rarity, "gram", "left").groupBy("win", "width").agg(F.min(F.struct(F.coalesce("k", F.lit(0)).alias("k"), "gram", "offset")).alias("p"))
    keys = broadcast_if_small(materialise(rarest.where("p.k > 0").select("p.gram", "p.offset", "width").distinct(), "prefixes"))
    starts = (
        hits.join(keys, "gram")
        .where("pos >= offset and pos - offset + width <= n")
        .groupBy("doc_id", "h")
        .agg(F.collect_set(F.struct((F.col("pos") - F.col("offset")).alias("start"), "width")).alias("starts"))
    )
    starts = materialise(starts, "starts").toDF("d", "g", "starts")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g"))
    read = docs.select("doc_id", F.xxhash64(text).alias("h"), text.alias("text")).join(broadcast_if_small(starts), same)
    read = read.select("doc_id", "h", "starts", F.explode(F.array(alnum_words(F.col("text")))).alias("w"))
    found = (
        read.select("doc_id", "h", F.explode(F.expr("transform(starts, s -> struct(s.start, s.width, array_join(slice(w, s.start + 1, s.width), ' ') AS win))")).alias("s"))
        .select("doc_id", "h", "s.start", "s.width", "s.win")
        .join(broadcast_if_small(distinct.select("win")), "win", "left_semi")
        .distinct()
    )
    found = materialise(found, "hits")
    covered = (
        found.groupBy("doc_id", "h")
        .agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("width")).alias("stop")))).alias("spans"))
        .select(
            "doc_id",
            "h",
            F.expr(
                "aggregate(spans, struct(0 AS n, 0 AS stop), (a, s) -> struct(a.n + greatest(0, s.stop - greatest(a.stop, s.start)) AS n, greatest(a.stop, s.stop) AS stop)).n"
            ).cast("long").alias("n_hit"),
        )
    )
    items = (
        found.join(windows.select("win", "item_id").where("item_id is not null").distinct(), "win")
        .groupBy("doc_id", "h", "item_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("doc_id", "h")
        .agg(F.array_sort(F.collect_list("item_id")).alias("items"))
        .select("doc_id", "h", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    )
    covered = covered.join(items.toDF("d", "g", "n_items", "items_sha256"), same, "left").select(F.col("doc_id").alias("d"), F.col("h").alias("g"), "n_hit", "n_items", "items_sha256")
    covered = broadcast_if_small(materialise(covered, "covered"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return counted.join(covered, same, "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
        F.col("h").alias("text_hash"),
    )
