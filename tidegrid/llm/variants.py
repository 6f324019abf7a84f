"""Words that differ by one character, and the frequent word each is a variant of.

Of two words that differ by one inserted, deleted or replaced character, with ``m`` the
shorter length, the first ``m // 2`` characters are equal or the last ``m - m // 2`` are.
Words are dealt out by both halves: to groups of equal beginnings, and, reversed, to
groups of equal ends. A task builds the minimal acyclic automaton of its groups, so
those of beginnings are a forward and those of ends a backward automaton; it
matches the half, completes the word with one error, and word numbers tell which
row was met. Groups that are too large are dealt out once more, by halves of the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.automaton import Automaton, coded
from tidegrid.llm.words import ascii_lower
from tidegrid.plans.shared import broadcast_if_small, materialise, scratch
from tidegrid.plans.ship import ship

#: Words of a group at most before it is dealt out by halves of the rest; rows of an automaton, rounded up to whole groups.
GROUP, CHUNK = 4_000, 32_768
LETTERS = "[A-Za-zÀ-ÿ]"


def counted(docs: DataFrame, least: int = 7, often: int = 2, drop: int | None = None) -> DataFrame:
    """``word, n``: words of whole texts with at least ``least`` characters and ``often`` places.

    Words are maximal runs of ``LETTERS``, with A-Z in lower case; a null text has none.
    With ``drop``, a run whose crc32(``<doc_id>:<run>``) it divides loses the character
    at that number modulo its length (a row without doc_id loses none).
    """
    # a run shorter than a word cannot become one, and is not matched in part: runs begin where others end
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"{LETTERS}{{{least},}}"), 0)
    each = docs.select(F.col("doc_id").cast("string").alias("d"), F.explode(runs).alias("w")).select("d", ascii_lower(F.col("w")).alias("w"))
    if drop:
        each = each.withColumn("h", F.crc32(F.encode(F.concat("d", F.lit(":"), "w"), "UTF-8")))
        cut = F.expr("concat(substring(w, 1, cast(h % length(w) AS int)), substring(w, cast(h % length(w) AS int) + 2))")
        each = each.withColumn("w", F.when(F.col("h") % drop == 0, cut).otherwise(F.col("w"))).where(F.length("w") >= least)
    return each.groupBy(F.col("w").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= often)


def _dealt(words: DataFrame, group: int) -> DataFrame:
    """``grp, back, k, m, side, s, n``: each word, or its reverse, in each group it belongs to.

    ``k`` characters are equal in a group. With ``m``, only pairs of that shorter length are
    of the group, whose words have equal quarters too: the one after the half (side 1) or
    the last (side 2).
    """
    halves = "array({})".format(", ".join(f"struct({b} AS back, {k} AS k)" for b, k in (("false", "l div 2"), ("false", "(l - 1) div 2"), ("true", "l - l div 2"), ("true", "l - 1 - (l - 1) div 2"))))
    rows = words.withColumn("l", F.length("word")).withColumn("h", F.explode(F.array_distinct(F.expr(halves))))
    rows = rows.select("n", "l", "h.back", F.col("h.k").cast("int").alias("k"), F.when(F.col("h.back"), F.reverse("word")).otherwise(F.col("word")).alias("s"))
    rows = rows.withColumn("half", F.expr("substring(s, 1, k)"))
    hot = materialise(rows.groupBy("back", "half").agg(F.count("*").alias("rows")).where(F.col("rows") > group).select("back", "half"), "hot")
    rows = rows.withColumn("grp", F.concat(F.col("back").cast("string"), F.lit(" "), "half"))
    plain = ["grp", "back", "k", "m", "side", "s", "n"]
    if hot.isEmpty():
        return rows.withColumns({"m": F.lit(0), "side": F.lit(0)}).select(plain)
    few = broadcast_if_small(hot)
    cold = rows.join(few, ["back", "half"], "left_anti").withColumns({"m": F.lit(0), "side": F.lit(0)}).select(plain)
    of = rows.join(few, ["back", "half"], "left_semi").withColumn("m", F.explode(F.array("l", F.col("l") - 1))).where("k = IF(back, m - m div 2, m div 2)")
    of = of.withColumn("side", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("q", F.expr("(m - k) div 2"))
    quarter = F.expr("IF(side = 1, substring(s, k + 1, q), right(s, m - k - q))")
    deep = of.withColumn("grp", F.concat_ws(" ", "grp", F.col("m").cast("string"), F.col("side").cast("string"), quarter))
    return cold.unionByName(deep.select(plain))


def _common(labels: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray, reverse: np.ndarray) -> np.ndarray:
    """Characters that the words of rows a and b begin with alike; rows of ``reverse`` are read from their ends."""
    out, going = np.zeros(len(a), np.int64), np.ones(len(a), bool)
    for i in range(1, labels.shape[1]):
        left = np.where(reverse[a], size[a] - i, i)
        right = np.where(reverse[b], size[b] - i, i)
        going &= (left >= 1) & (right >= 1) & (left < size[a]) & (right < size[b])
        going &= labels[a, np.maximum(left, 0).clip(max=labels.shape[1] - 1)] == labels[b, np.maximum(right, 0).clip(max=labels.shape[1] - 1)]
        if not going.any():
            break
        out += going
    return out


def _searched(table: pa.Table) -> pa.RecordBatch:
    """``word, n_near, best, form`` of whole groups: near words of each row, and the one of largest ``n``."""
    text, grp = table["s"].to_pylist(), table["grp"].to_pylist()
    back, k, m, side, n = (table[c].to_numpy() for c in ("back", "k", "m", "side", "n"))
    number = np.cumsum([0, *(x != y for x, y in zip(grp, grp[1:]))]) + 1
    labels, size = coded(text, number)
    a, b = Automaton(labels, size).one_error(labels, size, k + 1)  # the group's number is one label more
    short = np.minimum(size[a], size[b]) - 1
    half = short // 2
    fits = np.where(m[a] > 0, short == m[a], np.where(back[a], short - half, half) == k[a])
    a, b, short, half = a[fits], b[fits], short[fits], half[fits]
    # a pair is of one group: beginnings come before ends, and the quarter after the half before the last
    forward = back[a] & (_common(labels, a, b, size, back) >= half)
    same = _common(labels, a, b, size, np.zeros(len(text), bool))
    first = (side[a] == 2) & (same >= k[a] + (short - k[a]) // 2)
    a, b = a[~forward & ~first], b[~forward & ~first]
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    words = np.array([t[::-1] if r else t for t, r in zip(text, back)], object)
    rank = np.empty(len(text), np.int64)
    rank[np.argsort(words, kind="stable")] = np.arange(len(text))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    top = np.flatnonzero(np.diff(a, prepend=-1))
    near = np.diff(np.append(top, len(a)))
    return pa.RecordBatch.from_arrays([pa.array(words[a[top]], pa.string()), pa.array(near, pa.int64()), pa.array(n[b[top]], pa.int64()), pa.array(words[b[top]], pa.string())], ["word", "n_near", "best", "form"])


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Whole groups of sorted rows, about ``most`` at a time, searched."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < most:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        grp = table["grp"].to_pylist()
        cut = next((i for i in range(len(grp) - 1, 0, -1) if grp[i] != grp[i - 1]), 0)  # the last group may go on
        if cut:
            yield _searched(table.slice(0, cut).combine_chunks())
            held, rows = table.slice(cut).to_batches(), len(grp) - cut
    if rows:
        yield _searched(pa.Table.from_batches(held).combine_chunks())


def near_words(words: DataFrame, group: int = GROUP, chunk: int = CHUNK) -> DataFrame:
    """``word, n_near, best, form`` of each word of ``word, n`` that has near words.

    ``form`` is the near word of the largest n, which is ``best``; of equal ones the first
    in code-point order. Words are distinct and have two characters or more.
    """
    spark = words.sparkSession
    ship(spark)
    dealt = _dealt(words, group)
    parts = max(words.count() * 4 // chunk + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sorted_ = dealt.repartition(parts, "grp").sortWithinPartitions("grp", "s")
    found = sorted_.mapInArrow(lambda batches: _chunks(batches, chunk), "word string, n_near long, best long, form string")
    best = F.min(F.struct((-F.col("best")).alias("less"), "form")).alias("f")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("f.less")).alias("best"), "f.form")


def variants(words: DataFrame, ratio: int = 10, group: int = GROUP, chunk: int = CHUNK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each row of ``word, n``.

    Two words are near if they differ by one inserted, deleted or replaced code point. The
    form of a word is its near word of largest n (of equal ones the first in code-point
    order) if that is at least ``ratio`` times its own; ``root`` is where its forms end, the
    word itself if it has none. No word has a null or is repeated; an empty table gives an
    empty result; other columns are not read.

    A form has at least ``ratio`` (2 or more) times the places, so chains are short, and each
    round doubles the part of them that is known.
    """
    if ratio < 2:
        raise ValueError("forms of less than twice the places could go round")
    spark = words.sparkSession
    with scratch(spark, "word_forms", "word_roots"):
        words = materialise(words.select("word", "n"), "words")
        near = near_words(words, group, chunk)
        out = words.join(near, "word", "left")
        has = F.col("best") >= ratio * F.col("n")
        out = out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("form")).alias("form"), F.when(has, F.col("best")).alias("form_n"))
        out = materialise(out, "word_forms")
        ahead = materialise(out.where("form is not null").select("word", F.col("form").alias("root")), "word_roots")
        while True:
            beyond = ahead.toDF("root", "next")
            if ahead.join(beyond, "root", "left_semi").isEmpty():
                break
            ahead = materialise(ahead.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "word_roots")
    return out.join(ahead, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, least: int = 7, often: int = 2, ratio: int = 10, drop: int | None = None) -> DataFrame:
    """:func:`variants` of the words of all texts, see :func:`counted`.

    Nulls, empty texts and texts without words of ``least`` characters give no rows, repeated
    rows count as often as they occur, other columns are not read.
    """
    return variants(counted(docs, least, often, drop), ratio)
