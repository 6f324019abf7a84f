"""Documents drawn in proportion to how much likelier they are in a target than in the corpus.

Counts of hashed features of all documents and of the target give each bucket a gain,
an array of numbers that every task knows. A document's weight is the mean gain of its
features; Gumbel noise from its id makes the largest sums a draw without replacement.
The draw itself is an external merge: each partition's eligible rows are stored as a
sorted run, ranges of the order take their slices of all runs, and a tournament tree
merges the slices of a range and stops at the exact count.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.blocks import blocks
from tidegrid.plans.shared import broadcast_if_small, materialise, scratch
from tidegrid.plans.ship import ship

#: Words of UTF-8 in lower case: letters and digits of ASCII, and anything beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Rows of a range of the order, which one task merges.
RANGE = 200_000
_LEAST = -(2**62)


def features(text: bytes | None, grams: int, buckets: int) -> tuple[int, np.ndarray]:
    """How many words a text in UTF-8 has, and the bucket of each run of 1 to ``grams`` words."""
    words = _WORD.findall(text.lower()) if text else []  # bytes.lower knows A-Z only
    runs = list(words)
    for n in range(2, grams + 1):
        runs += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return len(words), np.fromiter(map(zlib.crc32, runs), np.int64, len(runs)) % buckets


def _texts(batch: pa.RecordBatch) -> Iterator[bytes | None]:
    return (x.as_py() for x in batch.column("text").cast(pa.binary()))


def _count(batches: Iterator[pa.RecordBatch], grams: int, buckets: int) -> Iterator[pa.RecordBatch]:
    n = np.zeros(buckets, np.int64)
    for batch in blocks(batches):
        for text in _texts(batch):
            n += np.bincount(features(text, grams, buckets)[1], minlength=buckets)
    seen = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(n[seen], pa.int64())], ["bucket", "n"])


def bucket_counts(texts: DataFrame, grams: int, buckets: int) -> np.ndarray:
    """Features of all rows of ``text`` in each bucket; ``buckets`` numbers reach the driver."""
    counts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(lambda b: _count(b, grams, buckets), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in counts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much likelier each bucket is in the target, floored."""
    s, t, size = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((int(b) + 1) * (s + size) / ((int(a) + 1) * (t + size)))) for a, b in zip(corpus, target)], np.int64)


def noise(seed: int, doc_id: object) -> int:
    """Gumbel noise of a row in thousandths, floored: the same for an id on every machine."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(batches: Iterator[pa.RecordBatch], gain: np.ndarray, grams: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        n_words, n, weight = [], [], []
        for text in _texts(batch):
            words, bucket = features(text, grams, len(gain))
            n_words.append(words)
            n.append(len(bucket))
            weight.append(int(gain[bucket].sum()) // len(bucket) if len(bucket) else 0)
        score = [w + noise(seed, i) for w, i in zip(weight, batch.column("doc_id").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_words, n, weight, score))], ["doc_id", "n_words", "n_features", "weight", "score"])


class Tournament:
    """A tree over sorted runs: each inner node keeps the loser of its match, the top is the winner.

    Taking the winner replays only the matches from its run's leaf to the top.
    """

    def __init__(self, runs: list[Iterator[tuple]]) -> None:
        self.runs, self.size = runs, max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        winners = [*range(self.size)]
        self.losers = [0] * self.size
        nodes = [0] * self.size + winners
        for i in range(self.size - 1, 0, -1):
            a, b = nodes[2 * i], nodes[2 * i + 1]
            nodes[i], self.losers[i] = (a, b) if self._before(a, b) else (b, a)
        self.winner = nodes[1] if self.size > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x, a) <= (y, b))

    def __iter__(self) -> Iterator[tuple]:
        while (head := self.heads[self.winner]) is not None:
            yield head
            at = self.winner
            self.heads[at] = next(self.runs[at], None) if self.runs else None
            node = (at + self.size) // 2
            while node:
                if not self._before(at, self.losers[node]):
                    at, self.losers[node] = self.losers[node], at
                node //= 2
            self.winner = at


def _merge(key: tuple, table: pa.Table, draws: int) -> pa.Table:
    """``row, rank`` of a range: its slices of the runs, merged until ``draws`` rows are drawn in all."""
    start = table["start"][0].as_py()
    table = table.sort_by("place").combine_chunks()
    run = table["place"].to_numpy() >> 33
    cuts = [*np.flatnonzero(np.diff(run, prepend=-1)), len(run)]
    # rows without an id come after those with one
    heads = [-table["score"].to_numpy(), *(table[c].to_pylist() for c in ("unnamed", "doc_id")), table["row"].to_pylist()]
    none = next((type(x)() for x in heads[2] if x is not None), 0)
    heads[2] = [none if x is None else x for x in heads[2]]
    merged = Tournament([zip(*(h[a:b] for h in heads)) for a, b in zip(cuts, cuts[1:])])
    rows = [head[3] for _, head in zip(range(max(0, min(draws - start, len(run)))), merged)]
    return pa.table({"row": pa.array(rows, pa.int64()), "rank": pa.array(range(start + 1, start + 1 + len(rows)), pa.int64())})


def _drawn(eligible: DataFrame, draws: int, size: int) -> DataFrame:
    """``row, rank`` of the first ``draws`` rows of ``doc_id, score, row`` by score, largest first, then by id."""
    spark = eligible.sparkSession
    # scores are whole numbers between bounds that follow from the gains' and the noise's: few, however many the rows
    histogram = eligible.groupBy("score").agg(F.count("*").alias("n")).collect()
    cutoff, seen = _LEAST, 0
    for score, n in sorted(histogram, reverse=True):
        seen += n
        if seen >= draws:
            cutoff = score
            break
    order = [F.desc("score"), F.asc("unnamed"), F.asc("doc_id"), F.asc("row")]
    runs = eligible.where(F.col("score") >= cutoff).withColumn("unnamed", F.col("doc_id").isNull()).sortWithinPartitions(*order)
    runs = materialise(runs.withColumn("place", F.monotonically_increasing_id()), "runs")
    parts = max(seen // size + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = materialise(runs.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranges")
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # one row for each range
    starts = placed.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("start"))
    ready = placed.join(broadcast_if_small(materialise(starts.where(F.col("start") < draws), "starts")), "part")
    return ready.groupBy("part").applyInArrow(lambda key, table: _merge(key, table, draws), "row long, rank long")


def resampled(
    docs: DataFrame, target: DataFrame, grams: int = 2, buckets: int = 10_000, least: int = 20, percent: int = 10, seed: int = 2024, size: int = RANGE
) -> DataFrame:
    """Weight, score and rank of each row of ``docs`` by how likely ``target`` makes it.

    Returns ``doc_id, n_features, weight, score, rank``, all but doc_id long; ``rank`` is null
    for rows that are not drawn. Features are runs of 1 to ``grams`` words, repeats
    counted, hashed to ``buckets``. Of the N rows with at least ``least`` words,
    ``floor(percent * N / 100)`` are drawn: the highest scores, of equal ones the smaller
    doc_id first, rows without an id last, and rows that repeat an id in any order, each of
    them for itself. A text that is null or has no words has no features and weight 0. An
    empty table gives an empty result; an empty target makes all weights follow from the
    corpus alone. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    with scratch(spark, "scored", "ranks"):
        gain = gains(bucket_counts(docs, grams, buckets), bucket_counts(target, grams, buckets))
        model = spark.sparkContext.broadcast(gain)
        kind = docs.schema["doc_id"].dataType.simpleString()
        scored = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
            lambda batches: _score(batches, model.value, grams, seed), f"doc_id {kind}, n_words long, n_features long, weight long, score long"
        )
        scored = materialise(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
        eligible = scored.where(F.col("n_words") >= least).select("doc_id", "score", "row")
        draws = percent * eligible.count() // 100
        ranks = materialise(_drawn(eligible, draws, size), "ranks")
    return scored.join(ranks, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
