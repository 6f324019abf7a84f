"""Quality of documents, by boosted trees over statistics of their texts."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.blocks import blocks
from tidegrid.llm.language_id import remainder
from tidegrid.llm.trees import Trees, fit
from tidegrid.plans.shared import materialise, scratch
from tidegrid.plans.ship import ship

#: Labelled rows that the trees are fitted on, about, if there are more.
SAMPLE = 40_000
#: Characters, and words, of the pieces of a text whose extremes are statistics.
CHARS, WORDS = 256, 40
#: Kinds of characters by code point below 256; all above are of the kind "other".
_KINDS = ("upper", "lower", "digit", "blank", "stop", "quote", "mark", "bar", "symbol", "other")


@cache
def _kinds() -> np.ndarray:
    of = {c: i for i, group in ((4, ".,;:"), (5, "'\"()-?"), (6, "!"), (7, "|<>{}[]=/\\_~^`"), (8, "#$%&*@+")) for c in group}

    def kind(c: str) -> int:
        if c in of:
            return of[c]
        return 0 if c.isupper() else 1 if c.isalpha() else 2 if c.isdigit() else 3 if c.isspace() else 9

    return np.array([kind(chr(i)) for i in range(256)], np.uint8)


def statistics(text: str | None) -> np.ndarray:
    """Numbers that describe a text, the same for every copy of it; all 0 for none."""
    text = text or ""
    out = np.zeros(4 * len(_KINDS) + 18, np.float32)
    words = text.split()
    if not words:
        out[0] = np.log1p(len(text))
        return out
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = np.where(code < 256, _kinds()[np.minimum(code, 255)], 9)
    pieces = max(1, len(kind) // CHARS)
    cut = np.arange(pieces + 1) * len(kind) // pieces
    each = np.stack([np.bincount(kind[a:b], minlength=len(_KINDS)) / (b - a) for a, b in zip(cut, cut[1:])])
    shares = [each.mean(axis=0), each.min(axis=0), each.max(axis=0), each.std(axis=0)]
    # equal words have equal numbers; which ones has no effect
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    of = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    times = np.sort(np.bincount(of))[::-1]
    pairs = len(np.unique(of[:-1] * len(number) + of[1:])) if len(of) > 1 else 0
    size = np.fromiter(map(len, words), np.int64, len(words))
    many = max(1, len(of) // WORDS)
    row = np.sort(of[len(of) - len(of) // many * many :].reshape(many, -1), axis=1)
    fresh = (1 + (np.diff(row, axis=1) > 0).sum(axis=1)) / row.shape[1]
    lines = text.split("\n")
    filled = [x for x in lines if x.strip()]
    again = np.zeros(len(of), bool)
    again[1:] = of[1:] == of[:-1]
    alone = np.flatnonzero(~again)
    runs = np.diff(np.append(alone, len(of)))
    out[: 4 * len(_KINDS)] = np.concatenate(shares)
    out[4 * len(_KINDS) :] = [
        np.log1p(len(text)), np.log1p(len(words)), size.mean(), size.std(), size.max(),
        len(number) / len(words), times[0] / len(words), times[:5].sum() / len(words), pairs / len(words),
        again.mean(), runs.max(), fresh.min(), fresh.mean(),
        len(filled), len(set(filled)) / max(1, len(filled)), len(text) / max(1, len(filled)), max(map(len, lines)), (size == 1).mean(),
    ]
    return out


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        found = [statistics(t).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.binary())], ["doc_id", "held_out", "f"])


def _fitted(key: tuple, table: pa.Table) -> pa.Table:
    # rows in one order, whatever tasks they come from
    table = table.sort_by([("at", "ascending"), ("f", "ascending"), ("y", "ascending")])
    x = np.frombuffer(b"".join(table["f"].to_pylist()), np.float32).reshape(len(table), -1)
    model = fit(x, table["y"].to_numpy(), table["w"].to_numpy().astype(float))
    return pa.table({"model": pa.array([pickle.dumps((model.base, model.feature, model.limit, model.value))], pa.binary())})


def learn(labelled: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Trees from rows ``doc_id, f, y``; about ``sample`` of them by a hash if there are more; None if there are none.

    Rows of equal ids, statistics and labels are one row of that weight. The sample, of
    bounded size, is fitted in one task; what reaches the driver are the trees.
    """
    rows = labelled.groupBy("doc_id", "f", "y").agg(F.count("*").alias("w"))
    rows = materialise(rows.withColumn("at", F.xxhash64("doc_id", "f")).select("at", "f", "y", "w"), "labelled")
    n = rows.count()
    if n > sample:
        rows = rows.where(F.expr(f"(at >> 11) & {2**53 - 1}L") < int(2**53 * sample / n))
    found = rows.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(_fitted, "model binary").collect()
    return Trees(*pickle.loads(found[0]["model"])) if found else None


def _scored(batches: Iterator[pa.RecordBatch], model: Trees | None, limit: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.frombuffer(b"".join(batch.column("f").to_pylist()), np.float32).reshape(batch.num_rows, -1)
        score = model.scores(x) if model else np.full(batch.num_rows, 0.5)
        good = (score >= limit).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array(good)], ["doc_id", "held_out", "score", "predicted"])


def qualities(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5, held_out: int = 0, limit: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """Probability that each row of ``docs`` has a label of 1.

    Returns ``doc_id, held_out, score, predicted`` (1 if score >= ``limit``). Learned from
    rows of ``docs`` whose id has a label in ``labels`` and whose crc32(doc_id) modulo
    ``modulus`` is not ``held_out``; a null doc_id is neither learned from nor held out. Of an
    id with several labels the mean decides, 1 at a tie; null labels count for nothing.
    Scores follow from the text alone, so copies have one score; null and empty texts have
    the score of a text without words. Without labels every score is 0.5; an empty table
    gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    with scratch(spark, "described"):
        fold = F.coalesce(remainder(F.col("doc_id"), modulus) == held_out, F.lit(False))
        kind = docs.schema["doc_id"].dataType.simpleString()
        described = docs.select("doc_id", fold.alias("held_out"), F.col("text").cast("string").alias("text"))
        described = materialise(described.mapInArrow(_described, f"doc_id {kind}, held_out boolean, f binary"), "described")
        truth = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y"))
        model = spark.sparkContext.broadcast(learn(described.where("not held_out").join(truth, "doc_id").select("doc_id", "f", "y"), sample))
    return described.mapInArrow(lambda batches: _scored(batches, model.value, limit), f"doc_id {kind}, held_out boolean, score double, predicted int")
