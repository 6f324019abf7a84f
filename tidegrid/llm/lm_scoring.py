"""Document scores of a gated recurrent language model trained over all documents."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import gru
from tidegrid.llm.blocks import blocks
from tidegrid.llm.language_id import remainder
from tidegrid.plans.shared import materialise
from tidegrid.plans.ship import ship

#: Words whose counts every task knows, and their bytes at most; counts of all others are joined.
TABLE, WORD_BYTES = 262_144, 64
#: Shares of the training documents for each round, with its learning rate; weights
#: are averaged over all tasks after a round.
ROUNDS = ((1, 0.1), (4, 0.1), (11, 0.05))
#: Tokens that one replica of the network learns from in a round, and replicas at most.
REPLICA, REPLICAS = 1_000_000, 4096
#: The end of a text counts as a token; no word is empty.
END = b""


def tokens(text: bytes | None) -> list[bytes]:
    # bytes.lower and bytes.split know ASCII only: A-Z, and the six white-space bytes
    return [*text.lower().split(), END] if text else [END]


def rare_class(word: bytes) -> int:
    """The class of a word beyond the vocabulary, from its ending."""
    return zlib.crc32(word[-3:]) % gru.RARE


def _count(batches: Iterator[pa.RecordBatch], most: int = 400_000) -> Iterator[pa.RecordBatch]:
    found: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        words = list(found)
        arrays = [pa.array(words, pa.binary()), pa.array(map(rare_class, words), pa.int32()), pa.array(found.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["word", "kind", "n"])

    for batch in blocks(batches):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        found.update(b"\n".join(x for x in texts if x).lower().split())
        found[END] += len(texts)
        if len(found) > most:
            yield out()
            found.clear()
    yield out()


def _encode(batches: Iterator[pa.RecordBatch], table: tuple[list[bytes], np.ndarray]) -> Iterator[pa.RecordBatch]:
    words, counts = table
    known = {w: i for i, w in enumerate(words)}
    kinds = np.array([rare_class(w) for w in words], np.int64)
    log1 = np.log10(counts + 1.0)
    for batch in blocks(batches):
        ids, n, n_known, base, rare, ends, tail_words, tail_counts = [], [], [], [], [], [0], [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            listed = tokens(text)
            at = np.fromiter(map(known.get, listed, repeat(-1)), np.int64, len(listed))
            out = np.flatnonzero(at < 0)
            tail = Counter(listed[i] for i in out)
            mid = at >= gru.VOCABULARY
            code = np.where(mid, gru.VOCABULARY + kinds[np.minimum(at, len(words) - 1)] if len(words) else 0, at)
            code[out] = [gru.VOCABULARY + rare_class(listed[i]) for i in out]
            ids.append(code.astype("<u2").tobytes())
            n.append(len(listed))
            n_known.append(len(listed) - len(out))
            base.append(float(log1[at[at >= 0]].sum()))
            rare.append(float(log1[at[mid]].sum()))
            tail_words += tail.keys()
            tail_counts += tail.values()
            ends.append(len(tail_words))
        tails = pa.StructArray.from_arrays([pa.array(tail_words, pa.binary()), pa.array(tail_counts, pa.int64())], ["word", "n"])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "held_out", "learned", "share", "deal")), pa.array(ids, pa.binary()), pa.array(n, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(rare, pa.float64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tails)],
            ["doc_id", "held_out", "learned", "share", "deal", "ids", "n_tokens", "n_known", "base", "rare", "tail"],
        )


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for x in batch.column("ids"):
            yield np.frombuffer(x.as_buffer(), "<u2").astype(np.int64)


def _train(batches: Iterator[pa.RecordBatch], flat: np.ndarray, end: int, lr: float, block: int = 8192) -> Iterator[pa.RecordBatch]:
    flat, n = gru.train(flat, _ids(batches), end, lr)
    if n:
        parts = [(flat[i : i + block] * np.float32(n)).tobytes() for i in range(0, gru.SIZE, block)]
        arrays = [pa.array(range(len(parts)), pa.int32()), pa.array([n] * len(parts), pa.int64()), pa.array(parts, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["block", "n", "sums"])


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(len(rows["sums"].iat[0]) // 4)
    for x in rows["sums"]:
        total += np.frombuffer(x, np.float32)
    return pd.DataFrame({"block": rows["block"].iloc[:1], "n": [rows["n"].sum()], "sums": [total.astype(np.float32).tobytes()]})


def _averaged(trained: DataFrame, current: np.ndarray) -> np.ndarray:
    """Mean of all tasks' weights by the tokens they saw, added up block by block in two steps."""
    kind = "block int, n long, sums binary"
    salted = trained.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    some = salted.groupBy("block", "salt").applyInPandas(_add, kind)
    rows = some.groupBy("block").applyInPandas(_add, kind).orderBy("block").collect()
    if not rows:
        return current
    return np.concatenate([np.frombuffer(r["sums"], np.float32) / np.float32(r["n"]) for r in rows])


def _score(batches: Iterator[pa.RecordBatch], flat: np.ndarray, end: int, logs: np.ndarray) -> Iterator[pa.RecordBatch]:
    p = gru.views(flat)
    for batch in batches:
        texts = list(_ids(iter([batch])))
        natural = gru.score(p, texts, end) if texts else np.zeros(0)
        # words beyond the vocabulary: (count + 1) over the size of their class
        spread = np.array([logs[t[t >= gru.VOCABULARY] - gru.VOCABULARY].sum() for t in texts])
        value = natural / np.log(10) - spread + batch.column("rare").to_numpy()
        keep = [c for c in batch.schema.names if c not in ("ids", "rare")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(value, pa.float64())], [*keep, "value"])


def scores(docs: DataFrame, modulus: int = 7, held_out: int = 2) -> DataFrame:
    """Log10 probability of each whole text under the trained model and a unigram base.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    for every row of ``docs``. Rows whose crc32(doc_id) modulo ``modulus`` is
    ``held_out`` are not learned from, nor are rows without an id (which are not
    held out). Null and empty texts consist of the end token. Repeated rows count,
    are learned from and are scored each. An empty table gives an empty result;
    without any row to learn from, every word is unknown. Other columns of
    ``docs`` are not read.

    Counts are taken over all training documents. The network reads the 3072 most
    frequent words (in 48 classes) and 16 classes of other words by their endings;
    a word of these has the add-one probability within its class, where one more
    word stands for all unknown ones. Every training document is passed once, in
    three rounds; documents are dealt by a hash to replicas of ``REPLICA`` tokens, each
    of which trains on its own, and the weights are averaged after each round. So a
    score follows from the rows, not from how they are cut into partitions.
    """
    spark = docs.sparkSession
    ship(spark)
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    named = F.col("doc_id").isNotNull()
    slim = docs.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), modulus) == held_out, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    ).withColumn("learned", named & ~F.col("held_out"))
    counts = slim.where("learned").select("text").mapInArrow(_count, "word binary, kind int, n long")
    counts = materialise(counts.groupBy("word", "kind").agg(F.sum("n").alias("n")), "counts")
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()

    # the words of the table: as many whole steps of a logarithmic histogram as fit
    step = F.floor(F.log2("n") * 16).cast("int")
    handy = counts.where(F.octet_length("word") <= WORD_BYTES)
    fits, least = 0, 1 << 30
    for r in handy.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        fits += r["count"]
        if fits > TABLE:
            break
        least = r["step"]
    top = handy.where(step >= least).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    words, seen = [bytes(w) for w in top["word"].to_pylist()], top["n"].to_numpy()
    if END in words:  # the end of a text is always in the vocabulary, at 0
        i = words.index(END)
        words.insert(0, words.pop(i))
        seen = np.concatenate([seen[i : i + 1], np.delete(seen, i)])
    else:
        n = counts.where(F.col("word") == F.lit(END)).select("n").first()
        words, seen = [END, *words], np.append(n["n"] if n else 0, seen)
    table = spark.sparkContext.broadcast((words, seen))
    end = 0

    size, mass = np.zeros(gru.RARE), np.zeros(gru.RARE)
    for r in counts.groupBy("kind").agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect():
        size[r["kind"]], mass[r["kind"]] = r["v"], r["n"]
    for w, c in zip(words[: gru.VOCABULARY], seen[: gru.VOCABULARY]):
        size[rare_class(w)] -= c > 0
        mass[rare_class(w)] -= c
    logs = np.log10(mass + size + 1)

    deal = F.xxhash64("doc_id", "text")
    share = F.pmod(deal, F.lit(sum(n for n, _ in ROUNDS)))
    encoded = slim.select("doc_id", "held_out", "learned", share.cast("int").alias("share"), deal.alias("deal"), "text").mapInArrow(
        lambda batches: _encode(batches, table.value),
        f"doc_id {id_kind}, held_out boolean, learned boolean, share int, deal long, ids binary, n_tokens long, n_known long, base double, rare double, tail array<struct<word:binary,n:long>>",
    )
    encoded = materialise(encoded.withColumn("row", F.monotonically_increasing_id()), "encoded")

    flat, start = gru.initial(seen[: gru.VOCABULARY], mass), 0
    for n, lr in ROUNDS:
        part = encoded.where(f"learned and share >= {start} and share < {start + n}").select("doc_id", "deal", "ids")
        # replicas follow from the number of tokens and not from how the table is cut
        replicas = max(1, min(REPLICAS, math.ceil(whole[0] * n / sum(n for n, _ in ROUNDS) / REPLICA)))
        part = part.repartition(replicas, "deal").sortWithinPartitions("doc_id", "deal").select("ids")
        held, start = spark.sparkContext.broadcast(flat), start + n
        trained = part.mapInArrow(lambda b, held=held, lr=lr: _train(b, held.value, end, lr), "block int, n long, sums binary")
        flat = _averaged(trained, flat)
    model = spark.sparkContext.broadcast(flat)
    scored = encoded.select("doc_id", "held_out", "row", "ids", "rare", "n_tokens", "n_known", "base").mapInArrow(
        lambda b: _score(b, model.value, end, logs), f"doc_id {id_kind}, held_out boolean, row long, n_tokens long, n_known long, base double, value double"
    )

    tail = encoded.select("row", F.explode("tail").alias("t")).select("row", "t.word", F.col("t.n").alias("times"))
    tail = tail.join(counts.select("word", "n"), "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("more"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times") * F.log10(F.col("n") + 1))).alias("log1"),
    )
    none = lambda c: F.coalesce(c, F.lit(0))
    total = float(np.log10(whole[0] + whole[1] + 1))
    return scored.join(tail, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + none(F.col("more"))).alias("n_known") if whole[0] else F.lit(0).cast("long").alias("n_known"),
        F.lit(whole[0]).cast("long").alias("train_tokens"),
        (F.col("base") + none(F.col("log1")) - F.col("n_tokens") * total).alias("base_score"),
        (F.col("value") + none(F.col("log1"))).alias("score"),
    )
