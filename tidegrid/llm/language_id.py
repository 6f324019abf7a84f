"""Languages of a text as a mixture, by expectation-maximisation over its words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.blocks import blocks
from tidegrid.plans.ship import ship

#: Trigrams are hashed to so many bits; counts are smoothed by ALPHA; at most so many rounds.
BITS, ALPHA, ROUNDS = 16, 0.05, 12
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of a key as text, modulo ``modulus``."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(modulus))


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)], bool)


def _trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigrams of the words of all texts; where words start; each word's text."""
    # white space and other signs separate words; a text ends with one
    joined = " " + "".join(f"{t} " for t in (x.lower() if x else "" for x in texts))
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([1, *(len(x.lower()) + 1 if x else 1 for x in texts)])
    letter = _letters()[code]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one sign after each word
    keep[0] = True
    place = np.flatnonzero(keep)
    code, letter = np.where(letter[place], code[place], 32).astype(np.uint32), letter[place]
    if len(code) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    gram = code[:-2] * _MIX[0] + code[1:-1] * _MIX[1] + code[2:] * _MIX[2]
    gram = (gram ^ (gram >> np.uint32(15))) * _MIX[1] >> np.uint32(32 - BITS)
    inner = letter[1:-1]  # a trigram belongs to the word of its middle letter
    first = inner & ~letter[:-2]
    starts = np.flatnonzero(first[inner])
    text = np.searchsorted(ends, place[1:-1][first], side="right") - 1
    return gram[inner].astype(np.int64), starts, text


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in blocks(batches):
        texts = batch.column("text").to_pylist()
        langs = batch.column("lang").to_pylist()
        for lang in set(langs):
            gram, _, _ = _trigrams([t for t, x in zip(texts, langs) if x == lang])
            if lang not in counts:
                counts[lang] = np.zeros(1 << BITS, np.int64)
            counts[lang] += np.bincount(gram, minlength=1 << BITS)
    for lang, n in counts.items():
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(n[seen], pa.int64())], ["lang", "gram", "n"])


def _table(rows: pd.DataFrame) -> pd.DataFrame:
    n = np.full(1 << BITS, ALPHA)
    n[rows["gram"]] += rows["n"]
    return pd.DataFrame({"lang": rows["lang"].iloc[:1], "logs": [np.log(n / n.sum()).astype(np.float32).tobytes()]})


def learn(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities of hashed trigrams, from all rows ``text, lang``.

    What reaches the driver is one table of 2**BITS numbers for each language.
    """
    counts = labelled.where("lang is not null and text is not null").mapInArrow(_count, "lang string, gram int, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counts.groupBy("lang").applyInPandas(_table, "lang string, logs binary").orderBy("lang").collect()
    logs = np.array([np.frombuffer(r["logs"], np.float32) for r in found], np.float32).reshape(len(found), 1 << BITS)
    return [r["lang"] for r in found], np.ascontiguousarray(logs.T)


def _mix(like: np.ndarray, top: np.ndarray, starts: np.ndarray, of: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of texts over allowed languages (texts x languages)."""
    pi = allowed / allowed.sum(axis=1, keepdims=True)
    n = np.diff(np.append(starts, len(of)))[:, None]
    for _ in range(ROUNDS):
        part = like * pi[of]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-300)
        new = np.add.reduceat(part, starts, axis=0) / n
        moved = np.abs(new - pi).max()
        pi = new
        if moved < 1e-3:
            break
    each = np.log(np.maximum((like * pi[of]).sum(axis=1), 1e-300)) + top
    return pi, np.add.reduceat(each, starts)


def mixtures(gram: np.ndarray, starts: np.ndarray, text: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts that have words; their proportions over all languages and over the selected set.

    Sets are nested: the k languages of largest proportion. The set of the largest
    log-likelihood less ``(k - 1) / 2 * log(words)`` is selected. Only texts whose
    full mixture gains more than one penalty over their first language try others.
    """
    word = np.add.reduceat(logs[gram], starts, axis=0, dtype=np.float64)
    top = word.max(axis=1)
    like = np.exp(word - top[:, None])
    first = np.flatnonzero(np.diff(text, prepend=-1))
    of = np.cumsum(np.diff(text, prepend=-1) > 0) - 1
    langs = logs.shape[1]
    pi, full = _mix(like, top, first, of, np.ones((len(first), langs)))
    chosen = np.zeros_like(pi)
    best_at = pi.argmax(axis=1)
    chosen[np.arange(len(pi)), best_at] = 1
    best = np.add.reduceat(word[np.arange(len(word)), best_at[of]], first)
    penalty = 0.5 * np.log(np.maximum(np.diff(np.append(first, len(of))), 2))
    open_ = np.flatnonzero(full - penalty > best)
    if len(open_):
        mine = np.isin(of, open_)
        sub_of = np.searchsorted(open_, of[mine])
        sub_first = np.flatnonzero(np.diff(sub_of, prepend=-1))
        order = np.argsort(np.argsort(-pi[open_], axis=1, kind="stable"), axis=1, kind="stable")
        for k in range(2, langs + 1):
            p, value = _mix(like[mine], top[mine], sub_first, sub_of, (order < k).astype(float))
            better = value - (k - 1) * penalty[open_] > best[open_]
            chosen[open_[better]] = p[better]
            best[open_[better]] = (value - (k - 1) * penalty[open_])[better]
    return text[first], pi, chosen


def _predict(batches: Iterator[pa.RecordBatch], langs: list[str], logs: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        rows = batch.num_rows
        pred, score, shown = ["und"] * rows, np.zeros(rows), [""] * rows
        gram, starts, text = _trigrams(batch.column("text").to_pylist()) if langs else ([], [], [])
        if len(starts):
            at, pi, chosen = mixtures(gram, starts, text, logs)
            first = chosen.argmax(axis=1)
            for i, k, p, c in zip(at, first, pi, chosen):
                pred[i], score[i] = langs[k], min(1.0, max(0.0, p[k]))
                shown[i] = ",".join(f"{langs[j]}:{c[j]:.2f}" for j in np.argsort(-c, kind="stable") if c[j] > 0)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "held_out")), pa.array(pred, pa.string()), pa.array(score), pa.array(shown, pa.string()), batch.column("text_hash")], ["doc_id", "held_out", "lang_pred", "score", "languages", "text_hash"])


def languages(docs: DataFrame, modulus: int = 3, held_out: int = 1) -> DataFrame:
    """Predicted language of every row of ``docs``, and the mixture it comes from.

    Returns ``doc_id, held_out, lang_pred, score, languages, text_hash`` (``xxhash64``
    of the text, to find the row again). Rows with a non-null
    ``lang`` whose crc32(doc_id) modulo ``modulus`` is not ``held_out`` are learned
    from; a null doc_id is neither learned from nor held out. Words are runs of
    letters in lower case; a word's likelihood in a language is that of its
    trigrams. ``score`` is the predicted language's share of the whole mixture,
    ``languages`` the selected set with its shares. A text without letters, or
    null, is ``und`` with score 0 and no languages, as is every text if no row can
    be learned from. Repeated rows get equal results; an empty table gives an empty
    result; other columns are not read. Ties go to the first language by name.
    """
    ship(docs.sparkSession)
    fold = remainder(F.col("doc_id"), modulus)
    slim = docs.select("doc_id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"), "lang")
    langs, logs = learn(slim.where(~F.col("held_out") & F.col("doc_id").isNotNull()).select("text", "lang"))
    model = docs.sparkSession.sparkContext.broadcast((langs, logs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return slim.select("doc_id", "held_out", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        lambda batches: _predict(batches, *model.value), f"doc_id {kind}, held_out boolean, lang_pred string, score double, languages string, text_hash long"
    )
