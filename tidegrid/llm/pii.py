"""Keyed surrogates for personal data, distinct over the whole corpus."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.blocks import blocks
from tidegrid.llm.surrogates import LAST, mentions, splice, surrogate
from tidegrid.plans.shared import broadcast_if_small, materialise, scratch
from tidegrid.plans.ship import ship


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        rows, start, stop, kind, value = [], [], [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            for a, b, k, v in mentions(text) if text else ():
                rows.append(i)
                start.append(a)
                stop.append(b)
                kind.append(k)
                value.append(v)
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(at), batch.column("h").take(at), pa.array(start, pa.int32()), pa.array(stop, pa.int32()), pa.array(kind, pa.string()), pa.array(value, pa.string())],
            ["doc_id", "h", "start", "stop", "kind", "value"],
        )


def _draw(batches: Iterator[pa.RecordBatch], key: bytes, attempt: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [surrogate(key, k, v, attempt) for k, v in zip(batch.column("kind").to_pylist(), batch.column("value").to_pylist())]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("type", "kind", "value")), pa.array(made, pa.string())], ["type", "kind", "value", "surrogate"])


def _replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        texts, counts = [], []
        for text, edits in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist()):
            texts.append(splice(text, ((e["start"], e["stop"], e["kind"], e["surrogate"]) for e in edits)) if edits else text)
            counts.append(len(edits or ()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "n_entities", "text"])


def assigned(entities: DataFrame, key: bytes) -> DataFrame:
    """``type, value, surrogate``: an injective choice of surrogates for ``type, kind, value``.

    In each round every open entity draws one; the first by value takes it unless
    it was taken before or is itself an entity of the corpus. The others draw anew,
    from larger spaces; it is an error if the space of a format is used up.
    """
    entities = materialise(entities, "entities")
    settled, pending, attempt = None, entities, 0
    while True:
        drawn = pending.mapInArrow(lambda b, n=attempt: _draw(b, key, n), "type string, kind string, value string, surrogate string")
        drawn = materialise(drawn, "drawn")
        taken = entities.select("type", F.col("value").alias("surrogate"))
        if settled is not None:
            taken = taken.unionByName(settled.select("type", "surrogate"))
        first = drawn.groupBy("type", "surrogate").agg(F.min("value").alias("value")).join(taken, ["type", "surrogate"], "left_anti")
        won = materialise(first.select("type", "value", "surrogate"), "settled")
        settled = won if settled is None else settled.unionByName(won)
        pending = materialise(pending.join(won, ["type", "value"], "left_anti"), "open")
        if pending.isEmpty():
            return settled
        attempt += 1
        if attempt > LAST:
            raise ValueError(f"no surrogate is left for {[tuple(r) for r in pending.select('type').distinct().collect()]}")


def pseudonymised(docs: DataFrame, key: bytes = b"tidegrid") -> DataFrame:
    """Texts with surrogates in place of personal data.

    Returns ``doc_id, n_entities, text`` for every row of ``docs``. Entities are
    e-mail addresses, telephone and card numbers, social-security numbers, IBANs, IPv4 and
    IPv6 addresses, names that follow a title or begin with a known given name,
    and bare surnames of names found in the same text. One entity has one surrogate
    in all documents, no two entities of a type share one, and none is itself an
    entity of the corpus. Surrogates depend on ``key`` and on the corpus's entities
    only; they keep separators, case, length of numbers, check digits, script and
    gender. Given names come from the list that detects them while some of it does
    not occur in the corpus, and are made of syllables otherwise. Null stays null and empty stays
    empty; repeated rows get equal results; an empty table gives an empty result;
    other columns are not read.
    """
    with scratch(docs.sparkSession, "edits"):
        return _pseudonymised(docs, key)


def _pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    ship(docs.sparkSession)
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    found = slim.select("doc_id", "h", "text").mapInArrow(_detect, f"doc_id {id_kind}, h long, start int, stop int, kind string, value string")
    found = materialise(found.withColumn("type", F.split("kind", " ")[0]), "mentions")
    # of a name seen with several genders the first by name decides
    entities = found.groupBy("type", "value").agg(F.min("kind").alias("kind")).select("type", "kind", "value")
    chosen = broadcast_if_small(assigned(entities, key))
    edit = F.struct("start", "stop", "kind", "surrogate")
    edits = found.dropDuplicates(["doc_id", "h", "start"]).join(chosen, ["type", "value"])
    edits = edits.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(edit)).alias("edits"))
    edits = broadcast_if_small(materialise(edits, "edits").toDF("d", "g", "edits"))
    return (
        slim.join(edits, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left")
        .select("doc_id", "text", "edits")
        .mapInArrow(_replace, f"doc_id {id_kind}, n_entities long, text string")
    )
