"""Intermediate tables in the folder that driver and executors share.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` and reading it
back, so a lost executor costs a re-read and never a recomputation of the loop.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

#: A side may be broadcast up to this many rows and this many bytes of them as text.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64_000_000
#: A screen has this many bits for each key, and two to the power of SCREEN (8 MB) at most.
SCREEN_BITS, SCREEN = 64, 26
#: Paths written since each open scope began, the innermost last.
_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; of one machine's own only where Spark runs on that machine alone."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    own = spark.conf.get("spark.tidegrid.shared.dir", None)
    if not own:
        own = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.tidegrid.shared.dir", own)
    return own


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def materialise(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the table read back."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidegrid_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`materialise` that nothing reads any more."""
    path = getattr(df, "_tidegrid_path", None)
    if path:
        _delete(df.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession, *kept: str) -> Iterator[None]:
    """Deletes, at its end, all folders that were begun inside, but for those of the names ``kept``.

    What leaves the block has to read tables of these names only.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            if re.fullmatch(r"(.*)-[0-9a-f]{32}", path.rpartition("/")[2])[1] not in kept:
                _delete(spark, path)
            elif _scopes:
                _scopes[-1].append(path)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast after measuring ``df``; beyond ``rows`` or ``BROADCAST_BYTES`` leave the choice to Spark."""
    wide = any(isinstance(f.dataType, (ArrayType, BinaryType, MapType, StringType, StructType)) for f in df.schema)
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long")) if wide else F.count("*") * 8 * len(df.columns)
    n, held = df.agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    return F.broadcast(df) if n <= rows and held <= BROADCAST_BYTES else df


def screened(df: DataFrame, held: DataFrame, *keys: str, inside: bool = True, power: int | None = None) -> DataFrame:
    """The rows of ``df`` whose ``keys`` can be among those of ``held``: all that are, and few others; not ``inside``: the rest.

    What is broadcast is a field of bits, 64 for each key of ``held`` and ``2**SCREEN`` at most, so
    neither the driver nor an executor holds the keys themselves. Others pass with a chance of the
    share of bits that are set; an exact join has to follow where they matter.
    """
    power = power or min(SCREEN, max(15, (SCREEN_BITS * held.count() - 1).bit_length()))
    place = F.xxhash64(*keys).bitwiseAND(F.lit(2**power - 1))
    word, bit = F.shiftright(place, 6), (place % 64).cast("int")
    none = df.sparkSession.range(2 ** (power - 6)).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = held.select(word.alias("word"), bit.alias("bit")).select("word", F.expr("shiftleft(1L, bit)").alias("bits"))
    words = words.unionByName(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # 512 words a row: few rows for the driver to build a table of
    field = words.groupBy(F.shiftright("word", 9).alias("__part")).agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("w"))
    field = materialise(field.select("__part", F.col("w.bits").alias("__bits")), "screen")
    at = [F.shiftright(place, 15).alias("__at"), word.bitwiseAND(F.lit(511)).cast("int").alias("__word"), bit.alias("__bit")]
    met = df.select("*", *at).join(F.broadcast(field), F.col("__at") == F.col("__part"))
    return met.where(f"getbit(__bits[__word], __bit) = {int(inside)}").select(df.columns)


def without(df: DataFrame, gone: DataFrame, key: str, rows: int = 50_000) -> DataFrame:
    """``df`` without the rows whose ``key`` is in ``gone``; neither ``gone`` nor ``df`` is moved, however many keys there are.

    Beyond ``rows`` keys are screened, and those that pass though they are not in ``gone`` are sought again.
    """
    small = broadcast_if_small(gone, rows)
    if small is not gone:
        return df.join(small, key, "left_anti").select(df.columns)
    spared = screened(df.select(key), gone, key).join(gone, key, "left_anti").distinct()
    spared = broadcast_if_small(materialise(spared.select(F.col(key).alias("__key")), "spared"))
    again = df.join(spared, F.col(key).eqNullSafe(F.col("__key")), "left_semi")
    return screened(df, gone, key, inside=False).unionByName(again)


def tidy(spark: SparkSession) -> None:
    """Have the driver collect its garbage: until then Spark keeps what finished steps have broadcast and shuffled, and the driver's heap grows to its limit with plans that have run."""
    spark.sparkContext._jvm.System.gc()
