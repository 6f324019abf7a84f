"""Exact duplicates through a log-structured index of text digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.words import SPACES
from tidegrid.plans.shared import broadcast_if_small, discard, materialise, new_folder, scratch

#: Runs that the tasks of one batch are dealt to; parts that a hot digest's rows are split into.
RUNS, SALTS = 4, 16
#: A filter has two to this power of bits.
FILTER = 27


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def _bit(level: DataFrame) -> DataFrame:
    place = F.xxhash64("digest").bitwiseAND(F.lit(2**FILTER - 1))
    return level.withColumn("bit", (place % 64).cast("int")).withColumn("word", F.floor(place / 64))


def _screened(level: DataFrame, filter_: DataFrame) -> DataFrame:
    """Adds ``known``: whether another level's filter has a digest's bit."""
    met = _bit(level).join(F.broadcast(filter_), "word", "left")
    return met.withColumn("known", F.coalesce(F.expr("getbit(bits, bit) = 1"), F.lit(False))).drop("word", "bit", "bits")


class DigestIndex:
    """Sorted runs of ``digest, rest, doc_id, text_hash, row`` in a folder, and the level they compact into.

    A memtable is what one task holds of a batch: it is sorted by digest and flushed as
    one file of a run, whose column statistics and Bloom filter tell a reader which
    digests it can hold. :meth:`compact` merges runs and levels two by two and keeps for
    each digest the row with the smallest identifier. Each side is held against a filter
    of the other's digests, of fixed size: those it lets through go to a sort-merge join,
    the rest, on most corpora nearly all, need no exchange. :meth:`lookup` reads a few
    digests through statistics and filters.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, digest_chars: int = 64) -> None:
        self.spark, self.chars = spark, digest_chars
        self.folder = folder or new_folder(spark, "digests")
        self.runs: list[str] = []

    def digest(self, text: Column) -> Column:
        return F.unhex(F.substring(F.sha2(normalised(text), 256), 1, self.chars))

    def _write(self, rows: DataFrame, name: str, *parts: str) -> str:
        writer = rows.sortWithinPartitions(*parts, "digest").write.option("parquet.bloom.filter.enabled#digest", "true")
        writer = writer.option("parquet.bloom.filter.expected.ndv#digest", "1000000").option("parquet.bloom.filter.adaptive.enabled", "true")
        (writer.partitionBy(*parts) if parts else writer).parquet(f"{self.folder}/{name}")
        return f"{self.folder}/{name}"

    def flush(self, docs: DataFrame, runs: int = RUNS) -> None:
        """Add a batch of documents: each task's rows are a memtable of one of ``runs`` runs."""
        sha = F.sha2(normalised(F.col("text")), 256)
        rows = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("text_hash"), sha.alias("sha"), F.monotonically_increasing_id().alias("row"))
        cut = [F.unhex(F.substring("sha", 1, self.chars)).alias("digest"), F.unhex(F.substring("sha", self.chars + 1, 64)).alias("rest")]
        rows = rows.select("doc_id", "text_hash", *cut, "row", F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"))
        batch = self._write(rows, f"batch-{len(self.runs):05d}", "run")
        kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "run")
        fs = self.spark._jvm.org.apache.hadoop.fs.Path(batch).getFileSystem(self.spark._jsc.hadoopConfiguration())
        paths = (f"{batch}/run={i}" for i in range(runs))
        self.runs += [(path, kind) for path in paths if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(path))]
        self.kind = kind

    def rows(self) -> DataFrame:
        """All flushed rows: ``doc_id, text_hash, digest, rest, row, run``."""
        out = self.spark.createDataFrame([], f"{self.kind}, run int")
        for i, (path, kind) in enumerate(self.runs):
            out = out.unionByName(self.spark.read.schema(kind).parquet(path).withColumn("run", F.lit(i)))
        return out

    def compact(self) -> DataFrame:
        """Merge the runs: ``digest, first, n`` where first is the row of the smallest doc_id."""
        least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "run", "row")).alias("first")
        levels = [
            self.spark.read.schema(kind).parquet(path).withColumn("run", F.lit(i)).groupBy("digest").agg(least, F.count("*").alias("n"))
            for i, (path, kind) in enumerate(self.runs)
        ] or [self.rows().groupBy("digest").agg(least, F.count("*").alias("n"))]
        levels, tier = [self._level(x, f"level-0-{i}") for i, x in enumerate(levels)], 0
        while len(levels) > 1:
            tier += 1
            pairs = [*zip(levels[::2], levels[1::2])]
            merged = [self._level(self._merge(*pair), f"level-{tier}-{i}") for i, pair in enumerate(pairs)]
            for old in levels[: 2 * len(pairs)]:
                discard(old)
            levels = merged + levels[2 * len(pairs) :]
        return levels[0]

    def _level(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` stored, each file sorted by digest."""
        path = f"{self.folder}/{name}"
        rows.sortWithinPartitions("digest").write.parquet(path)
        out = self.spark.read.schema(rows.schema).parquet(path)
        out._tidegrid_path = path
        return out

    def _filter(self, level: DataFrame) -> DataFrame:
        """Which of 2**FILTER bits the digests of a level set, as words of 64: at most ``2**(FILTER - 6)`` rows, however many digests there are."""
        return materialise(_bit(level).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")), "filter")

    def _merge(self, a: DataFrame, b: DataFrame) -> DataFrame:
        """Two runs or levels as one: only digests that the other's filter lets through are moved and merged, all others stay where they are."""
        both = [_screened(x, self._filter(y)) for x, y in ((a, b), (b, a))]
        kept = [x.where("not known").drop("known") for x in both]
        left, right = (x.where("known").drop("known") for x in both)
        met = left.hint("merge").join(right.toDF("digest", "first_b", "n_b"), "digest", "full_outer")
        none = lambda c: F.coalesce(c, F.lit(0))
        met = met.select("digest", F.least("first", "first_b").alias("first"), (none("n") + none("n_b")).alias("n"))
        return kept[0].unionByName(kept[1]).unionByName(met)

    def lookup(self, rows: DataFrame, wanted: DataFrame, batch: int = 1000) -> DataFrame:
        """Of rows those of the ``wanted`` digests; up to ``batch`` are read through the filters."""
        wanted = wanted.select("digest").distinct()
        first = [bytes(r[0]) for r in wanted.limit(batch + 1).collect()]
        if len(first) <= batch:
            return rows.where(F.col("digest").isin(first)) if first else rows.limit(0)
        return rows.join(wanted, "digest", "left_semi")


def exact_duplicates(docs: DataFrame, digest_chars: int = 64) -> DataFrame:
    """For each row of ``docs``, which row of equal text stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256`` and ``text_hash``
    (``xxhash64`` of the text as it is, to find the row again). Texts are equal
    when their bytes are after white space is normalised; null counts as empty.
    Of equal texts the smallest doc_id stays; of rows that repeat an id and a
    text exactly one is kept. Rows without an id lose to rows with one; among
    themselves one is kept, with a null keep_id. An empty table gives an empty
    result; other columns are not read. ``digest_chars`` shortens the index's
    digests (for tests of their collisions).

    Digests held by several rows are hits. The bytes of all hits are compared by
    grouping on the text itself, which collapses copies before they are
    shuffled; a digest found to hold different texts is looked up in the runs and
    resolved text by text. Only hits are joined to rows, salted, so that the copies
    of one text are spread over tasks.
    """
    with scratch(docs.sparkSession, "digests", "digest_hits", "clash_rows", "clashing", "clashes"):
        return _exact_duplicates(docs, digest_chars)


def _exact_duplicates(docs: DataFrame, digest_chars: int) -> DataFrame:
    index = DigestIndex(docs.sparkSession, digest_chars=digest_chars)
    index.flush(docs)
    level = index.compact()
    hits = materialise(level.where("n > 1"), "digest_hits")
    discard(level)
    text = docs.select("doc_id", normalised(F.col("text")).alias("norm"), F.col("text").cast("string").alias("text"), index.digest(F.col("text")).alias("digest"))
    read = text.join(broadcast_if_small(hits.select("digest")), "digest", "left_semi")
    classes = read.groupBy("digest", "norm").agg(F.lit(1).alias("one"))
    clashes = materialise(classes.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select("digest"), "clashes")
    clashing = not clashes.isEmpty()

    if clashing:
        hits = materialise(hits.join(clashes, "digest", "left_anti"), "digest_hits")
    small = broadcast_if_small(hits)
    rows = index.rows().withColumn("salt", F.pmod("row", F.lit(SALTS)))
    if small is hits:
        small = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.join(small, ["digest", "salt"], "left")
    else:
        rows = rows.join(small, "digest", "left")
    found = rows.select("doc_id", "text_hash", F.lower(F.hex(F.concat("digest", "rest"))).alias("sha"), "run", "row", "first", F.coalesce("n", F.lit(1).cast("long")).alias("n"))
    if clashing:
        # single rows of a clashing digest's texts have no hit of their own
        lost = index.lookup(index.rows(), clashes).select("run", "row")
        found = found.join(broadcast_if_small(materialise(lost, "clash_rows")), ["run", "row"], "left_anti")
        split = read.join(clashes, "digest", "left_semi")
        split = split.select("doc_id", F.xxhash64("text").alias("text_hash"), "norm", F.sha2("norm", 256).alias("sha"), F.lit(-1).alias("run"), F.monotonically_increasing_id().alias("row"))
        split = materialise(split, "clashing")
        least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "run", "row")).alias("first")
        split = split.join(split.groupBy("norm").agg(least, F.count("*").alias("n")), "norm")
        found = found.unionByName(split.drop("norm"))
    alone = F.col("first").isNull()
    kept = alone | ((F.col("run") == F.col("first.run")) & (F.col("row") == F.col("first.row")))
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return found.select("doc_id", keep_id.alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256"), "text_hash")
