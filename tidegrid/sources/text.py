"""Text formats of model grids: number blocks, metadata, zone rings and polygon flags."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.plans.shared import broadcast_if_small, materialise
from tidegrid.plans.ship import ship
from tidegrid.sources.ordered import write_ordered

#: Comment lines of a metadata file before its grid type.
HEADER_LINES = 45


def scaled(value: Column, scale: int) -> Column:
    """K5: whole numbers for export, halves away from zero."""
    return F.round(value * scale).cast("long")


def lines(grid: DataFrame, value: str, block: int = 0) -> DataFrame:
    """K1: ``block, k, line``: each row of the grid, south first, every value between blanks."""
    row = F.array_sort(F.collect_list(F.struct("j", F.col(value).cast("long").alias("v"))))
    return grid.groupBy("k").agg(row.alias("r")).select(F.lit(block).alias("block"), "k", F.array_join(F.transform("r", lambda x: F.concat(F.lit(" "), x["v"].cast("string"), F.lit(" "))), "").alias("line"))


def obstruction_lines(grid: DataFrame, sx: str = "sx", sy: str = "sy") -> DataFrame:
    """K2: the block of ``sx``, a blank line, the block of ``sy``."""
    gap = grid.agg(F.max("k").alias("k")).select(F.lit(0).alias("block"), (F.col("k") + 1).cast("int").alias("k"), F.lit("").alias("line"))
    return lines(grid, sx, 0).unionByName(gap).unionByName(lines(grid, sy, 1))


def write_lines(rows: DataFrame, path: str) -> None:
    """Write ``block, k, line`` in order as one file.

    Rows are dealt out by ranges; the bytes of the ranges before, one row for each, and of
    the lines before give each line its place, and tasks write them side by side.
    """
    order = ["block", "k"]
    size = F.octet_length("line") + 1
    before = F.sum(size).over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.select(*order, "line").repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    placed = materialise(placed.withColumn("at", F.coalesce(before, F.lit(0))), "lines")
    starts = _before(placed.groupBy("part").agg(F.sum(size).alias("n")), "part")
    ready = placed.join(starts, "part").select((F.col("start") + F.col("at")).alias("offset"), F.encode(F.concat("line", F.lit("\n")), "UTF-8").alias("data"))
    ship(rows.sparkSession)
    write_ordered(ready, path)


def _before(sizes: DataFrame, *order: str) -> DataFrame:
    """``order, start``: sums of ``n`` of the rows before, of which there is one for each part of a file or table."""
    before = F.sum("n").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return broadcast_if_small(materialise(sizes.select(*order, F.coalesce(before, F.lit(0)).alias("start")), "starts"))


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file that are not blank, in order: ``n`` from 0, ``line``. Files of a folder follow each other by name.

    Lines are numbered within the blocks they are read in; the lines of the blocks
    before, one row for each block, are added.
    """
    read = spark.read.text(path).where(F.trim("value") != "")
    block = ["file", "block"]
    read = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")
    starts = _before(read.groupBy(*block).agg(F.count("*").alias("n")), *block)
    at = F.row_number().over(Window.partitionBy(*block).orderBy("id")) - 1
    return read.withColumn("at", at).join(starts, block).select((F.col("start") + F.col("at")).alias("n"), F.col("value").alias("line"))


def read_block(spark: SparkSession, path: str, nx: int, ny: int) -> DataFrame:
    """Whole numbers laid out row by row: ``block, k, j, value``.

    Blank lines count for nothing; a second block of ``nx`` x ``ny`` values is block 1.
    """
    at = _numbered(spark, path).select(F.col("n").alias("row"), F.posexplode(F.split(F.trim("line"), "\\s+")).alias("i", "v"))
    return at.select(
        F.floor(F.col("row") / ny).cast("int").alias("block"), (F.col("row") % ny + 1).cast("int").alias("k"), (F.col("i") + 1).cast("int").alias("j"), F.col("v").cast("long").alias("value")
    ).where(F.col("j") <= nx)


def metadata(
    kind: str, nx: int, ny: int, lon0: float, lat0: float, dx: float, dy: float, name: str, scales: tuple[float, float] = (0.001, 0.01),
    place_scale: float = 1.0, endings: tuple[str, str, str] = (".depth_ascii", ".obstr_lev1", ".mask"),
) -> str:
    """K3: the metadata of a grid; ``RECT`` has its spacing in minutes, ``CURV`` names coordinate files.

    ``scales`` turn the numbers of the depth and obstruction files into values, and
    ``place_scale`` those of the coordinate files.
    """
    if kind not in ("RECT", "CURV"):
        raise ValueError(f"unknown grid type {kind}")
    out = ["$ "] * HEADER_LINES + [f"'{kind}' T 'NONE'", f"{nx} \t {ny}"]
    if kind == "RECT":
        out += [f"{dx * 60:5.2f} \t {dy * 60:5.2f} \t {60:5.2f}", f"{lon0:8.4f} \t {lat0:8.4f} \t {1:5.2f}"]
    else:
        out += [f"{unit} {place_scale} 0.0 1 1 '(....)' NAME '{name}.{axis}'" for unit, axis in ((20, "lon"), (30, "lat"))]
    out += ["$ Bottom bathymetry", f"-0.10 2.50 40 {scales[0]} 1 1 '(....)' NAME '{name}{endings[0]}'"]
    out += ["$ Sub-grid obstructions", f"50 {scales[1]} 1 1 '(....)' NAME '{name}{endings[1]}'"]
    return "\n".join([*out, "$ Mask", f"60 1 1 '(....)' NAME '{name}{endings[2]}'"]) + "\n"


def parse_metadata(text: str) -> dict[str, float]:
    """Sizes, spacing and origin of a ``RECT`` grid."""
    rows = text.split("\n")[HEADER_LINES:]
    if "RECT" not in rows[0]:
        raise ValueError("only RECT metadata describe a grid on their own")
    sizes, steps, origin = ([float(x) for x in re.findall(r"-?[\d.]+", rows[i])] for i in (1, 2, 3))
    return {"nx": int(sizes[0]), "ny": int(sizes[1]), "dx": steps[0] / steps[2], "dy": steps[1] / steps[2], "lon0": origin[0] / origin[2], "lat0": origin[1] / origin[2]}


def read_zone(spark: SparkSession, path: str) -> DataFrame:
    """One row with the ring of a zone, from lines of longitude and latitude."""
    numbers = _numbered(spark, path).select("n", F.split(F.trim("line"), "\\s+").cast("array<double>").alias("v"))
    flat = numbers.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("n", "v"))), lambda x: x["v"])).alias("v"))
    return flat.select(F.transform(F.sequence(F.lit(0), F.floor(F.size("v") / 2).cast("int") - 1), lambda i: F.struct(F.col("v")[2 * i].alias("x"), F.col("v")[2 * i + 1].alias("y"))).alias("ring"))


def read_flags(spark: SparkSession, path: str) -> DataFrame:
    """S3: ``id, flag, label`` of user polygons."""
    parts = F.split(F.trim("value"), "\\s+", 3)
    return spark.read.text(path).where(F.trim("value") != "").select(parts[0].cast("long").alias("id"), parts[1].cast("int").alias("flag"), parts[2].alias("label"))


def ranges(grid: DataFrame, values: list[str]) -> DataFrame:
    """K4: the actual range of each variable in single precision: ``name, low, high``."""
    kinds = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("float").cast("double").alias("v")) for c in values]))
    return grid.select(kinds.alias("x")).groupBy("x.name").agg(F.min("x.v").alias("low"), F.max("x.v").alias("high"))
