"""Base rasters and shorelines as Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.geometry import ring_box

#: Names of longitude, latitude and depth in rasters known by name.
# fixed values: the variable names of two public global rasters
KNOWN = {"etopo1": ("lon", "lat", "z"), "etopo2": ("x", "y", "z")}
#: Resolutions of a shoreline, from the finest.
RESOLUTIONS = ("full", "high", "inter", "low", "coarse")


def write_raster(raster: DataFrame, path: str, rows: int = 1_000_000) -> None:
    """Store ``ilon, ilat`` and more in squares of about ``rows`` points that follow a space-filling curve.

    The curve takes bits of column and row in turn, so the least and largest column and
    row of a row group bound a small part of the raster.
    """
    curve = _curve(F.col("ilon"), F.col("ilat"))
    parts = max(1, -(-raster.count() // rows))
    raster.withColumn("z_", curve).repartitionByRange(parts, "z_").sortWithinPartitions("z_").drop("z_").write.mode("overwrite").parquet(path)


def _curve(x: Column, y: Column) -> Column:
    """Bits of two whole numbers below 2**31 in turn."""

    def spread(v: Column) -> Column:
        v = v.cast("long")
        # fixed values: every step moves half of the bits apart
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1))


def read_raster(spark: SparkSession, folder: str, source: str, names: tuple[str, str, str] | None = None) -> DataFrame:
    """S1e: ``ilon, ilat, lon, lat, z`` of the raster ``source`` in a folder.

    Those of ``KNOWN`` have their own names of variables, whatever ``names`` says; any
    other needs ``names``. Only these columns are read.
    """
    if source not in KNOWN and names is None:
        raise ValueError(f"the names of longitude, latitude and depth in {source} are needed")
    lon, lat, z = KNOWN.get(source) or names
    return spark.read.parquet(f"{folder}/{source}").select("ilon", "ilat", F.col(lon).alias("lon"), F.col(lat).alias("lat"), F.col(z).alias("z"))


#: Degrees of the squares whose order shorelines are stored in.
SQUARE = 1 / 64


def write_shoreline(polygons: DataFrame, resolution: str, path: str, rows: int = 100_000) -> None:
    """Add the polygons of one resolution to a table that is partitioned by it.

    Polygons are stored with their boxes, along a space-filling curve over their middles, in
    files of about ``rows``: a file's least and largest box sides bound a part of the globe.
    """
    if resolution not in RESOLUTIONS:
        raise ValueError(f"resolution {resolution} is none of {RESOLUTIONS}")
    boxed = polygons.select("*", *ring_box(F.col("ring")))
    index = lambda a, b: F.floor(((F.col(a) + F.col(b)) / 2 + 1024) / SQUARE)
    parts = max(1, -(-polygons.count() // rows))
    dealt = boxed.withColumn("z_", _curve(index("west", "east"), index("south", "north"))).repartitionByRange(parts, "z_").sortWithinPartitions("z_").drop("z_")
    dealt.withColumn("resolution", F.lit(resolution)).write.mode("append").partitionBy("resolution").parquet(path)


def read_shoreline(spark: SparkSession, path: str, resolution: str = "full", box: tuple[float, float, float, float] | None = None, nearest: bool = False) -> DataFrame:
    """The polygons of one resolution, and with ``box`` (west, east, south, north) those whose boxes touch it.

    Other partitions are not read, and row groups beyond the box are skipped by the
    statistics of its sides. With ``nearest`` a resolution that the table has not is replaced
    by the next finer one it has, or else by the next coarser.
    """
    if resolution not in RESOLUTIONS:
        raise ValueError(f"resolution {resolution} is none of {RESOLUTIONS}")
    table = spark.read.parquet(path)
    if nearest:
        there = {r[0] for r in table.select("resolution").distinct().collect()}  # names of partitions, five at most
        at = RESOLUTIONS.index(resolution)
        resolution = next((r for r in (*RESOLUTIONS[at::-1], *RESOLUTIONS[at + 1 :]) if r in there), resolution)
    found = table.where(F.col("resolution") == resolution)
    if box:
        west, east, south, north = map(float, box)
        found = found.where((F.col("west") <= east) & (F.col("east") >= west) & (F.col("south") <= north) & (F.col("north") >= south))
    return found.drop("resolution", "west", "east", "south", "north")
