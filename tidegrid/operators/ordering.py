"""Numbering the rows of a table in one order without gathering them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.plans.shared import materialise


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``n``, from 0 in the order of columns whose values do not repeat.

    Rows are dealt out by ranges and numbered in each part; the sizes of the parts
    before it, one row for each, are added.
    """
    dealt = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    placed = dealt.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1)
    placed = materialise(placed, "numbered")
    parts = placed.groupBy("part").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    return placed.join(F.broadcast(starts), "part").withColumn("n", F.col("start") + F.col("at")).drop("part", "at", "start")
