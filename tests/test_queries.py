"""Every query of the grid operators against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tidegrid.plans import catalogue

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables() -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_equals_sql(spark, tables, name):
    found = catalogue.queries()[name](spark, SF_DIR)
    wanted = tables.sql(catalogue.oracle_sql()[name])
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    ours = sorted(tuple(r[c] for c in columns) for r in found.collect())
    theirs = sorted(tuple(dict(zip(wanted.columns, r))[c] for c in columns) for r in wanted.fetchall())
    assert ours == theirs


#: Rows that show what a query is for, and how many there are at least.
CASES = {
    "poly_cover": ("true", 1),
    "poly_grazing": ("grazing", 3),
    "poly_split_tiles": ("true", 20),
    "poly_clip_rings": ("not whole", 50),
    "pipeline_regional": ("sx > 0 and sx < 1000000 and sy > 0", 3),
    "lake_min_size": ("mask = 1", 10),
    "bathy_auto_mixed": ("mode = 'average' and depth < 999999000000", 1),
    "obstr_ob2": ("sx > 0 or sy > 0", 1),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_rows_show_the_case(spark, name):
    condition, least = CASES[name]
    assert catalogue.queries()[name](spark, SF_DIR).where(condition).count() >= least


def test_boundary_nodes_are_supported_across_the_seam(spark):
    """Some boundary nodes are between the parent's last column, at 345 degrees, and its first, and only so have their parents."""
    turn = F.pmod(F.col("lon") - 15, F.lit(360.0)) / 30
    kept = {wrap: {(r.k, r.j) for r in catalogue._around(spark, "/root/testdata/sf0.01", wrap).where((F.col("mask") == 2) & (turn > 11)).collect()} for wrap in (True, False)}
    assert kept[False] < kept[True]
