"""Files: their bytes, read back by the public specification, and how little is read."""

from __future__ import annotations

import glob
import math
import os
import struct

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidegrid.operators import bathymetry
from tidegrid.sources import netcdf, rasters, text
from tidegrid.sources.netcdf import read_netcdf, read_window, write_netcdf
from tidegrid.sources.ordered import OrderedWriter, write_ordered

NX, NY = 7, 5


def _values(spark):
    cells = spark.range(NX * NY).select((F.col("id") % NX + 1).cast("int").alias("j"), F.expr(f"cast(id div {NX} + 1 as int)").alias("k"))
    z = F.when((F.col("k") == 2) & (F.col("j") == 3), None).otherwise(F.col("k") * 10 + F.col("j") * 0.1)
    return cells.where("not (k = 4 and j = 4)").withColumns({"z": z, "mask": (F.col("j") % 2), "sx": F.col("j") / 8, "sy": F.col("k") / 16})


def _parse(data: bytes):
    """Dimensions, attributes and variables of a classic file, straight from the grammar of its header."""
    version, at = data[3], 4
    assert data[:3] == b"CDF" and version in (1, 2, 5)

    def take(code):
        nonlocal at
        out = struct.unpack_from(">" + code, data, at)
        at += struct.calcsize(">" + code)
        return out[0]

    count = lambda: take("q" if version == 5 else "i")

    def raw(n):
        nonlocal at
        out = data[at : at + n]
        assert data[at + n : (at + n + 3) // 4 * 4] == b"\0" * (-n % 4)
        at = (at + n + 3) // 4 * 4
        return out

    name = lambda: raw(count()).decode()

    def attributes():
        tag, n = take("i"), count()
        assert tag == (12 if n else 0)
        out = {}
        for _ in range(n):
            key, kind, size = name(), take("i"), count()
            out[key] = raw(size).decode() if kind == 2 else struct.unpack(f">{size}{ {5: 'f', 6: 'd'}[kind]}", raw(size * {5: 4, 6: 8}[kind]))
        return out

    assert count() == 0
    assert take("i") == 10
    dims = [(name(), count()) for _ in range(count())]
    about = attributes()
    assert take("i") == 11
    variables = {}
    for _ in range(count()):
        key = name()
        ids = [count() for _ in range(count())]
        notes, kind, size, begin = attributes(), take("i"), take("q" if version == 5 else "I"), take("i" if version == 1 else "q")
        shape = [dims[i][1] for i in ids]
        assert kind == 5 and size == 4 * math.prod(shape)
        variables[key] = ([dims[i][0] for i in ids], notes, np.frombuffer(data, ">f4", math.prod(shape), begin).reshape(shape))
    return dims, about, variables, at


@pytest.mark.parametrize("fill", [math.nan, -9.0])
def test_netcdf_has_the_bytes_of_the_format(spark, tmp_path, fill):
    path = str(tmp_path / "grid.nc")
    write_netcdf(_values(spark), range(NX), [1.5, 2.0, 2.5, 3.0, 3.5], path, NX, NY, fill, "a title", "made today")
    data = open(path, "rb").read()
    dims, about, variables, end = _parse(data)
    assert dims == [("lon", NX), ("lat", NY)] and list(variables) == ["lon", "lat", "z", "mask", "sx", "sy"]
    assert about == {"Conventions": "COARDS/CF-1.0", "title": "a title", "history": "File written by tidegrid", "description": "made today", "GMT_version": "4.x"}
    assert len(data) == end + 4 * (NX + NY + 4 * NX * NY)
    assert variables["lon"][2].tolist() == [*range(NX)] and variables["lat"][1] == {"long_name": "latitude", "actual_range": (1.5, 3.5)}
    at, notes, z = variables["z"]
    assert at == ["lat", "lon"] and notes["long_name"] == "Depth" and notes["scale_factor"] == (1.0,) and notes["add_offset"] == (0.0,)
    wanted = np.array([[k * 10 + j * 0.1 for j in range(1, NX + 1)] for k in range(1, NY + 1)])
    wanted[1, 2] = wanted[3, 3] = fill
    assert np.array_equal(z, wanted.astype("f4"), equal_nan=True) and np.array_equal(notes["_FillValue"], [np.float32(fill)], equal_nan=True)
    assert notes["actual_range"] == (np.float32(10.1), np.float32(50.7))
    sx = variables["sx"][2].copy()
    assert (sx[3, 3] == fill or math.isnan(sx[3, 3])) and sx[0].tolist() == [j / 8 for j in range(1, NX + 1)]
    assert [p for p in os.listdir(tmp_path) if not p.startswith(".")] == ["grid.nc"]


def test_axes_of_another_length_are_laid_out_in_equal_steps(spark, tmp_path):
    path = str(tmp_path / "grid.nc")
    write_netcdf(_values(spark).select("k", "j", "z"), [0.0, 100.0, 3.0], [5.0], path, NX, NY)
    _, _, variables, _ = _parse(open(path, "rb").read())
    assert list(variables) == ["lon", "lat", "z"] and variables["lon"][2].tolist() == pytest.approx([100 * i / 6 for i in range(7)], rel=1e-6)
    assert variables["lat"][2].tolist() == [5.0] * NY


@pytest.mark.parametrize(("nx", "version"), [(10, 1), (20_000, 2), (40_000, 5)])
def test_header_takes_the_least_version_that_holds_the_grid(nx, version):
    variables = [netcdf.Variable(n, "float", [1, 0], {"long_name": n}) for n in ("a", "b")]
    head = netcdf.header({"x": nx, "y": 30_000}, {}, variables)
    assert head[3] == version and variables[0].begin == len(head) and variables[1].begin == len(head) + 4 * nx * 30_000


def test_window_reads_its_slabs_only(spark, tmp_path):
    path, nx, ny = str(tmp_path / "base.nc"), 40, 60
    cells = spark.range(nx * ny).select(F.expr(f"cast(id % {nx} + 1 as int)").alias("j"), F.expr(f"cast(id div {nx} + 1 as int)").alias("k"), F.when(F.col("id") % 11 > 0, F.col("id")).alias("z"))
    write_netcdf(cells, np.arange(nx) / 4, np.arange(ny) / 4, path, nx, ny)
    whole = read_netcdf(spark, path, slab=10 * nx * 4)
    assert whole.rdd.getNumPartitions() == 6 and whole.count() == nx * ny
    wanted = {(i, k): (i / 4, k / 4, float(k * nx + i) if (k * nx + i) % 11 else None) for i in range(nx) for k in range(ny)}
    assert {(r.ilon, r.ilat): (r.lon, r.lat, r.z) for r in whole.collect()} == wanted
    part = read_netcdf(spark, path, slab=400, bounds=(5, 14, 12, 31))
    # ten columns of 4 bytes: ten rows in a slab of 400 bytes
    assert part.rdd.getNumPartitions() == 2
    assert {(r.ilon, r.ilat): (r.lon, r.lat, r.z) for r in part.collect()} == {(i, k): v for (i, k), v in wanted.items() if 5 <= i <= 14 and 12 <= k <= 31}
    assert read_netcdf(spark, path, bounds=(5, 4, 0, 9)).count() == 0
    shown = read_window(spark, path, (2.0, 3.0, 4.0, 5.0), (0.25, 0.25), slab=1000)
    stored = bathymetry.window(whole, 0.0, 0.0, 0.25, 0.25, nx, ny, (2.0, 3.0, 4.0, 5.0), (0.25, 0.25))
    assert shown.rdd.getNumPartitions() == 1 and sorted(shown.collect(), key=str) == sorted(stored.collect(), key=str) and shown.count() == 9 * 9
    around = read_window(spark, path, (9.25, 0.5, 0.0, 0.25), (0.25, 0.25))
    assert {r.ilon for r in around.collect()} == {35, 36, 37, 38, 39, 0, 1, 2, 3, 4}
    with pytest.raises(ValueError, match="beyond"):
        read_window(spark, path, (2.0, 30.0, 0.0, 1.0), (0.25, 0.25))


def _groups(path, condition):
    """Row groups of a table's files, and those whose statistics allow ``condition``."""
    files = glob.glob(f"{path}/**/*.parquet", recursive=True)
    met = []
    for f in files:
        about = pq.ParquetFile(f).metadata
        for g in range(about.num_row_groups):
            columns = (about.row_group(g).column(c) for c in range(about.num_columns))
            met.append(condition({c.path_in_schema: (c.statistics.min, c.statistics.max) for c in columns if c.statistics is not None}))
    return len(met), sum(met)


@pytest.fixture
def long_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_window_of_a_stored_raster_prunes_row_groups(spark, tmp_path, long_plans):
    path, n = str(tmp_path / "raster"), 200
    points = spark.range(n * n).select(F.expr(f"cast(id % {n} as int)").alias("ilon"), F.expr(f"cast(id div {n} as int)").alias("ilat"), F.col("id").alias("z"))
    rasters.write_raster(points, path, rows=1000)
    found = bathymetry.window(spark.read.parquet(path), 0.0, 0.0, 1.0, 1.0, n, n, (20.0, 30.0, 50.0, 60.0), (1.0, 1.0))
    assert found.count() == 15 * 15
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert all(f"{op}({c}," in pushed for c in ("ilon", "ilat") for op in ("GreaterThanOrEqual", "LessThanOrEqual"))
    groups, read = _groups(path, lambda s: s["ilon"][0] <= 32 and s["ilon"][1] >= 18 and s["ilat"][0] <= 62 and s["ilat"][1] >= 48)
    assert groups >= 30 and read <= 6


def test_shoreline_within_a_box_prunes_row_groups(spark, tmp_path, long_plans):
    path = str(tmp_path / "shore")
    x, y = (F.col("id") * 37 % 360).cast("double"), (F.col("id") * 7919 % 170 - 85).cast("double")
    corner = lambda a, b: F.struct((x + a).alias("x"), (y + b).alias("y"))
    shores = spark.range(4000).select(F.col("id").alias("poly_id"), F.lit(1).alias("level"), F.array(corner(0, 0), corner(1, 0), corner(0, 1), corner(0, 0)).alias("ring"))
    rasters.write_shoreline(shores, "high", path, rows=100)
    rasters.write_shoreline(shores.where("poly_id < 5"), "low", path)
    box = (100.0, 110.0, 10.0, 20.0)
    found = rasters.read_shoreline(spark, path, "high", box)
    wanted = shores.where((x <= 110) & (x + 1 >= 100) & (y <= 20) & (y + 1 >= 10))
    assert {r.poly_id for r in found.collect()} == {r.poly_id for r in wanted.collect()} and found.columns == shores.columns
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert all(f"({c}," in plan[plan.index("PushedFilters") :] for c in ("west", "east", "south", "north")) and "resolution" in plan[plan.index("PartitionFilters") :]
    groups, read = _groups(f"{path}/resolution=high", lambda s: s["west"][0] <= 110 and s["east"][1] >= 100 and s["south"][0] <= 20 and s["north"][1] >= 10)
    assert groups >= 30 and read <= groups // 5
    for asked, rows in (("full", 4000), ("inter", 4000), ("coarse", 5), ("low", 5)):
        assert rasters.read_shoreline(spark, path, asked, nearest=True).count() == rows
    assert rasters.read_shoreline(spark, path, "full").count() == 0


def test_lines_are_one_file_in_order(spark, tmp_path):
    path = str(tmp_path / "mask")
    grid = spark.range(300 * 40).select(F.expr("cast(id % 40 + 1 as int)").alias("j"), F.expr("cast(id div 40 + 1 as int)").alias("k"), F.col("id").alias("v")).repartition(9)
    text.write_lines(text.lines(grid, "v"), path)
    assert open(path).read() == "".join("".join(f" {k * 40 + j} " for j in range(40)) + "\n" for k in range(300))
    both = grid.select("k", "j", F.col("v").alias("sx"), (F.col("v") % 7).alias("sy"))
    text.write_lines(text.obstruction_lines(both), path)  # takes the place of the file that is there
    shown = open(path).read().split("\n")
    assert len(shown) == 602 and shown[300] == "" and shown[301].split() == [str(i % 7) for i in range(40)]
    assert text.read_block(spark, path, 40, 300).where("block = 1 and k = 300").count() == 40
    text.write_lines(text.lines(grid.limit(0), "v"), path)
    assert os.path.getsize(path) == 0


def test_only_committed_parts_are_in_the_file(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = lambda *x: iter([{"offset": o, "data": d} for o, d in x])
    writer = OrderedWriter(path)
    writer.write(rows((0, b"late ")))  # a copy of a task that Spark did not take
    messages = [writer.write(rows((5, b"world"), (10, b"!"))), writer.write(rows((0, b"hello"), (11, b"?"))), writer.write(rows()), None]
    writer.commit(messages)
    assert open(path, "rb").read() == b"helloworld!?" and os.listdir(tmp_path) == ["out"]
    for bad in ([(0, b"abc"), (4, b"x")], [(0, b"abc"), (2, b"x")]):
        with pytest.raises(Exception, match="missing|twice"):
            write_ordered(spark.createDataFrame(bad, "offset long, data binary"), str(tmp_path / "bad"))
    assert not os.path.exists(tmp_path / "bad")
