"""Grids as NetCDF classic files, by the public specification of the format."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tidegrid.operators.bathymetry import window_bounds
from tidegrid.plans.ship import ship
from tidegrid.sources.ordered import opened, write_ordered

# fixed values: numbers of types, and tags of lists, in the format
TYPES = {"char": 2, "short": 3, "int": 4, "float": 5, "double": 6}
CODES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
DIMENSION, VARIABLE, ATTRIBUTE = 10, 11, 12
#: Long names of the variables of a model grid.
# fixed values
LONG_NAMES = {"z": "Depth", "mask": "mask", "sx": "Subgrd obstr x", "sy": "Subgrd obstr y"}
#: Bytes of values in a row that goes to the writer, and of a slab that a task reads, about.
CHUNK, SLAB = 1 << 20, 8 << 20


@dataclass
class Variable:
    name: str
    kind: str
    dims: list[int]
    attributes: dict[str, object]
    size: int = 0
    begin: int = 0


class _Head:
    """Bytes of a header in version 1, 2 (places of 64 bits) or 5 (numbers of 64 bits, too)."""

    def __init__(self, version: int) -> None:
        self.version, self.out = version, bytearray(b"CDF" + bytes([version]))

    def number(self, n: int) -> None:
        self.out += struct.pack(">q" if self.version == 5 else ">i", n)

    def tag(self, n: int) -> None:
        self.out += struct.pack(">i", n)

    def padded(self, data: bytes) -> None:
        self.out += data + b"\0" * (-len(data) % 4)

    def name(self, text: str) -> None:
        data = text.encode()
        self.number(len(data))
        self.padded(data)

    def listed(self, tag: int, n: int) -> None:
        self.tag(tag if n else 0)
        self.number(n)

    def attributes(self, values: dict[str, object]) -> None:
        self.listed(ATTRIBUTE, len(values))
        for name, value in values.items():
            self.name(name)
            if isinstance(value, str):
                data = value.encode()
                self.tag(TYPES["char"])
                self.number(len(data))
                self.padded(data)
            else:
                array = np.atleast_1d(value)
                kind = "float" if array.dtype == np.float32 else "double"
                self.tag(TYPES[kind])
                self.number(len(array))
                self.padded(array.astype(CODES[TYPES[kind]]).tobytes())


def header(dims: dict[str, int], attributes: dict[str, object], variables: list[Variable]) -> bytes:
    """The header; places and sizes of ``variables`` are filled in. The least version that holds them is taken."""
    for v in variables:
        v.size = math.prod([*dims.values()][d] for d in v.dims) * np.dtype(CODES[TYPES[v.kind]]).itemsize
    version, length = 1, 0
    for _ in range(4):
        head = _Head(version)
        head.number(0)
        head.listed(DIMENSION, len(dims))
        for name, n in dims.items():
            head.name(name)
            head.number(n)
        head.attributes(attributes)
        head.listed(VARIABLE, len(variables))
        at = length
        for v in variables:
            v.begin, at = at, at + v.size + -v.size % 4
            head.name(v.name)
            head.number(len(v.dims))
            for d in v.dims:
                head.number(d)
            head.attributes(v.attributes)
            head.tag(TYPES[v.kind])
            wide = v.size + -v.size % 4
            head.out += struct.pack(">q", wide) if version == 5 else struct.pack(">I", min(wide, 2**32 - 1))
            head.out += struct.pack(">i", min(v.begin, 2**31 - 1)) if version == 1 else struct.pack(">q", v.begin)
        need = 5 if any(v.size >= 2**32 - 4 for v in variables) else 2 if at >= 2**31 else 1
        if len(head.out) == length and need <= version:
            return bytes(head.out)
        version, length = max(version, need), len(head.out)
    raise AssertionError("a header's length follows from its version")


def axis_of(values: Sequence[float], n: int) -> np.ndarray:
    """An axis of ``n`` places: the values if they are as many, else equal steps over their range."""
    values = np.asarray(values, np.float64)
    if len(values) == n:
        return values
    return np.linspace(values.min(), values.max(), n)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``offset, data``: neighbouring values of 4 bytes as one row."""
    for batch in batches:
        offset, value = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False).astype(">f4")
        cuts = [*np.flatnonzero(np.diff(offset, prepend=-1) != 4), len(offset)] if len(offset) else []
        rows = [(offset[s], value[s : min(s + CHUNK // 4, b)].tobytes()) for a, b in zip(cuts, cuts[1:]) for s in range(a, b, CHUNK // 4)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["offset", "data"])


def write_netcdf(grid: DataFrame, lon: Sequence[float], lat: Sequence[float], path: str, nx: int, ny: int, fill: float = math.nan, title: str = "", description: str = "") -> None:
    """K4: one file with ``lon, lat, z`` and, if ``grid`` has them, ``mask`` and ``sx, sy``.

    ``grid`` has ``k, j`` from 1 and the values; a cell that is missing or null has the value
    ``fill``. Values are stored in single precision with their long name, ``_FillValue``,
    scale, offset and the range that occurs. Axes of another length than the grid are laid
    out anew in equal steps. Every value's place in the file is known from the header, so
    cells are dealt out by place and tasks write them side by side.
    """
    spark = grid.sparkSession
    ship(spark)
    names = [c for c in ("z", "mask", "sx", "sy") if c in grid.columns]
    seen = grid.agg(*[f(F.when(~F.isnan(F.col(c).cast("float")), F.col(c).cast("float"))).alias(f"{f.__name__}_{c}") for c in names for f in (F.min, F.max)]).first()
    axes = {"lon": axis_of(lon, nx), "lat": axis_of(lat, ny)}
    variables = [Variable(n, "float", [d], {"long_name": long, "actual_range": np.array([axes[n].min(), axes[n].max()])}) for d, (n, long) in enumerate((("lon", "longitude"), ("lat", "latitude")))]
    for name in names:
        ends = [np.float32(math.nan if (v := seen[f"{f}_{name}"]) is None else v) for f in ("min", "max")]
        about = {"long_name": LONG_NAMES[name], "_FillValue": np.float32(fill), "scale_factor": 1.0, "add_offset": 0.0, "actual_range": np.array(ends, np.float32)}
        variables.append(Variable(name, "float", [1, 0], about))
    about = {"Conventions": "COARDS/CF-1.0", "title": title, "history": "File written by tidegrid", "description": description, "GMT_version": "4.x"}
    head = header({"lon": nx, "lat": ny}, about, variables)
    first = head + b"".join(axes[v.name].astype(">f4").tobytes() for v in variables[:2])

    every = spark.range(nx * ny).select(F.col("id").alias("at"))
    known = grid.select(((F.col("k").cast("long") - 1) * nx + F.col("j") - 1).alias("at"), *names)
    values = F.array(*[F.struct((F.lit(v.begin) + 4 * F.col("at")).alias("offset"), F.coalesce(F.col(v.name).cast("float"), F.lit(fill).cast("float")).alias("value")) for v in variables[2:]])
    placed = every.join(known, "at", "left").select(F.explode(values).alias("v")).select("v.offset", "v.value")
    packed = placed.repartitionByRange("offset").sortWithinPartitions("offset").mapInArrow(_packed, "offset long, data binary")
    write_ordered(packed.unionByName(spark.createDataFrame([(0, bytearray(first))], "offset long, data binary")), path)


@dataclass
class Layout:
    """What the header of a file says."""

    dims: list[tuple[str, int]]
    attributes: dict[str, object]
    variables: dict[str, Variable] = field(default_factory=dict)


def read_header(path: str) -> Layout:
    """Dimensions, attributes and variables of a file; variables of records are not supported."""
    store, name = opened(path)
    with store.open_input_file(name) as source:
        magic = source.read(4)
        if magic[:3] != b"CDF" or magic[3] not in (1, 2, 5):
            raise ValueError(f"{path} is no NetCDF classic file")
        wide = magic[3] == 5

        def take(code: str) -> int:
            return struct.unpack(code, source.read(struct.calcsize(code)))[0]

        def number() -> int:
            return take(">q" if wide else ">i")

        def text() -> str:
            n = number()
            return source.read(n + -n % 4)[:n].decode()

        def attributes() -> dict[str, object]:
            take(">i")
            out: dict[str, object] = {}
            for _ in range(number()):
                key, kind, n = text(), take(">i"), number()
                size = n * np.dtype(CODES[kind]).itemsize
                data = source.read(size + -size % 4)[:size]
                out[key] = data.decode() if kind == 2 else np.frombuffer(data, CODES[kind])
            return out

        number()
        take(">i")
        layout = Layout([(text(), number()) for _ in range(number())], {})
        layout.attributes = attributes()
        take(">i")
        for _ in range(number()):
            v = Variable(text(), "", [number() for _ in range(number())], attributes())
            kind = take(">i")
            v.kind = CODES[kind]
            v.size = number() if wide else take(">I")
            v.begin = take(">i") if magic[3] == 1 else take(">q")
            layout.variables[v.name] = v
    return layout


@dataclass
class Slab(InputPartition):
    """Rows ``south`` to ``north`` and columns ``west`` to ``east`` of a raster, ends included."""

    south: int
    north: int
    west: int
    east: int


class RasterReader(DataSourceReader):
    """Rows ``ilon, ilat, lon, lat, z`` of one variable, of the columns and rows that options name."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.slab = options["path"], int(options.get("slab", SLAB))
        self.layout = read_header(self.path)
        self.names = [options.get(c, c) for c in ("lon", "lat", "z")]
        self.nx, self.ny = (self.layout.dims[self.layout.variables[n].dims[0]][1] for n in self.names[:2])
        within = lambda name, least, most: min(most, max(least, int(options.get(name, least if name in ("west", "south") else most))))
        self.bounds = [within("west", 0, self.nx - 1), within("east", 0, self.nx - 1), within("south", 0, self.ny - 1), within("north", 0, self.ny - 1)]

    def partitions(self) -> list[Slab]:
        west, east, south, north = self.bounds
        if west > east or south > north:
            return []
        item = np.dtype(self.layout.variables[self.names[2]].kind).itemsize
        rows = max(1, self.slab // ((east - west + 1) * item))
        return [Slab(k, min(k + rows - 1, north), west, east) for k in range(south, north + 1, rows)]

    def read(self, slab: Slab | None) -> Iterator[pa.RecordBatch]:
        if slab is None:  # there is no slab, and Spark reads one all the same
            return
        store, name = opened(self.path)
        lon, lat, z = (self.layout.variables[n] for n in self.names)
        with store.open_input_file(name) as source:

            def values(v: Variable, first: int, n: int) -> np.ndarray:
                kind = np.dtype(v.kind)
                return np.frombuffer(source.read_at(n * kind.itemsize, v.begin + first * kind.itemsize), kind)

            n = slab.east - slab.west + 1
            x = values(lon, slab.west, n).astype(np.float64)
            y = values(lat, slab.south, slab.north - slab.south + 1).astype(np.float64)
            scale, offset = (float(np.atleast_1d(z.attributes.get(a, d))[0]) for a, d in (("scale_factor", 1.0), ("add_offset", 0.0)))
            empty = z.attributes.get("_FillValue")
            for k in range(slab.south, slab.north + 1):
                raw = values(z, k * self.nx + slab.west, n)
                found = raw.astype(np.float64)
                none = np.isnan(found) if empty is None else np.isnan(found) | (raw == empty[0])
                columns = [np.arange(slab.west, slab.east + 1, dtype=np.int32), np.full(n, k, np.int32), x, np.full(n, y[k - slab.south])]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(found * scale + offset, mask=none)], ["ilon", "ilat", "lon", "lat", "z"])


class Raster(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidegrid_raster"

    def schema(self) -> str:
        return "ilon int, ilat int, lon double, lat double, z double"

    def reader(self, schema: StructType) -> DataSourceReader:
        return RasterReader(dict(self.options))


def read_netcdf(spark: SparkSession, path: str, names: tuple[str, str, str] = ("lon", "lat", "z"), slab: int = SLAB, bounds: tuple[int, int, int, int] | None = None) -> DataFrame:
    """``ilon, ilat, lon, lat, z`` of a file, in slabs of about ``slab`` bytes.

    With ``bounds`` only columns west to east and rows south to north are read, ends
    included. A fill value is null; scale and offset are applied. Bounds are given here and
    not as a filter: Spark keeps what it has pushed to a Python source for the next query
    of the same DataFrame, whatever that asks.
    """
    ship(spark)
    spark.dataSource.register(Raster)
    limits = dict(zip(("west", "east", "south", "north"), map(str, bounds))) if bounds else {}
    return spark.read.format("tidegrid_raster").options(lon=names[0], lat=names[1], z=names[2], slab=str(slab), **limits).load(path)


def read_window(spark: SparkSession, path: str, box: tuple[float, float, float, float], cell: tuple[float, float], names: tuple[str, str, str] = ("lon", "lat", "z"), slab: int = SLAB) -> DataFrame:
    """The points of a file within two cells of ``box``, see ``bathymetry.window``; nothing else is read.

    Axes are in equal steps, which their first values give. A box over both ends of a raster
    that goes round is two windows.
    """
    layout = read_header(path)
    store, name = opened(path)
    axes = []
    with store.open_input_file(name) as source:
        for axis in names[:2]:
            v = layout.variables[axis]
            kind = np.dtype(v.kind)
            first = np.frombuffer(source.read_at(2 * kind.itemsize, v.begin), kind).astype(float)
            axes.append((first[0], first[1] - first[0], layout.dims[v.dims[0]][1]))
    (lon0, dx, nx), (lat0, dy, ny) = axes
    west, east, south, north = window_bounds(lon0, lat0, dx, dy, nx, ny, box, cell)
    spans = [(west, east)] if box[0] <= box[1] else [(west, nx - 1), (0, east)]
    parts = [read_netcdf(spark, path, names, slab, (a, b, south, north)) for a, b in spans]
    return reduce(DataFrame.unionByName, parts)
