"""NetCDF classic files (versions 1, 2 and 5) as a Spark data source, and a sink of one file a year.

A file is a header with the places of its variables, then big-endian numbers. A partition is a run of time steps of one
file; filters on date and lat that Spark pushes down choose the steps and the rows of each step, which are read as byte
ranges, so nothing else of a file is touched.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, InputPartition
from pyspark.sql.types import StructType

from .zarr import BATCH_ROWS, days_of, days_since_epoch, open_fs, wanted

FORMAT = "isohyet_netcdf"
#: Bytes of one partition, about, and headers that the driver reads at a time.
PARTITION_BYTES, HEADERS = 32_000_000, 32
#: Bytes of a header that are read at first; a longer one is read again, twice as long.
HEAD_BYTES = 1 << 16

# Fixed values of the format: tags of lists, and external types with their numpy kinds
_DIMENSION, _VARIABLE, _ATTRIBUTE = 10, 11, 12
_KINDS = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}


@dataclass
class Variable:
    dims: list[str]
    attrs: dict
    kind: str
    size: int
    begin: int


class Header:
    """Dimensions (None: the one of records), variables and the number and bytes of records of a file."""

    def __init__(self, data: bytes):
        if data[:3] != b"CDF" or data[3] not in (1, 2, 5):
            raise ValueError("not a NetCDF classic file")
        self.data, self.at = data, 4
        self.wide, self.far = data[3] == 5, data[3] != 1
        self.records = self._count()
        self.dims: dict[str, int] = {}
        record_dim = None
        for _ in range(self._list(_DIMENSION)):
            name, n = self._name(), self._count()
            self.dims[name] = n
            record_dim = name if n == 0 else record_dim
        names = list(self.dims)
        self.attrs = self._attributes()
        self.variables: dict[str, Variable] = {}
        for _ in range(self._list(_VARIABLE)):
            name = self._name()
            dims = [names[self._count()] for _ in range(self._count())]
            attrs = self._attributes()
            kind, size = _KINDS[self._int()], self._count()
            self.variables[name] = Variable(dims, attrs, kind, size, self._int(8 if self.far else 4))
        with_records = [v for v in self.variables.values() if v.dims[:1] == [record_dim] and record_dim]
        self.record_dim = record_dim
        self.record_bytes = sum(v.size for v in with_records)
        if len(with_records) == 1:  # alone, a record isn't padded
            v = with_records[0]
            self.record_bytes = int(np.prod([self.dims[d] for d in v.dims[1:]], dtype=np.int64)) * np.dtype(v.kind).itemsize
        if record_dim:
            self.dims[record_dim] = self.records

    def _int(self, n: int = 4) -> int:
        if self.at + n > len(self.data):
            raise EOFError
        self.at += n
        return int.from_bytes(self.data[self.at - n : self.at], "big")

    def _count(self) -> int:
        return self._int(8 if self.wide else 4)

    def _list(self, tag: int) -> int:
        found, n = self._int(), self._count()
        if found not in (0, tag):
            raise ValueError("damaged header")
        return n

    def _padded(self, n: int) -> bytes:
        start, stop = self.at, self.at + n
        self.at = start + -(-n // 4) * 4
        if self.at > len(self.data):
            raise EOFError
        return self.data[start:stop]

    def _name(self) -> str:
        return self._padded(self._count()).decode()

    def _attributes(self) -> dict:
        found = {}
        for _ in range(self._list(_ATTRIBUTE)):
            name, kind, n = self._name(), _KINDS[self._int()], self._count()
            raw = self._padded(n * np.dtype(kind).itemsize)
            found[name] = raw.decode() if kind == "S1" else np.frombuffer(raw, dtype=kind)[0].item() if n else None
        return found


def read_header(path: str) -> Header:
    fs, inner = open_fs(path)
    n = HEAD_BYTES
    with fs.open_input_file(inner) as file:
        while True:
            try:
                return Header(file.read_at(min(n, file.size()), 0))
            except EOFError:
                if n >= file.size():
                    raise ValueError(f"{path}: the header ends early") from None
                n *= 2


def _values(header: Header, name: str, file, low: int = 0, high: int | None = None, rows: tuple[int, int] | None = None) -> np.ndarray:
    """Steps low to high of a variable, and of its second dimension the given rows, as stored."""
    v = header.variables[name]
    shape = [header.dims[d] for d in v.dims]
    high = shape[0] if high is None else high
    item = np.dtype(v.kind).itemsize
    inside = int(np.prod(shape[1:], dtype=np.int64)) * item
    step = header.record_bytes if v.dims[0] == header.record_dim else inside
    first, n = 0, inside
    if rows is not None:
        line = int(np.prod(shape[2:], dtype=np.int64)) * item
        first, n, shape[1] = rows[0] * line, (rows[1] - rows[0]) * line, rows[1] - rows[0]
    if step == n:
        data = file.read_at((high - low) * n, v.begin + low * step)
    else:
        data = b"".join(file.read_at(n, v.begin + k * step + first) for k in range(low, high))
    return np.frombuffer(data, dtype=v.kind).reshape([high - low, *shape[1:]])


@dataclass
class _Steps(InputPartition):
    path: str
    low: int
    high: int


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], schema: StructType):
        self.paths, self.names = paths, schema.names
        self.variables = [n for n in schema.names if n not in ("location_id", "lon", "lat", "date")]
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> list[Filter]:
        """Filters choose steps and rows; Spark still applies them."""
        self.filters = list(filters)
        return filters

    def _axes(self, header: Header, file) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        days = days_of(_values(header, "time", file).astype(np.float64), header.variables["time"].attrs["units"])
        return days, *(_values(header, n, file).astype(np.float64) for n in ("lat", "lon"))

    def _steps_of(self, path: str) -> list[_Steps]:
        header = read_header(path)
        fs, inner = open_fs(path)
        with fs.open_input_file(inner) as file:
            days, lats, lons = self._axes(header, file)
        keep = np.flatnonzero(wanted(self.filters, "date", days, days_since_epoch))
        if not (len(keep) and wanted(self.filters, "lat", lats).any() and wanted(self.filters, "lon", lons).any()):
            return []
        size = max(1, PARTITION_BYTES // max(1, 8 * len(lats) * len(lons) * max(1, len(self.variables))))
        return [_Steps(path, k, min(k + size, int(keep[-1]) + 1)) for k in range(int(keep[0]), int(keep[-1]) + 1, size)]

    def partitions(self) -> list[_Steps]:
        with ThreadPoolExecutor(HEADERS) as pool:
            return [x for found in pool.map(self._steps_of, self.paths) for x in found]

    def read(self, partition: _Steps | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing was planned
            return
        header = read_header(partition.path)
        fs, inner = open_fs(partition.path)
        with fs.open_input_file(inner) as file:
            days, lats, lons = self._axes(header, file)
            ys, xs = np.flatnonzero(wanted(self.filters, "lat", lats)), np.flatnonzero(wanted(self.filters, "lon", lons))
            rows = (int(ys[0]), int(ys[-1]) + 1)
            cell = (ys[:, None] * len(lons) + xs).ravel()
            cell_lat, cell_lon = np.repeat(lats[ys], len(xs)), np.tile(lons[xs], len(ys))
            steps = max(1, BATCH_ROWS // max(1, len(cell)))
            for low in range(partition.low, partition.high, steps):
                high = min(low + steps, partition.high)
                n = high - low
                columns = {"location_id": np.tile(cell, n), "lon": np.tile(cell_lon, n), "lat": np.tile(cell_lat, n), "date": np.repeat(days[low:high], len(cell)).astype(np.int32)}
                for name in self.variables:
                    raw, attrs = _values(header, name, file, low, high, rows)[:, ys - rows[0]][:, :, xs], header.variables[name].attrs
                    out = raw.astype(np.float64)
                    for missing in {attrs.get("_FillValue"), attrs.get("missing_value")} - {None}:
                        out[raw == np.asarray(missing, dtype=raw.dtype)] = np.nan
                    columns[name] = (out * attrs.get("scale_factor", 1.0) + attrs.get("add_offset", 0.0)).ravel()
                made = [pa.array(columns[c], from_pandas=True) for c in self.names]
                yield pa.RecordBatch.from_arrays([m.cast(pa.date32()) if c == "date" else m for c, m in zip(self.names, made, strict=True)], names=self.names)


class NetcdfSource(DataSource):
    """location_id, lon, lat, date and the variables of (time, lat, lon); the files' grids and variables are alike."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _paths(self) -> list[str]:
        return self.options["files"].split("\n")

    def schema(self) -> str:
        found = [n for n, v in read_header(self._paths()[0]).variables.items() if len(v.dims) == 3]
        return "location_id long, lon double, lat double, date date, " + ", ".join(f"`{v}` double" for v in found)

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self._paths(), schema)


def read_netcdf(spark: SparkSession, paths: list[str], variables: list[str] | None = None) -> DataFrame:
    """Files as one table; filters on date, lat and lon reach the choice of byte ranges. variables: only these are read."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(NetcdfSource)
    reader = spark.read.format(FORMAT)
    if variables is not None:
        reader = reader.schema("location_id long, lon double, lat double, date date, " + ", ".join(f"`{v}` double" for v in variables))
    return reader.option("files", "\n".join(paths)).load()


def _text(name: str) -> bytes:
    raw = name.encode()
    return struct.pack(">I", len(raw)) + raw + bytes(-len(raw) % 4)


def _attribute(name: str, value: str | float) -> bytes:
    if isinstance(value, str):
        return _text(name) + struct.pack(">I", 2) + _text(value)
    return _text(name) + struct.pack(">IId", 6, 1, value)


def encode(days: np.ndarray, lats: np.ndarray, lons: np.ndarray, values: dict[str, np.ndarray], records: bool = True) -> bytes:
    """A file (version 2) with days since 1970 and arrays of (time, lat, lon); records: time is the dimension of records."""
    n, ny, nx = len(days), len(lats), len(lons)
    attrs = {"time": {"units": "days since 1970-01-01", "calendar": "proleptic_gregorian"}, "lat": {"units": "degrees_north"}, "lon": {"units": "degrees_east"}}
    attrs |= {v: {"_FillValue": float("nan")} for v in values}
    dims = {"lat": [1], "lon": [2], "time": [0], **{v: [0, 1, 2] for v in values}}
    size = {"lat": 8 * ny, "lon": 8 * nx, "time": 8 if records else 8 * n, **{v: 8 * ny * nx * (1 if records else n) for v in values}}

    def head(begins: dict[str, int]) -> bytes:
        out = b"CDF\x02" + struct.pack(">I", n if records else 0) + struct.pack(">II", _DIMENSION, 3)
        out += b"".join(_text(d) + struct.pack(">I", k) for d, k in (("time", 0 if records else n), ("lat", ny), ("lon", nx))) + bytes(8)
        out += struct.pack(">II", _VARIABLE, len(dims))
        for v, ids in dims.items():
            out += _text(v) + struct.pack(f">I{len(ids)}I", len(ids), *ids) + struct.pack(">II", _ATTRIBUTE, len(attrs[v]))
            out += b"".join(_attribute(k, x) for k, x in attrs[v].items()) + struct.pack(">IIQ", 6, min(size[v], 0xFFFFFFFF), begins[v])
        return out

    at, begins = len(head(dict.fromkeys(dims, 0))), {}
    for v in dims:
        begins[v], at = at, at + size[v]
    body = [np.asarray(x, dtype=">f8").tobytes() for x in (lats, lons)]
    if records:
        one = np.concatenate([np.asarray(days, dtype=">f8")[:, None], *(np.asarray(x, dtype=">f8").reshape(n, -1) for x in values.values())], axis=1)
        body.append(one.astype(">f8").tobytes())
    else:
        body += [np.asarray(x, dtype=">f8").tobytes() for x in (days, *values.values())]
    return head(begins) + b"".join(body)


def write_netcdf(df: DataFrame, folder: str, variables: list[str], records: bool = True) -> DataFrame:
    """Write lon, lat, date and variables as one file a year; returns path, year, days of each.

    A file is written under a name of its own attempt and then moved to its place, so a lost task leaves no half of one.
    A year's grid meets in one task. Axes are the distinct coordinates, which the driver holds. Missing values are NaN.
    """
    axes = {c: np.array([r[0] for r in df.select(c).distinct().orderBy(c).collect()], dtype=np.float64) for c in ("lat", "lon")}
    fs, inner = open_fs(folder)
    fs.create_dir(inner, recursive=True)

    def save(table: pa.Table) -> pa.Table:
        own, inside = open_fs(folder)
        day = table["date"].cast(pa.int32()).to_numpy()
        days = np.arange(day.min(), day.max() + 1)
        place = (day - days[0], np.searchsorted(axes["lat"], table["lat"].to_numpy()), np.searchsorted(axes["lon"], table["lon"].to_numpy()))
        values = {}
        for v in variables:
            values[v] = np.full((len(days), len(axes["lat"]), len(axes["lon"])), np.nan)
            values[v][place] = table[v].cast(pa.float64()).to_numpy()
        year = table["year"][0].as_py()
        final, attempt = f"{inside}/{year}.nc", f"{inside}/.{year}-{uuid.uuid4().hex}"
        with own.open_output_stream(attempt) as stream:
            stream.write(encode(days, axes["lat"], axes["lon"], values, records))
        own.move(attempt, final)
        return pa.table({"path": [f"{folder}/{year}.nc"], "year": pa.array([year], pa.int32()), "days": pa.array([len(days)], pa.int32())})

    return df.select("lon", "lat", "date", *variables, F.year("date").alias("year")).groupBy("year").applyInArrow(save, "path string, year int, days int")
