"""Zarr stores (version 2) as a Spark data source: cubes of time, latitude and longitude, read and written by chunk.

Reading: a partition is a run of chunks along time; filters on date, lon and lat that Spark pushes down decide which chunks
are planned, so what lies outside is never opened. Writing has two phases: tasks write chunk files under names of their
own attempt, and only once all have succeeded the driver moves them to their places and publishes the metadata, last.
"""

from __future__ import annotations

import bz2
import gzip
import json
import lzma
import math
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "isohyet_zarr"
_EPOCH = date(1970, 1, 1)
#: Partitions of a scan at most; beyond it a partition has several chunks along time.
MOST_PARTITIONS = 50_000
#: Rows of an Arrow batch, about.
BATCH_ROWS = 250_000
#: Files that the driver moves at a time when a write is committed.
MOVERS = 32

_UNPACK = {"zlib": zlib.decompress, "gzip": gzip.decompress, "bz2": bz2.decompress, "lzma": lzma.decompress, "zstd": lambda b: zstandard.ZstdDecompressor().decompressobj().decompress(b)}
_PACK = {"zlib": lambda b, level: zlib.compress(b, level), "gzip": lambda b, level: gzip.compress(b, level, mtime=0), "zstd": lambda b, level: zstandard.ZstdCompressor(level=level).compress(b)}


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def _read(fs: pafs.FileSystem, path: str) -> bytes | None:
    """A file's bytes, or None where there is no such file."""
    try:
        with fs.open_input_stream(path) as stream:
            return stream.read()
    except FileNotFoundError:
        return None


class Array:
    """One array of a store: its metadata, and its chunks as numpy arrays."""

    def __init__(self, root: str, name: str):
        fs, inner = open_fs(root)
        described = _read(fs, f"{inner}/{name}/.zarray")
        if described is None:
            raise FileNotFoundError(f"{root} has no array {name}; an unfinished store has no metadata")
        meta = json.loads(described)
        self.root, self.name, self.shape, self.chunks = root, name, tuple(meta["shape"]), tuple(meta["chunks"])
        self.dtype, self.separator = np.dtype(meta["dtype"]), meta.get("dimension_separator", ".")
        fill = meta.get("fill_value")
        self.fill = {"NaN": math.nan, "Infinity": math.inf, "-Infinity": -math.inf}.get(fill, fill)
        self.attrs = json.loads(_read(fs, f"{inner}/{name}/.zattrs") or b"{}")
        codec = meta.get("compressor")
        self.codec = codec["id"] if codec else None
        if meta["zarr_format"] != 2 or meta.get("order", "C") != "C" or meta.get("filters") or self.codec not in (None, *_UNPACK):
            raise ValueError(f"{name}: only version 2, order C, no filters and compressors {sorted(_UNPACK)} are read")

    @property
    def dims(self) -> list[str]:
        return self.attrs["_ARRAY_DIMENSIONS"]

    def path(self, key: tuple[int, ...]) -> str:
        return f"{self.name}/{self.separator.join(map(str, key)) or '0'}"

    def chunk(self, key: tuple[int, ...]) -> np.ndarray:
        """A chunk's part inside the array, missing values as NaN; a chunk without a file is missing throughout."""
        fs, inner = open_fs(self.root)
        data = _read(fs, f"{inner}/{self.path(key)}")
        if data is None:
            whole = np.full(self.chunks, np.nan if self.fill is None else self.fill, dtype=self.dtype if self.fill is not None else np.float64)
        else:
            if self.codec:
                data = _UNPACK[self.codec](data)
            whole = np.frombuffer(data, dtype=self.dtype).reshape(self.chunks)
        return whole[tuple(slice(0, min(c, n - k * c)) for k, c, n in zip(key, self.chunks, self.shape, strict=True))]

    def values(self) -> np.ndarray:
        """All of a coordinate."""
        parts = [self.chunk((k,)) for k in range(-(-self.shape[0] // self.chunks[0]))]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=self.dtype)

    def floats(self, key: tuple[int, ...]) -> np.ndarray:
        """A chunk in double precision: scaled as its attributes say, missing values as NaN."""
        raw = self.chunk(key)
        out = raw.astype(np.float64)
        for missing in {self.fill, self.attrs.get("_FillValue"), self.attrs.get("missing_value")} - {None}:
            out[raw == missing] = np.nan
        return out * self.attrs.get("scale_factor", 1.0) + self.attrs.get("add_offset", 0.0)


def days_of(values: np.ndarray, units: str) -> np.ndarray:
    """Days since 1970 of times such as "days since 1995-01-01", of the ordinary calendar."""
    unit, _, since = units.partition(" since ")
    per_day = {"days": 1, "day": 1, "hours": 24, "hour": 24, "minutes": 1440, "seconds": 86400}.get(unit.strip().lower())
    if per_day is None or not since:
        raise ValueError(f"times in {units!r} are not read")
    start = datetime.fromisoformat(since.strip().replace("T", " ").split(".")[0])
    offset = (start.date() - _EPOCH).days + (start - datetime(start.year, start.month, start.day)) / timedelta(days=1)
    return np.floor(values.astype(np.float64) / per_day + offset + 1e-9).astype(np.int64)


def wanted(filters: list[Filter], name: str, values: np.ndarray, plain=lambda v: v) -> np.ndarray:
    """Which coordinates the filters on a column allow; other filters allow all."""
    keep = np.ones(len(values), dtype=bool)
    for f in filters:
        if getattr(f, "attribute", None) != (name,):
            continue
        if isinstance(f, In):
            keep &= np.isin(values, [plain(v) for v in f.value if v is not None])
        elif isinstance(f, EqualTo):
            keep &= values == plain(f.value)
        elif isinstance(f, GreaterThan):
            keep &= values > plain(f.value)
        elif isinstance(f, GreaterThanOrEqual):
            keep &= values >= plain(f.value)
        elif isinstance(f, LessThan):
            keep &= values < plain(f.value)
        elif isinstance(f, LessThanOrEqual):
            keep &= values <= plain(f.value)
    return keep


def days_since_epoch(day: date) -> int:
    return (day - _EPOCH).days


@dataclass
class _Run(InputPartition):
    """Chunks first to last along time, at one place of the other axes."""

    first: int
    last: int
    y: int
    x: int


class _Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.variables = path, [n for n in schema.names if n not in ("location_id", "lon", "lat", "date")]
        self.names = schema.names
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> list[Filter]:
        """Filters choose chunks; Spark still applies them to rows."""
        self.filters = list(filters)
        return filters

    def _kept(self) -> list[np.ndarray]:
        time, lat, lon = (Array(self.path, n) for n in ("time", "lat", "lon"))
        return [wanted(self.filters, "date", days_of(time.values(), time.attrs["units"]), days_since_epoch), wanted(self.filters, "lat", lat.values()), wanted(self.filters, "lon", lon.values())]

    def partitions(self) -> list[_Run]:
        sizes = Array(self.path, self.variables[0]).chunks if self.variables else Array(self.path, _variables(self.path)[0]).chunks
        t, y, x = ([k for k in range(-(-len(kept) // size)) if kept[k * size : (k + 1) * size].any()] for kept, size in zip(self._kept(), sizes, strict=True))
        step = max(1, -(-len(t) * len(y) * len(x) // MOST_PARTITIONS))
        runs: list[tuple[int, int]] = []
        for k in t:
            if runs and k == runs[-1][1] + 1 and k - runs[-1][0] < step:
                runs[-1] = (runs[-1][0], k)
            else:
                runs.append((k, k))
        return [_Run(a, b, j, i) for a, b in runs for j in y for i in x]

    def read(self, partition: _Run | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing was planned
            return
        time, lat, lon = (Array(self.path, n) for n in ("time", "lat", "lon"))
        arrays = [Array(self.path, v) for v in self.variables]
        like = arrays[0] if arrays else Array(self.path, _variables(self.path)[0])
        days, lats, lons = days_of(time.values(), time.attrs["units"]), lat.values().astype(np.float64), lon.values().astype(np.float64)
        kept = self._kept()
        ct, cy, cx = like.chunks
        ys, xs = (np.arange(k * c, min(len(v), (k + 1) * c)) for k, c, v in ((partition.y, cy, lats), (partition.x, cx, lons)))
        ys_in, xs_in = ys[kept[1][ys]], xs[kept[2][xs]]
        cell = (ys_in[:, None] * len(lons) + xs_in).ravel()
        cell_lat, cell_lon = np.repeat(lats[ys_in], len(xs_in)), np.tile(lons[xs_in], len(ys_in))
        steps = max(1, BATCH_ROWS // max(1, len(cell)))
        for k in range(partition.first, partition.last + 1):
            ts = np.arange(k * ct, min(len(days), (k + 1) * ct))
            inside = ts[kept[0][ts]]
            blocks = [a.floats((k, partition.y, partition.x)) for a in arrays]
            for at in range(0, len(inside), steps):
                some = inside[at : at + steps]
                columns = {"location_id": np.tile(cell, len(some)), "lon": np.tile(cell_lon, len(some)), "lat": np.tile(cell_lat, len(some)), "date": np.repeat(days[some], len(cell)).astype(np.int32)}
                columns |= {v: b[np.ix_(some - k * ct, ys_in - partition.y * cy, xs_in - partition.x * cx)].ravel() for v, b in zip(self.variables, blocks, strict=True)}
                made = [pa.array(columns[n], from_pandas=True) for n in self.names]
                yield pa.RecordBatch.from_arrays([m.cast(pa.date32()) if n == "date" else m for n, m in zip(self.names, made, strict=True)], names=self.names)


def _variables(path: str) -> list[str]:
    """Names of the arrays that have three dimensions."""
    fs, inner = open_fs(path)
    if _read(fs, f"{inner}/.zgroup") is None:
        raise FileNotFoundError(f"{path} is no finished store")
    found = []
    for info in sorted(fs.get_file_info(pafs.FileSelector(inner)), key=lambda i: i.path):
        if info.type == pafs.FileType.Directory and (described := _read(fs, f"{info.path}/.zarray")) and len(json.loads(described)["shape"]) == 3:
            found.append(info.path.rstrip("/").rsplit("/", 1)[1])
    return found


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class _Writer(DataSourceArrowWriter):
    """Rows sorted by chunk: chunk_t, chunk_y, chunk_x, t, y, x, then the variables."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.chunks, self.shape = options["path"], json.loads(options["chunks"]), json.loads(options["shape"])
        self.codec, self.level = options["codec"], int(options["level"])
        self.variables = schema.names[6:]
        self.attempts = f"{self.path}/.attempts-{uuid.uuid4().hex}"
        self.metadata = options["metadata"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        fs, inner = open_fs(self.attempts)
        own, files = f"{inner}/{uuid.uuid4().hex}", []
        fs.create_dir(own, recursive=True)
        at: tuple[int, ...] | None = None
        blocks: list[np.ndarray] = []

        def flush() -> None:
            if at is None:
                return
            for name, block in zip(self.variables, blocks, strict=True):
                source = f"{own}/{name}-{'.'.join(map(str, at))}"
                with fs.open_output_stream(source) as stream:
                    stream.write(_PACK[self.codec](block.tobytes(), self.level))
                files.append((source, f"{name}/{'.'.join(map(str, at))}"))

        for batch in iterator:
            key = np.stack([batch.column(k).to_numpy() for k in range(3)])
            place = [batch.column(3 + k).to_numpy() % self.chunks[k] for k in range(3)]
            values = [batch.column(6 + k).to_numpy(zero_copy_only=False) for k in range(len(self.variables))]
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if a == b:
                    continue
                if (this := tuple(int(v) for v in key[:, a])) != at:
                    flush()
                    at, blocks = this, [np.full(self.chunks, np.nan) for _ in self.variables]
                for block, v in zip(blocks, values, strict=True):
                    block[tuple(p[a:b] for p in place)] = v[a:b].astype(np.float64)
        flush()
        return _Written(files)

    def commit(self, messages: list[_Written | None]) -> None:
        """Move what the successful tasks wrote to its place, drop the rest, and publish the metadata last."""
        fs, inner = open_fs(self.path)
        for name in self.variables:
            fs.create_dir(f"{inner}/{name}", recursive=True)
            fs.delete_dir_contents(f"{inner}/{name}")  # of an earlier commit that did not end
        moves = [m for x in messages if x is not None for m in x.files]
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(lambda m: fs.move(m[0], f"{inner}/{m[1]}"), moves))
        self._drop()
        publish(self.path, self.variables, self.chunks, self.shape, self.codec, self.level, json.loads(self.metadata))

    def abort(self, messages: list[_Written | None]) -> None:
        self._drop()

    def _drop(self) -> None:
        fs, inner = open_fs(self.attempts)
        if fs.get_file_info(inner).type == pafs.FileType.Directory:
            fs.delete_dir(inner)


def publish(path: str, variables: list[str], chunks: list[int], shape: list[int], codec: str, level: int, axes: dict) -> None:
    """Coordinates, then each array's description, then the group's: a store without the last is unfinished."""
    fs, inner = open_fs(path)

    def put(name: str, data: bytes) -> None:
        with fs.open_output_stream(f"{inner}/{name}") as stream:
            stream.write(data)

    told = lambda kind, n, c, packed, fill: json.dumps({"zarr_format": 2, "shape": n, "chunks": c, "dtype": kind, "compressor": packed, "fill_value": fill, "order": "C", "filters": None}).encode()
    for name, kind, values, attrs in (("time", "<i8", axes["time"], {"units": f"days since {_EPOCH}", "calendar": "proleptic_gregorian"}), ("lat", "<f8", axes["lat"], {"units": "degrees_north"}), ("lon", "<f8", axes["lon"], {"units": "degrees_east"})):
        fs.create_dir(f"{inner}/{name}", recursive=True)
        put(f"{name}/0", np.array(values, dtype=kind).tobytes())
        put(f"{name}/.zattrs", json.dumps({"_ARRAY_DIMENSIONS": [name], **attrs}).encode())
        put(f"{name}/.zarray", told(kind, [len(values)], [max(1, len(values))], None, None))
    for name in variables:
        put(f"{name}/.zattrs", json.dumps({"_ARRAY_DIMENSIONS": ["time", "lat", "lon"]}).encode())
        put(f"{name}/.zarray", told("<f8", shape, chunks, {"id": codec, "level": level}, "NaN"))
    put(".zattrs", b"{}")
    put(".zgroup", b'{"zarr_format": 2}')


class ZarrSource(DataSource):
    """location_id (row by row from the first latitude), lon, lat, date and the variables, missing values NULL.

    A schema given to the reader decides which variables are opened.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "location_id long, lon double, lat double, date date, " + ", ".join(f"`{v}` double" for v in _variables(self.options["path"]))

    def reader(self, schema: StructType) -> _Reader:
        _variables(self.options["path"])  # an unfinished store is refused
        return _Reader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options), schema)


def read_zarr(spark: SparkSession, path: str, variables: list[str] | None = None) -> DataFrame:
    """A store as a table; filters on date, lon and lat reach the choice of chunks. variables: only these are opened."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ZarrSource)
    reader = spark.read.format(FORMAT)
    if variables is not None:
        reader = reader.schema("location_id long, lon double, lat double, date date, " + ", ".join(f"`{v}` double" for v in variables))
    return reader.load(path)


def write_zarr(df: DataFrame, path: str, variables: list[str], chunks: tuple[int, int, int] = (365, 50, 50), codec: str = "zstd", level: int = 3) -> None:
    """Write lon, lat, date and variables as a new store of chunks (days, latitudes, longitudes).

    Axes are the distinct coordinates and the days from first to last, which the driver holds; missing cells and days are
    missing values, and chunks without any row have no file. A chunk's rows meet in one task: chunks times 8 bytes for
    each variable. Of rows with one place and day, one stays. A path that has a finished store is refused.
    """
    spark = df.sparkSession
    fs, inner = open_fs(path)
    if codec not in _PACK:
        raise ValueError(f"codec must be one of {sorted(_PACK)}")
    if fs.get_file_info(f"{inner}/.zgroup").type != pafs.FileType.NotFound:
        raise FileExistsError(path)
    spark.dataSource.register(ZarrSource)
    lats, lons = ([r[0] for r in df.select(c).distinct().orderBy(c).collect()] for c in ("lat", "lon"))
    first, last = df.agg(F.min("date"), F.max("date")).first()
    days = list(range(days_since_epoch(first), days_since_epoch(last) + 1)) if first else []
    shape = [len(days), len(lats), len(lons)]
    placed = df.select("lon", "lat", (F.datediff("date", F.lit(first)) if first else F.lit(0)).alias("t"), *variables)
    for c, name, values in (("lat", "y", lats), ("lon", "x", lons)):
        axis = spark.createDataFrame(list(zip(values, range(len(values)), strict=True)), f"{c} double, {name} int")
        placed = placed.join(F.broadcast(axis), c)  # an axis: thousands of numbers
    keys = [F.expr(f"cast({n} div {size} as int)").alias(f"chunk_{n}") for n, size in zip("tyx", chunks, strict=True)]
    names = [f"chunk_{n}" for n in "tyx"]
    dealt = placed.select(*keys, "t", "y", "x", *(F.col(v).cast("double").alias(v) for v in variables)).repartition(*names).sortWithinPartitions(*names)
    axes = json.dumps({"time": days, "lat": lats, "lon": lons})
    options = {"chunks": json.dumps(list(chunks)), "shape": json.dumps(shape), "codec": codec, "level": str(level), "metadata": axes}
    dealt.write.format(FORMAT).options(**options).mode("append").save(path)


def read_many(spark: SparkSession, stores: dict[str, str], variables: list[str] | None = None) -> DataFrame:
    """Several stores as one table, each under its simulation's code (sim_code); a filter on the code leaves out other stores."""
    parts = [read_zarr(spark, path, variables).select(F.lit(code).alias("sim_code"), "*") for code, path in stores.items()]
    return reduce(DataFrame.unionByName, parts)
