"""Media columns in archives, read by a Spark data source that plans byte ranges.

Texts are stored as 8-bit greyscale PNG images, 64 samples a row, in uncompressed ZIP archives of bounded size. A
manifest, a table in the shared folder, tells each archive's place on one line of all members' bytes. The source cuts
that line into equal ranges, knowing only its length and the manifest's folder: the driver neither lists nor opens
archives. A partition looks up the archives of its range, reads their directories, takes the members that start in the
range, and streams their payloads as Arrow batches; a member that fails is read again by its offset, without touching
the others.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.dataset import dataset
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from . import common

ROW = 64
LEVEL = 1
ARCHIVE_BYTES = 64 << 20
RANGE_BYTES = 16 << 20
#: Ranges that are planned at most; beyond, they grow instead, and most archives are read by one task.
RANGES = 100_000
BATCH_BYTES = 8 << 20
ATTEMPTS = 3
_PNG = b"\x89PNG\r\n\x1a\n"


def padded(payload: bytes) -> bytes:
    """Zero bytes up to a positive multiple of the row."""
    return payload + bytes(-len(payload) % ROW if payload else ROW)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(samples: bytes) -> bytes:
    """An 8-bit greyscale image of whole rows, each stored without a filter."""
    height = len(samples) // ROW
    rows = np.zeros((height, ROW + 1), dtype=np.uint8)
    rows[:, 1:] = np.frombuffer(samples, dtype=np.uint8).reshape(height, ROW)
    return _PNG + _chunk(b"IHDR", struct.pack(">IIBBBBB", ROW, height, 8, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def from_png(image: bytes) -> bytes:
    """The samples; chunk checksums are held, and filters other than none are refused."""
    if image[:8] != _PNG:
        raise OSError("not a PNG image")
    at, data, width, height = 8, [], 0, 0
    while at < len(image):
        (n,), kind = struct.unpack(">I", image[at : at + 4]), image[at + 4 : at + 8]
        body = image[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != int.from_bytes(image[at + 8 + n : at + 12 + n], "big"):
            raise OSError("a chunk is damaged")
        if kind == b"IHDR":
            width, height, depth, colour = struct.unpack(">IIBB", body[:10])
            if (depth, colour) != (8, 0):
                raise ValueError("only 8-bit greyscale images are read")
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(b"".join(data)), dtype=np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("only unfiltered rows are read")
    return rows[:, 1:].tobytes()


def feature(samples: bytes) -> str:
    """Mean, spread and a 64-bit contour: for each of 64 equal stretches, whether its mean lies above the whole's."""
    x = np.frombuffer(samples, dtype=np.uint8)
    edges = len(x) * np.arange(65) // 64
    total = np.r_[0, np.cumsum(x, dtype=np.int64)]
    above = np.diff(total[edges]) * len(x) > np.diff(edges) * total[-1]
    return f"{total[-1] / len(x):.6f}:{x.std():.6f}:{np.packbits(above).tobytes().hex()}"


# --- writing ---------------------------------------------------------------------------------------------------------


class _Archive:
    """A ZIP file that opens with its first member and is streamed to its place."""

    def __init__(self, path: str):
        fs, inner = common.open_fs(path)
        self.path, self.stream, self.members = path, fs.open_output_stream(inner), 0
        self.zip = zipfile.ZipFile(_Tell(self.stream), "w", zipfile.ZIP_STORED, allowZip64=True)

    def add(self, name: str, data: bytes) -> None:
        self.zip.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), data)
        self.members += 1

    def size(self) -> int:
        return self.zip.fp.at

    def close(self) -> int:
        """Returns where the directory begins."""
        end = self.size()
        self.zip.close()
        self.stream.close()
        return end


class _Tell(io.RawIOBase):
    """A write-only stream that knows its place, as zipfile asks for."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0

    def writable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return False

    def write(self, data) -> int:
        self.stream.write(bytes(data))
        self.at += len(data)
        return len(data)

    def tell(self) -> int:
        return self.at

    def flush(self) -> None:
        pass


def _store(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    task, number, archive, done = TaskContext.get().partitionId(), 0, None, []
    for batch in batches:
        texts = common.utf8(batch.column(1)).cast(pa.large_binary())
        for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            if archive is None:  # a name for each attempt: the manifest decides which files count
                archive = _Archive(f"{folder}/media-{task:06d}-{len(done):04d}-{uuid.uuid4().hex}.zip")
            body = text.as_py()
            archive.add(f"{number}_{'null' if doc is None else doc}_{len(body)}.png", to_png(padded(body)))
            number += 1
            if archive.size() >= archive_bytes:
                done.append((archive.path, archive.members, archive.close()))
                archive = None
    if archive is not None:
        done.append((archive.path, archive.members, archive.close()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done]), *(pa.array([x[k] for x in done], pa.int64()) for k in (1, 2))], names=["path", "members", "bytes"])


def store(docs: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Store whole texts (null: empty) as images in archives under the folder; returns the manifest: path, members, bytes.

    bytes is the length of the archive's members, where its directory begins. Every row is a member by itself, repeated
    rows and null ids too; a very long text makes its archive that much larger. An empty table stores nothing. Only
    doc_id and text are read; other columns have no effect.
    """
    rows = docs.select(F.col("doc_id").cast("long"), common.text_or_empty().alias("text"))
    return common.durable(rows.mapInArrow(partial(_store, folder=folder, archive_bytes=archive_bytes), "path string, members long, bytes long"))


# --- reading ---------------------------------------------------------------------------------------------------------

_END, _END64, _MEMBER = struct.Struct("<4s4H2LH"), struct.Struct("<4sQ2H2L4Q"), struct.Struct("<4s6H3L5H2L")


def directory_place(file, size: int) -> tuple[int, int]:
    """Offset and size of a ZIP file's directory, from its end record."""
    tail_size = min(size, 66_000)
    file.seek(size - tail_size)
    tail = file.read(tail_size)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise OSError("no end record")
    *_, n, offset, _ = _END.unpack_from(tail, at)
    if offset == 0xFFFFFFFF or n == 0xFFFFFFFF or _END.unpack_from(tail, at)[4] == 0xFFFF:
        where = struct.unpack_from("<4sLQL", tail, at - 20)[2]
        file.seek(where)
        record = _END64.unpack(file.read(_END64.size))
        n, offset = record[8], record[9]
    return offset, n


def members(file, size: int) -> Iterator[tuple[str, int, int, int]]:
    """Name, offset of its header, size and checksum of each stored member, from the directory."""
    offset, n = directory_place(file, size)
    file.seek(offset)
    data, at = file.read(n), 0
    while at < len(data):
        x = _MEMBER.unpack_from(data, at)
        name_n, extra_n, note_n, crc, stored, start = x[10], x[11], x[12], x[7], x[9], x[16]
        name = data[at + 46 : at + 46 + name_n].decode()
        extra, k = data[at + 46 + name_n : at + 46 + name_n + extra_n], 0
        while k + 4 <= len(extra):
            kind, m = struct.unpack_from("<2H", extra, k)
            if kind == 1:
                wide = list(struct.unpack_from(f"<{m // 8}Q", extra, k + 4))
                if x[8] == 0xFFFFFFFF:
                    wide.pop(0)
                stored = wide.pop(0) if stored == 0xFFFFFFFF else stored
                start = wide.pop(0) if start == 0xFFFFFFFF else start
            k += 4 + m
        yield name, start, stored, crc
        at += 46 + name_n + extra_n + note_n


def read_member(open_file, start: int, stored: int, crc: int, attempts: int = ATTEMPTS) -> bytes:
    """One member's bytes by its offset; a failed or damaged read is tried again with a file opened anew."""
    for attempt in range(attempts):
        try:
            file = open_file(attempt > 0)
            file.seek(start + 26)
            name_n, extra_n = struct.unpack("<2H", file.read(4))
            file.seek(start + 30 + name_n + extra_n)
            data = file.read(stored)
            if len(data) != stored or zlib.crc32(data) != crc:
                raise OSError("the member is damaged")
            return data
        except (OSError, struct.error) as problem:
            if attempt + 1 == attempts:
                raise OSError(f"no member at {start}: {problem}") from problem
    raise AssertionError


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.manifest, self.total, self.step = options["manifest"], int(options["totalbytes"]), int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self) -> list[_Range]:
        """Equal ranges of the line of all members' bytes, RANGES of them at most."""
        step = max(self.step, -(-self.total // RANGES))
        return [_Range(low, min(self.total, low + step)) for low in range(0, self.total, step)] or [_Range(0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if partition.low == partition.high:
            return
        fs, folder = common.open_fs(self.manifest)
        own = (pc.field("first") < partition.high) & (pc.field("first") + pc.field("bytes") > partition.low)
        for row in dataset(folder, filesystem=fs, format="parquet").to_table(filter=own).to_pylist():
            yield from self._archive(row["path"], partition.low - row["first"], partition.high - row["first"])

    def _archive(self, path: str, low: int, high: int) -> Iterator[pa.RecordBatch]:
        fs, inner = common.open_fs(path)
        held = [fs.open_input_file(inner)]

        def open_file(anew: bool):
            if anew:
                held[0].close()
                held[0] = fs.open_input_file(inner)
            return held[0]

        names, offsets, payloads, size = [], [], [], 0
        for name, start, stored, crc in members(held[0], held[0].size()):
            if low <= start < high:
                names.append(name)
                offsets.append(start)
                payloads.append(read_member(open_file, start, stored, crc))
                size += stored
                if size >= BATCH_BYTES:
                    yield _payloads(path, names, offsets, payloads)
                    names, offsets, payloads, size = [], [], [], 0
        held[0].close()
        if names:
            yield _payloads(path, names, offsets, payloads)


def _payloads(path: str, names: list[str], offsets: list[int], payloads: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path] * len(names)), pa.array(names), pa.array(offsets, pa.int64()), pa.array(payloads, pa.binary())], names=["archive", "member", "offset", "media"])


class ArchiveSource(DataSource):
    """spark.read.format("archive_members") with options manifest (a Parquet folder: path, bytes, first), totalbytes and rangebytes."""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return "archive string, member string, offset long, media binary"

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = []
        for path in batch.column(0).to_pylist():
            fs, inner = common.open_fs(path)
            with fs.open_input_file(inner) as file:
                ends.append(directory_place(file, file.size())[0])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ends, pa.int64())], names=["path", "bytes"])


def manifest_of(paths: DataFrame) -> DataFrame:
    """The manifest of archives (column path) that others wrote: path, bytes, from their end records, read in parallel."""
    return common.durable(paths.select("path").mapInArrow(_measure, "path string, bytes long"))


def read_archives(spark: SparkSession, archives: DataFrame | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A row per member: archive, member, offset, media. archives: a manifest of store() or manifest_of(), or some paths.

    Repeated members stay; without archives there are no rows. A member that stays damaged after ATTEMPTS reads fails its
    task with its archive and offset, and no other.
    """
    spark.dataSource.register(ArchiveSource)
    if isinstance(archives, list):
        archives = manifest_of(spark.createDataFrame([(p,) for p in archives], "path string"))
    # a row for each archive: 1.6 million numbers for 100 TB in archives of 64 MB
    line = archives.filter("bytes > 0").select("path", "bytes", F.coalesce(F.sum("bytes").over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    folder = common.new_folder(spark, "manifest")
    line.write.mode("overwrite").parquet(folder)
    total = spark.read.schema(line.schema).parquet(folder).agg(F.sum("bytes")).first()[0] or 0  # one number
    return spark.read.format("archive_members").option("manifest", folder).option("totalbytes", str(total)).option("rangebytes", str(range_bytes)).load()


_DDL = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for name, image in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            _, doc, n = name.removesuffix(".png").split("_")
            samples = from_png(image)
            rows.append((None if doc == "null" else int(doc), int(n), len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-64:]), len(image), hashlib.sha256(image).hexdigest(), feature(samples)))
        if rows:
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[x.split(" ")[0] for x in _DDL.split(", ")])


def describe(media: DataFrame) -> DataFrame:
    """Digests and a feature of each stored image.

    Names carry the document's id (null allowed) and the length of its text, so empty, repeated and very long documents
    come back as they went in; no archive gives no rows. Only member and media are read.
    """
    return media.select("member", "media").mapInArrow(_describe, _DDL)


def op2_archived_media(spark, sf_dir: str) -> DataFrame:
    return describe(read_archives(spark, store(common.documents(spark, sf_dir), common.new_folder(spark, "media"))))
