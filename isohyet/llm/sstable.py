"""Token-id shards as sorted-string tables.

A shard holds documents in ascending key order: prefix-compressed blocks, a sparse index with one entry per block, a
Bloom filter over the keys and a footer of fixed size. A lookup reads footer, index and filter once, finds the block by
binary search, the place in it by binary search over its restart points, and reads one block.

Layout: blocks | index | filter | footer. A block is entries, restart offsets (u32 each), their count (u32) and a crc32
of all that (u32). An entry is varints for shared key bytes, other key bytes and value bytes, then those bytes. A key is
the document id as 8 big-endian bytes with the sign bit flipped, so bytes sort as ids do; a null id is the empty key and
comes first. A value is the document's ids, little-endian, of the width that the footer names.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, tokens

MAGIC = b"ISSTv001"
FOOTER = struct.Struct("<QQQQQQB7x8s")
BLOCK_BYTES = 64 * 1024
RESTART_EVERY = 16
BLOOM_BITS_PER_KEY = 10
BLOOM_HASHES = 7


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else (doc_id + (1 << 63)).to_bytes(8, "big")


def id_of(key: bytes) -> int | None:
    return int.from_bytes(key, "big") - (1 << 63) if key else None


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: memoryview, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _bloom_bits(hashes: np.ndarray, n_bits: int) -> np.ndarray:
    """Bit numbers by double hashing, one row per key."""
    with np.errstate(over="ignore"):
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        return (hashes[:, None] + step[:, None] * np.arange(BLOOM_HASHES, dtype=np.uint64)) % np.uint64(n_bits)


class Writer:
    """Writes one shard to a stream; keys must come in ascending order (equal keys may repeat)."""

    def __init__(self, stream, width: int = 2):
        self.stream, self.width = stream, width
        self.at = self.entries = self.ids = 0
        self.block, self.restarts, self.last = bytearray(), [], b""
        self.first: bytes | None = None
        self.in_block = 0
        self.index: list[tuple[bytes, int, int]] = []
        self.hashes: list[int] = []

    def add(self, key: bytes, value: bytes) -> None:
        if self.entries and key < self.last:
            raise ValueError("keys must ascend")
        if self.in_block % RESTART_EVERY == 0:
            self.restarts.append(len(self.block))
            shared = 0
        else:
            shared = next((i for i, (a, b) in enumerate(zip(key, self.last)) if a != b), min(len(key), len(self.last)))
        if self.first is None:
            self.first = key
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.last = key
        self.in_block += 1
        self.entries += 1
        self.ids += len(value) // self.width
        self.hashes.append(xxhash.xxh3_64_intdigest(key))
        if len(self.block) >= BLOCK_BYTES:
            self._flush()

    def _flush(self) -> None:
        if not self.in_block:
            return
        data = bytes(self.block) + struct.pack(f"<{len(self.restarts)}II", *self.restarts, len(self.restarts))
        data += struct.pack("<I", zlib.crc32(data))
        self.index.append((self.first, self.at, len(data)))
        self.stream.write(data)
        self.at += len(data)
        self.block, self.restarts, self.first, self.in_block = bytearray(), [], None, 0

    def close(self) -> None:
        self._flush()
        index = b"".join(_varint(len(k)) + k + _varint(at) + _varint(n) for k, at, n in self.index)
        n_bits = max(64, BLOOM_BITS_PER_KEY * len(self.hashes))
        bits = np.zeros(n_bits, dtype=np.uint8)
        bits[_bloom_bits(np.array(self.hashes, dtype=np.uint64), n_bits).ravel()] = 1
        bloom = np.packbits(bits).tobytes()
        self.stream.write(index + bloom + FOOTER.pack(self.at, len(index), len(bloom), n_bits, self.entries, self.ids, self.width, MAGIC))


class Reader:
    """Reads one shard from a random-access file."""

    def __init__(self, file, size: int):
        self.file = file
        file.seek(size - FOOTER.size)
        index_at, index_n, bloom_n, self.n_bits, self.entries, self.ids, self.width, magic = FOOTER.unpack(file.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        file.seek(index_at)
        tail = file.read(index_n + bloom_n)
        data, at, self.index = memoryview(tail), 0, []
        while at < index_n:
            n, at = _read_varint(data, at)
            key, at = bytes(data[at : at + n]), at + n
            where, at = _read_varint(data, at)
            length, at = _read_varint(data, at)
            self.index.append((key, where, length))
        self.keys = [k for k, _, _ in self.index]
        self.bloom = np.frombuffer(tail, dtype=np.uint8, offset=index_n)

    def _block(self, k: int) -> tuple[memoryview, list[int]]:
        _, at, n = self.index[k]
        self.file.seek(at)
        data = self.file.read(n)
        if len(data) != n or zlib.crc32(data[:-4]) != int.from_bytes(data[-4:], "little"):
            raise OSError(f"block {k} is damaged")
        count = int.from_bytes(data[-8:-4], "little")
        return memoryview(data)[: n - 8 - 4 * count], list(struct.unpack(f"<{count}I", data[n - 8 - 4 * count : n - 8]))

    @staticmethod
    def _entries(data: memoryview, at: int = 0) -> Iterator[tuple[bytes, memoryview]]:
        key = b""
        while at < len(data):
            shared, at = _read_varint(data, at)
            own, at = _read_varint(data, at)
            n, at = _read_varint(data, at)
            key = key[:shared] + bytes(data[at : at + own])
            yield key, data[at + own : at + own + n]
            at += own + n

    def scan(self) -> Iterator[tuple[bytes, memoryview]]:
        for k in range(len(self.index)):
            yield from self._entries(self._block(k)[0])

    def may_have(self, key: bytes) -> bool:
        bits = _bloom_bits(np.array([xxhash.xxh3_64_intdigest(key)], dtype=np.uint64), self.n_bits)[0]
        return bool(np.all(self.bloom[bits >> np.uint64(3)] >> (np.uint64(7) - (bits & np.uint64(7))).astype(np.uint8) & 1))

    def get(self, key: bytes) -> np.ndarray | None:
        """The ids under a key (the first of equal keys), or None."""
        if not self.index or not self.may_have(key):
            return None
        for k in range(max(0, bisect_right(self.keys, key) - 1), -1, -1):
            if k and self.keys[k] == key:
                continue  # an equal key may already stand in the block before
            found = self._in_block(k, key)
            return found if found is not None or k + 1 >= len(self.keys) or self.keys[k + 1] != key else self._in_block(k + 1, key)
        return None

    def _in_block(self, k: int, key: bytes) -> np.ndarray | None:
        data, restarts = self._block(k)
        low, high = 0, len(restarts) - 1
        while low < high:  # the last restart whose key is smaller
            mid = (low + high + 1) // 2
            if next(self._entries(data, restarts[mid]))[0] < key:
                low = mid
            else:
                high = mid - 1
        for found, value in self._entries(data, restarts[low]):
            if found == key:
                return np.frombuffer(value, dtype=f"<u{self.width}")
            if found > key:
                return None
        return None


_MANIFEST_DDL = "shard int, path string, n_documents long, n_ids long"


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: str, width: int, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
    coder, end = tokens.encoder(vocabulary, width), tokens.END_ID.to_bytes(width, "little")
    for batch in batches:
        ids = [coder.encode(x.as_py()) + end for x in common.utf8(batch.column(2))]
        part = np.searchsorted(bounds, _place(batch.column(0).fill_null(-(1 << 63)).to_numpy(), batch.column(1).to_numpy()), "left")
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(part, pa.int32()), pa.array(ids, pa.binary())], names=["doc_id", "mark", "part", "ids"])


def _write(batches: Iterator[pa.RecordBatch], folder: str, width: int) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId()
    writer = stream = None
    # a name for each attempt: the manifest, which only successful tasks write, decides which file counts
    path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.sst"
    for batch in batches:
        for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if writer is None:
                fs, inner = common.open_fs(path)
                stream = fs.open_output_stream(inner)
                writer = Writer(stream, width)
            writer.add(key_of(doc), ids.as_py())
    if writer is not None:
        writer.close()
        stream.close()
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [path], "n_documents": [writer.entries], "n_ids": [writer.ids]})


#: Rows that are looked at for each shard where shards are cut.
SAMPLED_PER_SHARD = 40


def _place(doc_id: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Rows as (id, mark), in the order of shards; a null id is the least."""
    found = np.empty(len(doc_id), dtype=[("doc_id", "<i8"), ("mark", "<i8")])
    found["doc_id"], found["mark"] = doc_id, mark
    return found


def shard_bounds(docs: DataFrame, shards: int) -> np.ndarray:
    """(id, mark) where shards but the last end: quantiles of a sample whose size follows the number of shards.

    The driver holds SAMPLED_PER_SHARD ids a shard, whatever the rows are, and only ids are read. Marks are hashes, spread
    evenly, so any such numbers stand for them: rows of one id, or without one, are cut by the hash of their texts. A
    row's own place decides where it goes, so the sample decides the sizes of shards and nothing else.
    """
    if shards < 2:
        return _place(np.zeros(0), np.zeros(0))
    share = min(1.0, SAMPLED_PER_SHARD * shards / max(1, docs.count()))
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"))
    found = (own.sample(share, seed=1) if share < 1 else own).toArrow()["doc_id"].to_numpy()
    marks = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, size=len(found), dtype=np.int64, endpoint=False)
    places = np.sort(_place(found, marks), order=["doc_id", "mark"])
    return places[[len(places) * k // shards for k in range(1, shards)]] if len(places) else places


def write_shards(docs: DataFrame, folder: str, vocabulary: str, width: int = 2) -> DataFrame:
    """Encode whole texts and write them as shards in ascending doc_id order; returns the manifest, one row per shard.

    Null texts are empty; every document ends with the end id. Null ids come first, repeated ids stay side by side in
    order of a hash of their texts; a very long text is one entry, in a block of its own size. An empty table writes no
    shard. Only doc_id and text are read. The manifest: shard (ascending with the ids), path, n_documents, n_ids. There
    are as many shards as the input has partitions, cut at quantiles of a sample (shard_bounds); texts
    are encoded once, where they are read, and ids are shuffled, of `width` bytes each.
    """
    shards = docs.rdd.getNumPartitions()
    text = common.text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("mark"), text.alias("text"))
    bounds = shard_bounds(docs, shards)
    encoded = rows.mapInArrow(partial(_encode, vocabulary=vocabulary, width=width, bounds=bounds), "doc_id long, mark long, part int, ids binary")
    dealt = encoded.repartitionById(shards, F.col("part")).sortWithinPartitions("doc_id", "mark").select("doc_id", "ids")
    return common.durable(dealt.mapInArrow(partial(_write, folder=folder, width=width), _MANIFEST_DDL))


_READ_DDL = "doc_id long, start long, n_tokens long, ids_crc32 long, shard int"
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("shard", pa.int32())])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            fs, inner = common.open_fs(row["path"])
            with fs.open_input_file(inner) as file:
                start, rows = row["first_id"], []
                for key, value in (reader := Reader(file, file.size())).scan():
                    ids = np.frombuffer(value, dtype=f"<u{reader.width}")
                    rows.append((id_of(key), start, len(ids), zlib.crc32(ids.astype("<u4")), row["shard"]))
                    start += len(ids)
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _READ.types, strict=True)], schema=_READ)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _READ.types, strict=True)], schema=_READ)


def read_shards(manifest: DataFrame) -> DataFrame:
    """A row per stored document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, shard.

    Shards are read whole, in parallel; each knows where its ids begin from the manifest's counts (one row per shard).
    """
    firsts = manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return common.spread(firsts.select("shard", "path", "first_id"), manifest.rdd.getNumPartitions(), "shard").mapInArrow(_read, _READ_DDL)


def op9_token_shards(spark, sf_dir: str) -> DataFrame:
    folder = common.new_folder(spark, "token-shards")
    return read_shards(write_shards(common.documents(spark, sf_dir), folder, tokens.vocabulary_path("word_bpe_49k.json")))
