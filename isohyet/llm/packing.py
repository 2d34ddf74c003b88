"""Harmonic packing of documents into fixed-capacity token sequences.

Lengths fall into reciprocal-capacity classes: a bin of class k holds exactly k documents' pieces of capacity // k
tokens. A document longer than its class is cut there and its rest is classed again, so every piece of a class has one
length, a bin's padding is capacity % k, and an offset follows from a piece's number alone. Each worker numbers the
pieces of each class by itself; the numbers become global by adding the counts of the workers before it, a table of
workers times classes. What does not fill a last bin of its class, fewer than k pieces in each of about
2 * sqrt(capacity) classes however large the input, is packed by first fit.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, tokens

CAPACITY = 4096
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("worker", pa.int32()), ("slot", pa.int64())])
_PIECES_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, worker int, slot long"


@lru_cache(maxsize=65536)
def cut(n: int, capacity: int) -> tuple[int, ...]:
    """Lengths of the pieces of a document of n tokens, each the exact length of its class."""
    out = [capacity] * (n // capacity)
    n %= capacity
    while n:
        piece = n if n * n <= capacity else capacity // -(-capacity // n)
        out.append(piece)
        n -= piece
    return tuple(out)


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, capacity: int) -> Iterator[pa.RecordBatch]:
    worker = TaskContext.get().partitionId()
    used: dict[int, int] = defaultdict(int)
    coder = tokens.encoder(vocabulary, 4)
    end = tokens.END_ID.to_bytes(4, "little")
    for batch in batches:
        rows: list[tuple] = []
        texts = common.utf8(batch.column(1))
        for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            view, start = memoryview(coder.encode(text.as_py()) + end), 0
            total = len(view) // 4
            for length in cut(total, capacity):
                rows.append((doc, start, length, zlib.crc32(view[4 * start : 4 * (start + length)]), total, worker, used[length]))
                used[length] += 1
                start += length
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECES.types, strict=True)] if rows else [pa.array([], t) for t in _PIECES.types], schema=_PIECES)


def _first_fit(table: pa.Table, capacity: int) -> pa.Table:
    """Bins for the few pieces that fill no bin of their class, longest first."""
    rows = sorted(table.to_pylist(), key=lambda r: (-r["length"], r["rank"]))
    room: list[int] = []
    first: dict[int, int] = {}
    for r in rows:
        n = r["length"]
        b = first.get(n, 0)
        while b < len(room) and room[b] < n:
            b += 1
        first[n] = b
        if b == len(room):
            room.append(capacity)
        r["bin"], r["offset"] = b, capacity - room[b]
        room[b] -= n
    return pa.Table.from_pylist(rows, schema=pa.schema([*table.schema, ("bin", pa.int64()), ("offset", pa.int64())]))


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are documents of the end id alone. Repeated rows are packed once each and null ids stay null.
    An empty table gives no rows. Only doc_id and text are read; other columns have no effect. A very long text is cut
    into pieces of whole sequences and a rest. Sequences are numbered from 0 without gaps; offsets in a sequence have no
    gaps either.
    """
    pieces = common.durable(docs.select(F.col("doc_id").cast("long"), common.text_or_empty().alias("text")).mapInArrow(partial(_pieces, vocabulary=vocabulary, capacity=capacity), _PIECES_DDL))
    counts = pieces.groupBy("length", "worker").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["base"])
    # a map of classes for each worker: workers have about as many pieces each, while a class may have most of them
    before = before.groupBy("worker").agg(F.map_from_entries(F.collect_list(F.struct("length", "base"))).alias("bases"))
    classes = counts.groupBy("length").agg(F.sum("n").alias("total")).withColumn("per", F.expr(f"{capacity} div length")).withColumn("bins", F.expr("total div per"))
    # as many rows as classes: about 2 * sqrt(capacity)
    classes = classes.withColumn("first_bin", F.sum("bins").over(Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["first_bin"]).withColumn("all_bins", F.sum("bins").over(Window.partitionBy()))
    ranked = pieces.join(before, "worker").join(F.broadcast(classes), "length").withColumn("rank", F.element_at("bases", F.col("length")) + F.col("slot"))
    whole = ranked.filter(F.col("rank") < F.col("bins") * F.col("per"))
    rest = ranked.filter(F.col("rank") >= F.col("bins") * F.col("per")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank", "all_bins")

    def fit(table: pa.Table) -> pa.Table:
        return _first_fit(table.drop_columns("group"), capacity)

    fitted = rest.withColumn("group", F.lit(0)).groupBy("group").applyInArrow(fit, f"{_PIECES_DDL.split(', worker')[0]}, rank long, all_bins long, bin long, offset long")
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    return whole.select(*key, (F.col("first_bin") + F.expr("rank div per")).alias("sequence_id"), (F.col("rank") % F.col("per") * F.col("length")).alias("offset")).unionByName(fitted.select(*key, (F.col("all_bins") + F.col("bin")).alias("sequence_id"), "offset"))


def op1_harmonic_packing(spark, sf_dir: str) -> DataFrame:
    return pack(common.documents(spark, sf_dir), tokens.vocabulary_path("word_bpe_49k.json"), CAPACITY)
