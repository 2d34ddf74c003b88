"""Shards cut from a Hilbert-curve order of several metadata dimensions.

Each dimension is quantised to a few bits, the cell's index along the Hilbert curve orders the rows, and runs of that
order are cut into shards. Neighbours on the curve are neighbours in every dimension, so each shard covers small ranges
of all of them and readers can skip shards by the usual file statistics. Only DataFrame functions are used.

The global row numbers need no global sort task: rows are range-partitioned by (curve index, id, hash) and sorted inside
partitions, and a row's number is its place in its partition plus the sizes of the partitions before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

SHARDS = 40
BITS = 6
_ROWS = 1 << 33  # of monotonically_increasing_id: ids in a partition


def hilbert_steps(dims: int) -> tuple[list[int], list[int]]:
    """For each state and cell corner, at state << dims | corner: the digit along the curve, and the next state.

    A state is an entry corner and a direction. The digit is the rank in Gray code order of the corner as seen from the
    state; entering the sub-cell turns the state by that digit's own entry and direction.
    """
    full = (1 << dims) - 1
    turn_left = lambda x, k: (x << k % dims | x >> dims - k % dims) & full
    gray = lambda w: w ^ w >> 1
    rank = {gray(w): w for w in range(full + 1)}
    trailing = lambda w: (~w & w + 1).bit_length() - 1  # noqa: E731  how many low bits are set
    digit, following = [], []
    for state in range((full + 1) * dims):
        entry, direction = divmod(state, dims)
        for corner in range(full + 1):
            w = rank[turn_left(corner ^ entry, dims - (direction + 1) % dims)]
            inner = gray(2 * ((w - 1) // 2)) if w else 0
            step = 0 if w == 0 else trailing(w - 1 if w % 2 == 0 else w) % dims
            digit.append(w)
            following.append((entry ^ turn_left(inner, direction + 1)) * dims + (direction + step + 1) % dims)
    return digit, following


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Index along the Hilbert curve of a cell given by one integer of so many bits for each dimension."""
    dims = len(cells)
    digit, following = hilbert_steps(dims)

    def corner(level: Column) -> Column:
        out = F.lit(0)
        for k, cell in enumerate(cells):
            out = out.bitwiseOR(F.call_function("shiftleft", F.call_function("shiftright", cell.cast("int"), level).bitwiseAND(F.lit(1)), F.lit(dims - 1 - k)))
        return out

    def step(acc: Column, level: Column) -> Column:
        at = acc["state"] * (1 << dims) + corner(level) + 1
        return F.struct(F.element_at(F.lit(following), at).alias("state"), (acc["index"] * (1 << dims) + F.element_at(F.lit(digit), at)).alias("index"))

    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index")), step, lambda acc: acc["index"])


def _ranked(rows: DataFrame, name: str, bits: int) -> DataFrame:
    """Add <name>_cell: the value's place among the distinct values (null last), scaled to the bits."""
    values = rows.select(F.col(name).alias("value")).distinct()
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("value").asc_nulls_last())) - 1
    values = values.select("value", F.floor(place * (1 << bits) / F.count(F.lit(1)).over(everything)).cast("int").alias(f"{name}_cell"))
    return rows.join(values, F.col(name).eqNullSafe(F.col("value"))).drop("value")


def shard_rows(docs: DataFrame, shards: int = SHARDS, law: str = "rows", bits: int = BITS) -> DataFrame:
    """A row per input row: doc_id, size (UTF-8 bytes + 16; null text: 16), text_crc32, curve, rank, shard, slot.

    law "rows": counts of shards differ by one at most. law "bytes": cuts fall at equal steps of the running size. Slots
    count from 0 in each shard without gaps, in curve order. The dimensions are source, lang, size (by powers of the
    square root of two) and doc_id. Null ids come first in ties and lie in the lowest cell; repeated rows take adjacent
    slots; an empty table gives no rows; other columns have no effect.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"unknown law: {law}")
    text = common.text_or_empty()
    base = common.durable(docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32")))
    ends = base.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    cells = _ranked(_ranked(base, "source", bits), "lang", bits).crossJoin(F.broadcast(ends))  # one row
    top = (1 << bits) - 1
    size_cell = F.least(F.lit(top), F.floor(F.log2("size") * 2)).cast("int")
    id_cell = F.coalesce(F.floor(F.try_divide((F.col("doc_id").cast("double") - F.col("low")) * top, F.col("high").cast("double") - F.col("low"))), F.lit(0)).cast("int")
    curve = cells.select("doc_id", "size", "text_crc32", hilbert_index([F.col("source_cell"), F.col("lang_cell"), size_cell, id_cell], bits).alias("curve"))
    key = ["curve", "doc_id", "text_crc32", "size"]
    laid = common.durable(curve.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("at", F.monotonically_increasing_id()))
    laid = laid.withColumn("part", F.expr(f"at div {_ROWS}")).withColumn("place", F.col("at") % _ROWS).drop("at")
    parts = laid.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("part_bytes"))
    before, everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("base_bytes"), F.sum("n").over(everything).alias("all_rows"), F.sum("part_bytes").over(everything).alias("all_bytes"))
    ranked = laid.join(parts, "part").withColumn("rank", F.col("base") + F.col("place"))
    if law == "rows":
        placed = ranked.withColumn("shard", F.expr(f"cast(rank * {shards} div all_rows as int)")).withColumn("slot", F.expr(f"rank - (shard * all_rows + {shards - 1}) div {shards}"))
    else:
        running = F.coalesce(F.sum("size").over(Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = ranked.withColumn("before_bytes", running + F.col("base_bytes")).withColumn("shard", F.expr(f"cast(before_bytes * {shards} div all_bytes as int)"))
        firsts = placed.groupBy("shard").agg(F.min("rank").alias("first"))
        placed = placed.join(firsts, "shard").withColumn("slot", F.col("rank") - F.col("first"))
    return placed.select("doc_id", "size", "text_crc32", "curve", "rank", "shard", F.col("slot").cast("long"))


def op6_hilbert_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_rows(common.documents(spark, sf_dir)).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")
