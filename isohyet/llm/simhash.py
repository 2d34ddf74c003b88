"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that differ in at most r bits agree on m - r of any m blocks of bits. Each choice of m - r blocks is a
table whose buckets share those bits; m grows with the number of distinct fingerprints so that buckets stay small, and
no pair is missed at any m. Inside a bucket the fingerprints' bits are stored as vertical planes, 64 fingerprints to a
word. A query adds the planes' differences to carry-save counters, so one word operation updates 64 distances, and a
block is abandoned once all its distances exceed the radius. Buckets emit one link per member to the least of its local
component, never all pairs.

For radii that no choice of blocks can serve, similar_documents() takes buckets from min-hash bands of the same shingles
and compares wider fingerprints in them in the same way, with a radius that loses no pair. What that connects are only
candidates: their texts are brought together and linked by the shingles that they share.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

RADIUS = 4
SHINGLE_WORDS = 4
SEED = 42
#: Words of 64 bits in a wide fingerprint, min-hash bands and rows of a band.
WIDE = 4
BANDS = 16
BAND_ROWS = 4
#: Expected fingerprints in a bucket up to which fewer tables are kept.
BUCKET = 64
#: In larger buckets all are compared with the first block, and then only what isn't in the largest component with all.
LARGE = 4096
#: Bits by which wide fingerprints of candidates may differ: at a similarity of 0.8 each bit does with a chance of at most
#: 0.16, or 0.19 for texts of up to SHORT distinct shingles, so that one pair in 500,000 at most is beyond.
CANDIDATE_RADIUS, SHORT_RADIUS, SHORT = 70, 84, 16
#: Distinct shingles of a component of candidates that are held at once, and in a block of a larger one.
HELD = 1 << 20
#: Rows of whole buckets that a task holds at once, more only if one bucket has more.
BATCH_ROWS = 1 << 19
_LANES = 64
_PAIRS = 1 << 18


def shingle_hashes(text: bytes, shingle_words: int) -> np.ndarray:
    """XXH64 of each shingle of words joined by blanks, repeats included; of fewer words, of them all; none without words."""
    words = text.lower().split()  # of bytes: A-Z only, and exactly \x20 and \x09-\x0D
    if not words:
        return np.empty(0, dtype="<u8")
    joined = b" ".join(words)
    hashed = xxhash.xxh64_intdigest
    if len(words) <= shingle_words:
        return np.array([hashed(joined, SEED)], dtype="<u8")
    ends = list(accumulate(map(len, words), lambda a, b: a + 1 + b))
    starts = [0, *(e + 1 for e in ends)]
    return np.array([hashed(joined[a:b], SEED) for a, b in zip(starts, ends[shingle_words - 1 :])], dtype="<u8")


def majority(hashes: np.ndarray) -> np.ndarray:
    """The 64-bit words whose bits are set in over half the rows; hashes: [shingle, word]."""
    counts = np.zeros(64 * hashes.shape[1], dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at : at + (1 << 16)])
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bit i is set if it is set in over half the hashes of the word shingles, repeats included; 0 without words."""
    return int(majority(shingle_hashes(text, shingle_words)[:, None])[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(x.as_py(), shingle_words) for x in common.utf8(batch.column(1)).cast(pa.large_binary())], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of whole texts; null texts are empty."""
    return docs.select(F.col("doc_id").cast("long"), common.text_or_empty().alias("text")).mapInArrow(partial(_fingerprints, shingle_words=shingle_words), "doc_id long, fp long")


def tables(n: int, radius: int) -> list[int]:
    """Masks of the bits that each table's buckets share, for n fingerprints."""
    for m in range(radius + 1, 65):
        kept = m - radius
        if n <= BUCKET << (64 * kept // m) or m == radius + 4:
            break
    edges = [64 * k // m for k in range(m + 1)]
    blocks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(blocks, kept)]


def _planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes of blocks of 64 fingerprints: [block, bit], lane k of a word is the block's k-th fingerprint."""
    n_blocks, words = -(-len(fps) // _LANES), fps.shape[1]
    padded = np.zeros((n_blocks * _LANES, words), dtype=np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(n_blocks, _LANES, 8 * words), axis=2, bitorder="little")
    return np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little").reshape(n_blocks, 64 * words, 8).copy().view(np.uint64)[:, :, 0]


def _within(fps: np.ndarray, planes: np.ndarray, query: np.ndarray, block: np.ndarray, lanes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of query i and lane j of its block within the radius, of the lanes asked for."""
    zero, ones = np.zeros(len(query), dtype=np.uint64), np.uint64((1 << 64) - 1)
    n_counters = radius.bit_length()
    counters, over = [zero.copy() for _ in range(n_counters)], zero.copy()
    limit = [ones if radius >> k & 1 else np.uint64(0) for k in range(n_counters)]

    def beyond() -> np.ndarray:
        more, equal = np.zeros_like(over), np.full_like(over, ones)
        for k in range(n_counters - 1, -1, -1):
            more |= equal & counters[k] & ~limit[k]
            equal &= ~(counters[k] ^ limit[k])
        return more | over

    for bit in range(planes.shape[1]):
        carry = planes[block, bit] ^ (np.uint64(0) - (fps[query, bit >> 6] >> np.uint64(bit & 63) & np.uint64(1)))
        for k in range(n_counters):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if bit % 8 == 7:
            alive = lanes & ~beyond()
            going = np.flatnonzero(alive)
            lanes = alive
            if len(going) < len(alive):  # abandon blocks whose distances all exceed the radius
                query, block, lanes, over = query[going], block[going], alive[going], over[going]
                counters = [c[going] for c in counters]
            if not len(going):
                break
    if not len(query):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at, lane = np.nonzero(np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return query[at], block[at] * _LANES + lane


Pairs = Iterator[tuple[np.ndarray, np.ndarray]]


def _compare(fps: np.ndarray, planes: np.ndarray, queries: np.ndarray, low: np.ndarray, high: np.ndarray, radius: int) -> Pairs:
    """Each query against fingerprints low to high - 1 of its own, a bounded number of blocks at a time."""
    ones = np.uint64((1 << 64) - 1)
    first = low // _LANES
    n = np.where(high > low, (high - 1) // _LANES - first + 1, 0)
    done = np.cumsum(n)
    at = 0
    while at < len(queries):
        to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + _PAIRS, "right")))
        own = n[at:to]
        which = np.repeat(np.arange(at, to), own)
        if len(which):
            block = np.arange(len(which)) - np.repeat(np.cumsum(own) - own, own) + first[which]
            begin = np.clip(low[which] - block * _LANES, 0, _LANES - 1).astype(np.uint64)
            end = np.clip(high[which] - block * _LANES, 1, _LANES).astype(np.uint64)
            yield _within(fps, planes, queries[which], block, (ones << begin) & (ones >> (np.uint64(_LANES) - end)), radius)
        at = to


def bucket_links(fps: np.ndarray, group: np.ndarray, radius: int) -> Pairs:
    """Index pairs within the radius that connect all such fingerprints of equal group; group must be sorted.

    All pairs of a group of up to LARGE. In a larger one, all are compared with the first block. What is then not in the
    largest component goes by its own bits where the radius leaves some to share (_by_own_bits); else it is compared with
    all. Pairs inside that component are already connected, so no component is lost.
    """
    n = len(fps)
    if n < 2:
        return
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, n])
    end = np.repeat(starts + sizes, sizes)
    planes = _planes(fps)
    queries = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= LARGE), sizes))
    yield from _compare(fps, planes, queries, queries + 1, end[queries], radius)
    for s, size in zip(starts[sizes > LARGE].tolist(), sizes[sizes > LARGE].tolist()):
        rows = np.arange(s, s + size)
        near = list(_compare(fps, planes, rows, np.full(size, s), np.full(size, s + _LANES), radius))
        yield from near
        root = _local_roots(size, ((i - s, j - s) for i, j in near))
        rest = rows[root != np.bincount(root).argmax()]
        if fps.shape[1] == 1 and radius <= 8 and len(rest) > LARGE:
            yield from ((rows[i], rows[j]) for i, j in _by_own_bits(fps[rows], radius))
        else:
            yield from _compare(fps, planes, rest, np.full(len(rest), s), np.full(len(rest), s + size), radius)


def _by_own_bits(fps: np.ndarray, radius: int) -> Pairs:
    """As bucket_links() for one large group of 64-bit fingerprints, in time that grows about with their number.

    Only bits that differ in the group count. They are cut into blocks, more than the radius: fingerprints within it have
    all but `radius` blocks alike, so for each choice of blocks they stand side by side in the order of those. Groups of
    equal blocks are compared, large ones by their own bits again, which are fewer.
    """
    varying = int(np.bitwise_or.reduce(fps[:, 0])) & ~int(np.bitwise_and.reduce(fps[:, 0]))
    bits = [b for b in range(64) if varying >> b & 1]
    n = len(fps)
    if len(bits) <= radius:  # all are within the radius
        yield np.arange(n - 1), np.arange(1, n)
        return
    for m in range(radius + 1, min(len(bits), radius + 4) + 1):
        kept = m - radius
        if n <= _LANES << (len(bits) * kept // m):
            break
    edges = [len(bits) * k // m for k in range(m + 1)]
    blocks = [sum(1 << b for b in bits[lo:hi]) for lo, hi in zip(edges, edges[1:])]
    for chosen in combinations(blocks, kept):
        key = fps[:, 0] & np.uint64(sum(chosen))
        order = np.argsort(key, kind="stable")
        yield from ((order[i], order[j]) for i, j in bucket_links(fps[order], key[order], radius))


def _local_roots(n: int, pairs: Pairs) -> np.ndarray:
    """Least index of each index's component."""
    root = np.arange(n)

    def up(x: np.ndarray) -> np.ndarray:
        while True:
            y = root[x]
            if np.array_equal(y, x):
                return x
            x = y

    for i, j in pairs:
        while len(i):
            a, b = up(i), up(j)
            apart = np.flatnonzero(a != b)
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
    return up(np.arange(n))


def _linked(bucket: np.ndarray, node: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node of its local component) of the buckets in a partition."""
    order = np.lexsort((node, bucket))
    bucket, node, fps = bucket[order], node[order], fps[order]
    shared = np.r_[False, bucket[1:] == bucket[:-1]]
    shared[:-1] |= shared[1:].copy()
    bucket, node, fps = bucket[shared], node[shared], fps[shared]
    values, place = np.unique(node, return_inverse=True)
    root = _local_roots(len(values), ((place[i], place[j]) for i, j in bucket_links(fps, bucket, radius)))
    moved = np.flatnonzero(root != np.arange(len(values)))
    return values[moved], values[root[moved]]


def _whole_buckets(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of rows that come in order of their first columns, cut where these change once BATCH_ROWS are held."""
    held: list[list[np.ndarray]] = []
    rows, most = 0, BATCH_ROWS
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        rows += batch.num_rows
        if rows >= most:
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            begin = int(np.logical_and.reduce([c == c[-1] for c in columns[:keys]]).argmax())  # of the last bucket
            if begin:
                yield [c[:begin] for c in columns]
            held, rows = [[c[begin:] for c in columns]], len(columns[0]) - begin
            most = max(BATCH_ROWS, 2 * rows)
    if rows:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


#: A node, ordered by the least id of its rows, nulls last, so that the least node of a component names the component.
_NODE = "struct<last:boolean,id:long,fp:long>"


def _link_tables(batches: Iterator[pa.RecordBatch], masks: list[int], radius: int) -> Iterator[pa.RecordBatch]:
    for table, _, fp, last, own in _whole_buckets(batches, 2):
        fps = fp.view(np.uint64)
        # should two buckets' numbers meet, they are compared as one, and distances decide as before
        bucket = (fps & np.array(masks, dtype=np.uint64)[table]) ^ (table.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        found = _linked(bucket, fp, fps[:, None], radius)
        order = np.argsort(fp, kind="stable")
        at = [order[np.searchsorted(fp, x, sorter=order)] for x in found]
        ends = [pa.StructArray.from_arrays([pa.array(last[k]), pa.array(own[k]), pa.array(fp[k])], names=["last", "id", "fp"]) for k in at]
        if len(at[0]):
            yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])


def link(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """From distinct fingerprints (column node): links (a, b) of nodes that connect all those within the radius of one another."""
    masks = tables(nodes.count(), radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    dealt = nodes.select("node.*").select("*", F.explode(F.array(*(F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(signed)))).alias("x"))
    return dealt.select("x.table", "x.key", "fp", "last", "id").repartition("table", "key").sortWithinPartitions("table", "key").mapInArrow(partial(_link_tables, masks=masks, radius=radius), f"a {_NODE}, b {_NODE}")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """A row per input row: doc_id, fp, component_id (the least doc_id of all reachable over links, itself included).

    Null and empty texts have fingerprint 0 and are linked like any other. Rows of one fingerprint are one node, so
    copies need no pairs. Rows with a null id count for links and get the component's least id, null if it has none.
    Repeated rows stay. Very long texts are hashed whole, a text at a time. An empty table gives no rows. Only doc_id
    and text are read; other columns have no effect.
    """
    marked = common.durable(fingerprints(docs, shingle_words))
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes = common.durable(nodes.select(F.struct(F.col("least").isNull().alias("last"), F.coalesce("least", F.lit(0)).alias("id"), "fp").alias("node")))
    rooted = _rooted(nodes, components(link(nodes, radius)))
    return marked.join(rooted.select(F.col("node.fp").alias("own"), "component_id"), F.col("fp") == F.col("own")).select("doc_id", "fp", "component_id")


def _rooted(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """node, root and component_id of all nodes: a root names its component, so no table of components is looked up."""
    moved = found.select(F.col("node").alias("moved"), "root")
    rooted = nodes.join(moved, F.col("node") == F.col("moved"), "left").select("node", F.coalesce("root", "node").alias("root"))
    return rooted.withColumn("component_id", F.when(~F.col("root.last"), F.col("root.id")))


# --- similar documents -----------------------------------------------------------------------------------------------


def _sketch(text: bytes, shingle_words: int) -> tuple[bytes, list[int]]:
    return _sketch_of(np.unique(shingle_hashes(text, shingle_words)))


def _sketch_of(hashes: np.ndarray) -> tuple[bytes, list[int]]:
    """From distinct shingles: a wide fingerprint and the keys of its buckets, min-hash bands and the fingerprint itself."""
    if not len(hashes):
        return bytes(8 * WIDE), [0]
    with np.errstate(over="ignore"):
        wide = [hashes]
        for k in range(1, WIDE):  # further words of each shingle's hash
            x = hashes ^ np.uint64(0x9E3779B97F4A7C15 * k & (1 << 64) - 1)
            x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
            wide.append(x ^ x >> np.uint64(31))
        found = majority(np.stack(wide, axis=1)).tobytes()
        # one permutation, a minimum in each of its bins; an empty bin takes that of the next one that isn't
        bins = BANDS * BAND_ROWS
        bin_of = (wide[1] >> np.uint64(58)).astype(np.int64) % bins
        least = np.full(bins, np.uint64((1 << 64) - 1))
        np.minimum.at(least, bin_of, wide[2])
        full = np.flatnonzero(np.bincount(bin_of, minlength=bins))
        least = least[full[np.searchsorted(full, np.arange(bins)) % len(full)]]
    bands = [xxhash.xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(least.reshape(BANDS, BAND_ROWS))]
    return found, [b - (1 << 64) if b >> 63 else b for b in (*bands, xxhash.xxh64_intdigest(found, BANDS))]


def _node(hashes: np.ndarray) -> tuple[int, int]:
    """The two halves of a 128-bit hash of a set of shingles, as signed longs."""
    node = xxhash.xxh3_128_intdigest(hashes.tobytes())
    return tuple(x - (1 << 64) if x >> 63 else x for x in (node & (1 << 64) - 1, node >> 64))


def text_key() -> Column:
    """128 bits that tell a text (null: empty)."""
    return F.unhex(F.md5(common.text_or_empty()))


def _sketches(batches: Iterator[pa.RecordBatch], shingle_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps, keys, nodes, sizes = [], [], [], []
        for x in common.utf8(batch.column(2)).cast(pa.large_binary()):
            hashes = np.unique(shingle_hashes(x.as_py(), shingle_words))
            fp, own = _sketch_of(hashes)
            fps.append(fp)
            keys.append(own)
            nodes.append(_node(hashes))
            sizes.append(len(hashes))
        columns = [batch.column(0), batch.column(1), pa.array([n for n, _ in nodes], pa.int64()), pa.array([m for _, m in nodes], pa.int64()), pa.array(sizes, pa.int64()), pa.array(fps, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "node_id", "more", "size", "fp", "bands"])
    common.give_back()


#: As _NODE, ties by the least hash of a text.
_TEXT_NODE = "struct<last:boolean,id:long,text_key:binary,node_id:long>"
_TEXT_NODE_ARROW = pa.struct([("last", pa.bool_()), ("id", pa.int64()), ("text_key", pa.binary()), ("node_id", pa.int64())])


def _link_bands(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for band, node, size, wide in _whole_buckets(batches, 1):
        fps = np.frombuffer(b"".join(wide.tolist()), dtype=np.uint64).reshape(-1, WIDE)
        # sizes of similar texts differ little, so each pair is in one of the two or in both
        for own, radius in ((size <= SHORT, SHORT_RADIUS), (size >= int(similarity * SHORT), CANDIDATE_RADIUS)):
            if own.any():
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _linked(band[own], node[own], fps[own], radius)], names=["a", "b"])
    common.give_back()


def _spread(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... n[0] of them, then those from begin[1], and so on."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)


def similar_pairs(group: np.ndarray, sets: list[np.ndarray], similarity: float) -> Pairs:
    """Index pairs that connect all sets of equal group whose intersection is that share of their union; group must be sorted.

    In each group 64 sets are compared with all, and then each that isn't in what was the largest component. Elements are
    ordered from rare to common in the group. Similar sets share at least ceil(similarity * size) elements, so one of them
    is among the first size - ceil(similarity * size) + 1 of each: only these are indexed, and what all have in common
    isn't. Sets that meet there are intersected.
    """
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(group)]):
        n, own = e - s, sizes[s:e]
        if n < 2:
            continue
        empty = s + np.flatnonzero(own == 0)
        if len(empty) > 1:
            yield empty[:-1], empty[1:]
        every, begin = np.concatenate(sets[s:e]), np.cumsum(own) - own
        _, name, times = np.unique(every, return_inverse=True, return_counts=True)
        rank = np.empty(len(times), dtype=np.int64)
        rank[np.argsort(times, kind="stable")] = np.arange(len(times))
        members, place = np.repeat(np.arange(n), own), rank[name]
        place = place[np.lexsort((place, members))]  # each set's own, from rare to common
        n_first = np.minimum(own, own - np.ceil(similarity * own - 1e-9).astype(np.int64) + 1)
        place = place[_spread(begin, n_first)]
        first_begin = np.cumsum(n_first) - n_first
        order = np.argsort(place, kind="stable")
        values, posting = place[order], np.repeat(np.arange(n), n_first)[order]
        root = np.arange(n)

        def compare(k: int) -> tuple[np.ndarray, np.ndarray] | None:
            mine, elements = place[first_begin[k] : first_begin[k] + n_first[k]], sets[s + k]
            low = np.searchsorted(values, mine, "left")
            met = np.unique(posting[_spread(low, np.searchsorted(values, mine, "right") - low)])
            met = met[(root[met] != root[k]) & (own[met] >= similarity * own[k] - 1e-9) & (own[k] >= similarity * own[met] - 1e-9)]
            if not len(met):
                return None
            others = every[_spread(begin[met], own[met])]
            at = np.minimum(np.searchsorted(elements, others), own[k] - 1)
            shared = np.add.reduceat((elements[at] == others).astype(np.int64), np.cumsum(own[met]) - own[met])
            near = met[shared >= similarity * (own[met] + own[k] - shared) - 1e-9]
            if not len(near):
                return None
            joined = np.unique(np.r_[root[near], root[k]])
            root[np.isin(root, joined)] = joined[0]
            return np.full(len(near), s + k), s + near

        main = 0
        for k in range(n):
            if k == _LANES:
                main = int(np.flatnonzero(root == np.bincount(root).argmax())[0])
            if k < _LANES or root[k] != root[main]:
                found = compare(k)
                if found:
                    yield found


def _confirm(batches: Iterator[pa.RecordBatch], shingle_words: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Links of similar texts in each block of candidates; rows come in order of blocks."""
    group: list[int] = []
    nodes: list[dict] = []
    sets: list[np.ndarray] = []
    key, held = None, 0

    def links() -> Iterator[pa.RecordBatch]:
        values = pa.array(nodes, _TEXT_NODE_ARROW)
        for i, j in similar_pairs(np.array(group, dtype=np.int64), sets, similarity):
            yield pa.RecordBatch.from_arrays([values.take(pa.array(i)), values.take(pa.array(j))], names=["a", "b"])

    for batch in batches:
        keys = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
        for own, node, x in zip(keys, batch.column(3).to_pylist(), common.utf8(batch.column(4)).cast(pa.large_binary()), strict=True):
            if own != key:
                if held >= HELD:
                    yield from links()
                    group, nodes, sets, held = [], [], [], 0
                key = own
                group.append(group[-1] + 1 if group else 0)
            else:
                group.append(group[-1])
            nodes.append(node)
            sets.append(np.unique(shingle_hashes(x.as_py(), shingle_words)))
            held += len(sets[-1])
    if nodes:
        yield from links()
    common.give_back()


def apart(marked: DataFrame) -> DataFrame:
    """node_id that tells sets of shingles by 128 bits: of sets that share 64, all but the first take their other 64.

    Of n sets n * n / 2**65 share one, so what is joined, and kept by every task, is none or a few rows at any real size.
    """
    sets = marked.select("node_id", "more").distinct()
    shared = common.durable(sets.groupBy("node_id").agg(F.min("more").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("node_id", "first"))
    if shared.isEmpty():
        return marked
    own = F.when(F.col("first").isNotNull() & (F.col("more") != F.col("first")), F.col("more")).otherwise(F.col("node_id"))
    return marked.join(F.broadcast(shared), "node_id", "left").withColumn("node_id", own).drop("first")


def similar_documents(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8) -> DataFrame:
    """A row per input row: doc_id, text_key, component_id, kept_id, kept_key, of documents linked when their shingles overlap enough.

    Similarity is the intersection of two texts' distinct shingles of words over their union. Candidates are compared where
    they share one of BANDS min-hash bands or a fingerprint of 256 bits: of texts that share 0.8 of their shingles all but
    about one in 5,000 do. The key of a text is its MD5 (128 bits). component_id is the least id of those linked; kept_id and kept_key
    are the id, nulls last, and text key of their first row, which tell components apart with or without ids. Inside a
    connected set of candidates links are exact; one of more than HELD shingles is compared block by block. The radii of
    candidates are for a similarity of 0.8 or more. Nulls, empty and very long texts, repeated rows, other columns and empty
    tables are treated as in near_duplicates().
    """
    if similarity < 0.8:
        raise ValueError("the radii of candidates need a similarity of 0.8 at least")
    rows = docs.select(F.col("doc_id").cast("long"), common.text_or_empty().alias("text")).select("doc_id", text_key().alias("text_key"), "text")
    marked = common.durable(rows.mapInArrow(partial(_sketches, shingle_words=shingle_words), "doc_id long, text_key binary, node_id long, more long, size long, fp binary, bands array<long>"))
    marked = apart(marked)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_key"))
    nodes = marked.groupBy("node_id").agg(least.alias("least"), F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    nodes = common.durable(nodes.select(F.struct("least.last", "least.id", "least.text_key", "node_id").alias("node"), "node_id", "size", "fp", "bands"))
    dealt = nodes.select("node_id", "size", "fp", F.explode("bands").alias("band")).repartition("band").select("band", "node_id", "size", "fp").sortWithinPartitions("band")
    candidates = components(dealt.mapInArrow(partial(_link_bands, similarity=similarity), "a long, b long"))
    groups = candidates.select(F.col("node").alias("node_id"), "root").unionByName(candidates.select(F.col("root").alias("node_id"), "root")).distinct()
    members = common.durable(nodes.select("node_id", "node", F.col("node.text_key").alias("text_key"), "size").join(groups, "node_id"))
    blocks = members.groupBy("root").agg(F.ceil(F.sum("size") / HELD).cast("int").alias("blocks"))
    texts = rows.groupBy("text_key").agg(F.first("text").alias("text"))  # copies are shuffled once a task
    own, other = F.expr("cast(pmod(node_id, blocks) as int)"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = texts.join(members.join(blocks, "root"), "text_key").withColumn("own", own).withColumn("other", other)
    placed = paired.select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "text")
    links = placed.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(partial(_confirm, shingle_words=shingle_words, similarity=similarity), f"a {_TEXT_NODE}, b {_TEXT_NODE}")
    rooted = _rooted(nodes.select("node"), components(links))
    kept = rooted.select(F.col("node.node_id").alias("own"), "component_id", F.when(~F.col("root.last"), F.col("root.id")).alias("kept_id"), F.col("root.text_key").alias("kept_key"))
    return marked.select("doc_id", "text_key", "node_id").join(kept, F.col("node_id") == F.col("own")).select("doc_id", "text_key", "component_id", "kept_id", "kept_key")


def op8_simhash_groups(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(common.documents(spark, sf_dir)).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
