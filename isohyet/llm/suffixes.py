"""Removal of byte strings that occur earlier in the corpus, by a sparse hash-compared suffix sort.

Every window of WINDOW bytes has one anchor: the leftmost of its GRAM-byte strings with the least hash. Equal windows
have equal anchors at equal offsets, so only suffixes at anchors need sorting, about one in 39 positions.

1. Each staged file finds its anchors, once, from prefix polynomial hashes. An anchor's context is the union of the
   windows that it anchors. Contexts that repeat inside the file keep their first occurrence; the others are repeats.
2. Anchors are grouped by their string's hash. Occurrences with equal contexts keep the first again. Anchors that stand
   in one context only are done; where contexts differ, their bytes are fetched.
3. Those suffixes are sorted by merging, to the right of the anchor and, reversed, to its left. Two suffixes are compared
   by the longest common extension, found by binary search over prefix hashes, and neighbours in the finished order are
   compared byte by byte, so a hash collision can't pass here. Windows are equal where both extensions reach far enough.
4. Each file applies the intervals found for it.

Texts are staged once as Parquet in the shared folder and never shuffled; what is shuffled is about 38 bytes for each
anchor, packed by file and bucket.

No task gathers what grows with the corpus (Limits). A file gives at most 128 different contexts of an anchor from each
of its pieces to the anchor's group; more of them are dealt by their own hash, and the group is told. Groups take
1024 files each; where there are more files, what is left of each group meets in a second grouping, again at most
128 of an anchor from each. An anchor that was told of, or that has more than 16,384 contexts after all, is hot:
each window of its contexts is then dealt by its own hash, and of equal windows the first stays. So what is hot is
decided on counts of the anchor itself, at any size of corpus.

Contexts that repeat whole (steps 1 and 2) are told equal by 96 bits of two hashes of the context with different
multipliers and letters, windows of hot anchors by 128 such bits. With n of them about n * n / 2**97 (2**129) are taken
for equal wrongly: 4e-5 for the 2.5e12 contexts of 100 TB. Comparing their bytes would shuffle all repeated text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import common

WINDOW = 100
GRAM = 24
#: Bytes of text handled at once by the vectorised steps; longer texts are cut with an overlap.
CHUNK = 1 << 19
#: Bytes of a batch of a staged file, about; a text is never split here.
BATCH_BYTES = 4 << 20
#: Expected anchors in a bucket.
PER_BUCKET = 250_000
#: Anchors of a file that are held at once; a larger file has several such pieces.
PIECE = 1 << 20
#: Suffixes sorted at once, if no single anchor has more.
SLICE = 16_384
#: Windows of hot anchors that a file holds at once.
HELD_WINDOWS = 1 << 20
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
_PLACE = (1 << 24) - 1
_NONE = np.uint32(0xFFFFFFFF)
_ANCHOR = np.dtype([("h", "<u8"), ("ctx", "<u8"), ("check", "<u4"), ("doc", "<i8"), ("row", "<u4"), ("lo", "<u4"), ("off", "u1"), ("len", "u1")])
_SPAN = np.dtype([("row", "<u4"), ("lo", "<u4"), ("len", "u1")])
_EDGE = np.dtype([("h", "<u8"), ("doc", "<i8"), ("file", "<u4"), ("row", "<u4"), ("lo", "<u4"), ("off", "u1"), ("len", "u1")])
_WINDOW = np.dtype([("a", "<u8"), ("b", "<u8"), ("doc", "<i8"), ("row", "<u4"), ("lo", "<u4")])
#: Kinds of blobs: spans of repeats, contexts by their anchor, contexts by themselves, hashes of hot anchors. Contexts are
#: records of anchors on the way in; on the way out they are edges, to be sorted or to be dealt by windows.
_SPANS, _SORTED, _DEALT, _HOT = 0, 1, 2, 3
#: What goes on to the second grouping, where there is one.
_ON, _HOT_ON = 4, 5


class Limits(NamedTuple):
    """What one task takes of one anchor; they decide ways, not results."""

    #: Different contexts that a piece of a file, or a group of files, gives to one task.
    given: int = 128
    #: Suffixes that are sorted; of an anchor with more each window is dealt.
    sorted: int = 16_384
    #: Files whose anchors meet in one grouping.
    files: int = 1024


#: Null ids come after all others.
NULL_ID = (1 << 63) - 1


@lru_cache(maxsize=4)
def _powers(multiplier: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up, down = np.full(n, multiplier, dtype=np.uint64), np.full(n, pow(multiplier, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


@lru_cache(maxsize=4)
def _letters(multiplier: int) -> np.ndarray:
    return np.random.default_rng(multiplier % (1 << 32)).integers(1, 1 << 64, 256, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


# --- anchors ---------------------------------------------------------------------------------------------------------


def anchors(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of segments laid end to end: hash of each anchor, hash of its context, place, first and last window start."""
    n, windows = len(text), len(text) - WINDOW + 1
    empty = np.empty(0, np.int64)
    if windows <= 0:
        return (empty.astype(np.uint64),) * 2 + (empty,) * 3
    up, down = _powers(_MULTIPLIERS[0], CHUNK * 2 if n <= CHUNK * 2 else n)
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_letters(_MULTIPLIERS[0])[text] * up[:n], out=prefix[1:])
        gram = (prefix[GRAM:] - prefix[:-GRAM]) * down[: n - GRAM + 1]
        gram = _mix(gram)
        least = gram & ~np.uint64(_PLACE) | np.arange(len(gram), dtype=np.uint64)
        width, span = 1, WINDOW - GRAM + 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: windows], least[span - width : span - width + windows])
        at = (least & np.uint64(_PLACE)).astype(np.uint32)
        begin = 0
        for end in ends.tolist():  # windows that would cross into the next segment
            at[max(begin, end - WINDOW + 1) : end] = _NONE
            begin = end
        first = np.r_[0, np.flatnonzero(at[1:] != at[:-1]) + 1]
        last = np.r_[first[1:], windows] - 1
        place = at[first]
        real = place != _NONE
        first, last, place = first[real], last[real], place[real].astype(np.int64)
        context = (prefix[last + WINDOW] - prefix[first]) * down[first]
        context = _mix(context ^ _mix(((place - first) << 8 | last - first).astype(np.uint64) + np.uint64(0x51ED2701)))
        return gram[place], context, place, first, last


def stretch_hash(text: np.ndarray, start: np.ndarray, end: np.ndarray, multiplier: int) -> np.ndarray:
    """64-bit polynomial hashes of stretches of a text."""
    n = len(text)
    up, down = _powers(multiplier, max(CHUNK * 2, n))
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_letters(multiplier)[text] * up[:n], out=prefix[1:])
        return _mix((prefix[end] - prefix[start]) * down[start])


def _rows(path: str, columns: list[str] | None = None) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches of a staged file, each with the number of its first row; of fewer rows where texts are long."""
    fs, inner = common.open_fs(path)
    with fs.open_input_file(inner) as file:
        parquet, at = pq.ParquetFile(file), 0
        for k in range(parquet.num_row_groups):
            group = parquet.metadata.row_group(k)
            n = max(1, min(2048, BATCH_BYTES * group.num_rows // max(1, group.total_byte_size)))
            for batch in parquet.iter_batches(batch_size=n, row_groups=[k], columns=columns):
                yield at, batch
                at += batch.num_rows


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column laid end to end, and where each text begins, with the end of the last."""
    strings = common.utf8(column)
    offsets = np.frombuffer(strings.buffers()[1], dtype=np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.empty(0, np.uint8)), offsets - offsets[0]


def _file_anchors(path: str) -> Iterator[np.ndarray]:
    """A file's anchors in order of rows and places, in pieces of about PIECE."""
    found: list[np.ndarray] = []

    def take(parts: list[np.ndarray], segments: list[tuple[int, int]], docs: list[int]) -> None:
        if not parts:
            return
        ends = np.cumsum([len(p) for p in parts])
        text = np.concatenate(parts)
        h, ctx, place, first, last = anchors(text, ends)
        segment = np.searchsorted(ends, first, "right")
        out = np.empty(len(h), dtype=_ANCHOR)
        rows, bases = np.array(segments, dtype=np.int64).T
        out["h"], out["ctx"], out["doc"], out["row"] = h, ctx, np.array(docs, dtype=np.int64)[segment], rows[segment]
        out["check"] = stretch_hash(text, first, last + WINDOW, _MULTIPLIERS[1]) >> np.uint64(32) if len(h) else 0
        out["lo"], out["off"], out["len"] = first - np.r_[0, ends][segment] + bases[segment], place - first, last - first
        found.append(out)

    parts, segments, docs, size = [], [], [], 0
    for at, batch in _rows(path, ["doc_id", "text"]):
        ids = batch.column("doc_id").fill_null(NULL_ID).to_numpy()
        text, offsets = _buffers(batch.column("text"))
        for k in np.flatnonzero(np.diff(offsets) >= WINDOW).tolist():
            whole = text[offsets[k] : offsets[k + 1]]
            for base in range(0, len(whole) - WINDOW + 1, CHUNK):
                part = whole[base : base + CHUNK + WINDOW - 1]
                parts.append(part)
                segments.append((at + k, base))
                docs.append(ids[k])
                size += len(part)
                if size >= CHUNK:
                    take(parts, segments, docs)
                    parts, segments, docs, size = [], [], [], 0
                    if sum(map(len, found)) >= PIECE:
                        piece = np.concatenate(found)
                        found.clear()
                        yield piece
    take(parts, segments, docs)
    if found:
        yield np.concatenate(found)


def _spans(records: np.ndarray) -> np.ndarray:
    """As spans of window starts."""
    out = np.empty(len(records), dtype=_SPAN)
    for name in _SPAN.names:
        out[name] = records[name]
    return out


def _runs(file: np.ndarray, records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Single windows as spans of consecutive ones, each with its file."""
    order = np.lexsort((records["lo"], records["row"], file))
    file, row, lo = file[order], records["row"][order], records["lo"][order].astype(np.int64)
    n = len(order)
    new = np.ones(n, dtype=bool)
    new[1:] = (file[1:] != file[:-1]) | (row[1:] != row[:-1]) | (lo[1:] != lo[:-1] + 1)
    begin = np.flatnonzero(new)
    new |= (np.arange(n) - np.repeat(begin, np.diff(np.r_[begin, n]))) % 256 == 0  # a length is one byte
    begin = np.flatnonzero(new)
    out = np.empty(len(begin), dtype=_SPAN)
    out["row"], out["lo"], out["len"] = row[begin], lo[begin], np.diff(np.r_[begin, n]) - 1
    return file[begin], out


def _once(x: np.ndarray, *keys: str) -> tuple[np.ndarray, np.ndarray]:
    """The first of the records that agree in all keys, in order of documents, rows and places; and the others."""
    x = x[np.lexsort((x["lo"], x["row"], x["doc"]))] if len(x) and (np.diff(x["doc"]) < 0).any() else x
    order = np.argsort(x[keys[0]], kind="stable")
    equal = np.ones(max(0, len(x) - 1), dtype=bool)
    for key in keys:
        ordered = x[key][order]
        equal &= ordered[1:] == ordered[:-1]
    same = np.zeros(len(x), dtype=bool)
    same[order[1:]] = equal
    return x[~same], x[same]


_CONTEXT = ("ctx", "check", "h")


def _pack(records: np.ndarray, keys: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Records by bucket of their key, each packed by column, which compresses better."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    for b, own in zip(names.tolist(), np.split(order, first[1:]) if len(names) else []):
        part = records[own]
        yield b, b"".join(np.ascontiguousarray(part[c]).tobytes() for c in records.dtype.names) if records.dtype.names else part.tobytes()


_FOUND_DDL = "bucket int, file int, kind int, blob binary, files binary"


def _found(rows: list[tuple[int, int, int, bytes]], onward: Iterable[tuple[int, int, int, bytes, bytes]] = ()) -> pa.RecordBatch:
    """Rows of one file each, and what goes on to the second grouping, of many files: files tells that of each record."""
    every = [*((*row, None) for row in rows), *onward]
    columns = zip(*every, strict=True) if every else ((), (), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "file", "kind", "blob", "files"])


def _anchor_job(batches: Iterator[pa.RecordBatch], name: str, buckets: int, limits: Limits) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file in batch.column(0).to_pylist():
            for x in _file_anchors(_path(name, file)):
                x, repeats = _once(x, *_CONTEXT)
                h, which, n = np.unique(x["h"], return_inverse=True, return_counts=True)
                many = n > limits.given
                rows = [(file % buckets, file, _SPANS, _spans(repeats).tobytes())]
                rows += [(b, file, _HOT, blob) for b, blob in _pack(h[many], h[many], buckets)]
                for kind, records, key in ((_SORTED, x[~many[which]], "h"), (_DEALT, x[many[which]], "ctx")):
                    rows += [(b, file, kind, blob) for b, blob in _pack(records, records[key], buckets)]
                yield _found(rows)
                del x, repeats, h, which, rows, records
            _give_back()


def _path(name: str, file: int) -> str:
    """Staged files differ in their number only."""
    return name.replace("*", f"{file:05d}", 1)


def _unpack(blob: bytes, dtype: np.dtype) -> np.ndarray:
    n, at = len(blob) // dtype.itemsize, 0
    out = np.empty(n, dtype=dtype)
    for name in dtype.names:
        kind = dtype[name]
        out[name] = np.frombuffer(blob, dtype=kind, count=n, offset=at)
        at += n * kind.itemsize
    return out


def _by_file(files: np.ndarray, records: np.ndarray, kind: int) -> Iterator[tuple[int, int, int, bytes]]:
    order = np.argsort(files, kind="stable")
    files, records = files[order], records[order]
    cuts = np.flatnonzero(np.r_[True, files[1:] != files[:-1], True]) if len(files) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield 0, int(files[a]), kind, records[a:b].tobytes()


def _give_back() -> None:
    _powers.cache_clear()
    common.give_back()


def _edges(records: np.ndarray, files: np.ndarray) -> np.ndarray:
    out = np.empty(len(records), dtype=_EDGE)
    for name in _EDGE.names:
        out[name] = files if name == "file" else records[name]
    return out


def _group_anchors(batches: Iterator[pa.RecordBatch], last: bool, limits: Limits, buckets: int = 1) -> Iterator[pa.RecordBatch]:
    """Of a bucket's anchors: spans of repeats, edges of contexts that must be compared, and what goes on to the next grouping.

    buckets: how many that grouping has; a row that goes on to one of them carries the anchors of all files of this group.
    """
    rows: list[tuple[int, int, int, bytes]] = []
    onward: list[tuple[int, int, int, bytes, bytes]] = []
    parts: dict[int, list[np.ndarray]] = {_SORTED: [], _DEALT: []}
    files: dict[int, list[np.ndarray]] = {_SORTED: [], _DEALT: []}
    told = [np.empty(0, dtype="<u8")]
    for batch in batches:
        for file, kind, blob, whose in zip(*(batch.column(c).to_pylist() for c in ("file", "kind", "blob", "files")), strict=True):
            if kind == _SPANS:
                if blob:
                    rows.append((0, file, _SPANS, blob))
            elif kind in (_HOT, _HOT_ON):
                told.append(np.frombuffer(blob, dtype="<u8"))
            else:
                own = _unpack(blob, _ANCHOR)
                files[_SORTED if kind == _ON else kind].append(np.frombuffer(whose, dtype="<u4").astype(np.int64) if kind == _ON else np.full(len(own), file, dtype=np.int64))
                parts[_SORTED if kind == _ON else kind].append(own)
    hot = np.unique(np.concatenate(told))
    again = [np.empty(0, dtype="<u8")]
    for kind in (_DEALT, _SORTED):
        if not parts[kind]:
            continue
        x, file = np.concatenate(parts[kind]), np.concatenate(files[kind])
        order = np.lexsort((x["row"], file, x["lo"], x["doc"], x["check"], x["ctx"], x["h"]))
        x, file = x[order], file[order]
        new_h = np.r_[True, x["h"][1:] != x["h"][:-1]]
        new = new_h | np.r_[True, (x["ctx"][1:] != x["ctx"][:-1]) | (x["check"][1:] != x["check"][:-1])]
        rows += _by_file(file[~new], _spans(x[~new]), _SPANS)
        group = (np.cumsum(new_h) - 1)[new]
        x, file, n = x[new], file[new], np.bincount(group)[group]
        if kind == _DEALT:
            rows += _by_file(file, _edges(x, file), _DEALT)
            continue
        dealt = np.isin(x["h"], hot) | (n > (limits.sorted if last else limits.given))
        rows += _by_file(file[dealt], _edges(x, file)[dealt], _DEALT)
        if last:
            rows += _by_file(file[~dealt & (n > 1)], _edges(x, file)[~dealt & (n > 1)], _SORTED)
        else:
            keys, whose = x["h"][~dealt], file[~dealt].astype("<u4")
            onward += [(b, 0, _ON, blob, own) for (b, blob), (_, own) in zip(_pack(x[~dealt], keys, buckets), _pack(whose, keys, buckets), strict=True)]
            again.append(np.unique(x["h"][dealt]))
    if not last and len(hot := np.unique(np.concatenate([hot, *again]))):
        rows += [(b, 0, _HOT_ON, blob) for b, blob in _pack(hot.astype("<u8"), hot, buckets)]
    yield _found(rows, onward)
    _give_back()


# --- contexts --------------------------------------------------------------------------------------------------------


_CONTEXT_DDL = "bucket int, kind int, head binary, body binary"


def _context_rows(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "kind", "head", "body"])


def _windows_of(edges: np.ndarray, contexts: list[bytes]) -> np.ndarray:
    """Both hashes of every window of the contexts."""
    n = edges["len"].astype(np.int64) + 1
    text = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    begin = np.cumsum(n + WINDOW - 1) - (n + WINDOW - 1)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = np.repeat(begin, n) + step
    out = np.empty(len(step), dtype=_WINDOW)
    out["a"], out["b"] = (stretch_hash(text, start, start + WINDOW, m) for m in _MULTIPLIERS[:2])
    for name in ("doc", "row"):
        out[name] = np.repeat(edges[name], n)
    out["lo"] = np.repeat(edges["lo"], n) + step
    return out


def _context_job(batches: Iterator[pa.RecordBatch], name: str, buckets: int) -> Iterator[pa.RecordBatch]:
    """Of a file's open anchors: contexts packed by bucket, and windows of hot ones, of equal windows the first."""
    file, parts = 0, {_SORTED: [np.empty(0, dtype=_EDGE)], _DEALT: [np.empty(0, dtype=_EDGE)]}
    for batch in batches:
        for file, kind, blob in zip(*(batch.column(c).to_pylist() for c in ("file", "kind", "blob")), strict=True):
            parts[kind].append(np.frombuffer(blob, dtype=_EDGE))
    edges = {kind: np.concatenate(x) for kind, x in parts.items()}
    edges = {kind: x[np.argsort(x["row"], kind="stable")] for kind, x in edges.items()}
    contexts: list[bytes] = []
    windows: list[np.ndarray] = []

    def deal() -> pa.RecordBatch:
        x, repeats = _once(np.concatenate(windows), "a", "b")
        windows.clear()
        spans = _runs(np.zeros(len(repeats), dtype=np.int64), repeats)[1]
        number = np.uint32(file).tobytes()
        return _context_rows([(file % buckets, _SPANS, number, spans.tobytes()), *((b, _DEALT, number, blob) for b, blob in _pack(x, x["a"], buckets))])

    for at, batch in _rows(_path(name, file), ["text"]):
        text, offsets = _buffers(batch.column("text"))
        view = memoryview(text)
        for kind, own in edges.items():
            low, high = np.searchsorted(own["row"], [at, at + batch.num_rows])
            for a in range(low, high, 4096):
                part = own[a : min(high, a + 4096)]
                begin = offsets[part["row"] - at] + part["lo"].astype(np.int64)
                found = [bytes(view[p:q]) for p, q in zip(begin.tolist(), (begin + part["len"] + WINDOW).tolist())]
                if kind == _SORTED:
                    contexts += found
                else:
                    windows.append(_windows_of(part, found))
                    if sum(map(len, windows)) >= HELD_WINDOWS:
                        yield deal()
    if windows:
        yield deal()
    own = edges[_SORTED]
    bucket = (own["h"] // np.uint64(buckets) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    yield _context_rows([(b, _SORTED, own[k].tobytes(), b"".join(contexts[i] for i in k.tolist())) for b, k in zip(names.tolist(), np.split(order, first[1:]) if len(names) else [])])
    _give_back()


# --- the suffix sort -------------------------------------------------------------------------------------------------


class HashedStrings:
    """Strings as rows of a padded matrix, with prefix polynomial hashes, so that equal stretches are found by hash."""

    def __init__(self, chars: np.ndarray, lengths: np.ndarray, multiplier: int):
        self.chars, self.lengths = chars, lengths
        up, _ = _powers(multiplier, max(1, chars.shape[1]))
        with np.errstate(over="ignore"):
            self.prefix = np.zeros((len(chars), chars.shape[1] + 1), dtype=np.uint64)
            np.cumsum(_letters(multiplier)[chars] * up[: chars.shape[1]], axis=1, out=self.prefix[:, 1:])

    def common_length(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common prefix of rows a and b, by binary search."""
        low, high = np.zeros(len(a), dtype=np.int64), np.minimum(self.lengths[a], self.lengths[b])
        for _ in range(int(self.chars.shape[1]).bit_length()):
            middle = (low + high + 1) // 2
            equal = self.prefix[a, middle] == self.prefix[b, middle]
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        n = self.common_length(a, b)
        last = self.chars.shape[1] - 1
        x = np.where(n < self.lengths[a], self.chars[a, np.minimum(n, last)].astype(np.int16), -1)
        y = np.where(n < self.lengths[b], self.chars[b, np.minimum(n, last)].astype(np.int16), -1)
        return (x < y) | (x == y) & or_equal


def merge_sort(strings: HashedStrings, starts: np.ndarray) -> np.ndarray:
    """Rows in order inside each group of consecutive rows; starts: first row of each group. All runs merge at once."""
    n = len(strings.lengths)
    sizes = np.diff(np.r_[starts, n])
    order = np.arange(n)
    base, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    place = order - base
    width = 1
    while width < sizes.max(initial=0):
        active = np.flatnonzero(size > width)
        own, run = place[active], place[active] // width
        other = np.where(run % 2 == 0, (run + 1) * width, (run - 1) * width)
        low, high = np.minimum(other, size[active]), np.minimum(other + width, size[active])
        first = low.copy()
        mine = order[active]
        from_right = run % 2 == 1
        while True:  # how many of the other run go before
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            theirs = order[base[active[open_]] + middle]
            before = strings.less(theirs, mine[open_], from_right[open_])
            low[open_], high[open_] = np.where(before, middle + 1, low[open_]), np.where(before, high[open_], middle)
        target = base[active] + (run // 2) * 2 * width + (own - run * width) + (low - first)
        fresh = order.copy()
        fresh[target] = mine
        order = fresh
        width *= 2
    return order


def sorted_suffixes(chars: np.ndarray, lengths: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order inside groups, and common length of each with the one before in the order (-1 for the first of a group).

    Neighbours are compared byte by byte at the end; should a hash have collided, another multiplier is taken.
    """
    for multiplier in _MULTIPLIERS:
        strings = HashedStrings(chars, lengths, multiplier)
        order = merge_sort(strings, starts)
        a, b = order[:-1], order[1:]
        n = strings.common_length(a, b)
        differs = chars[a] != chars[b]
        beyond = np.arange(chars.shape[1]) >= np.minimum(lengths[a], lengths[b])[:, None]
        exact = np.where((differs | beyond).any(axis=1), (differs | beyond).argmax(axis=1), chars.shape[1])
        head = np.zeros(len(order), dtype=bool)
        head[starts] = True
        last = chars.shape[1] - 1
        x = np.where(exact < lengths[a], chars[a, np.minimum(exact, last)].astype(np.int16), -1)
        y = np.where(exact < lengths[b], chars[b, np.minimum(exact, last)].astype(np.int16), -1)
        if (((n == exact) & (x <= y)) | head[1:]).all():
            return order, np.where(head, -1, np.r_[-1, exact])
    raise RuntimeError("three hashes collided")


def repeated_windows(head: np.ndarray, body: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of anchors ordered by (h, doc, place), with contexts in body from begin on: index, first and last repeated window.

    Windows are told by how many bytes of them stand before the anchor. A window is repeated if an anchor before it in
    the order has the same one.
    """
    n, most = len(head), WINDOW - GRAM
    off, length = head["off"].astype(np.int64), head["len"].astype(np.int64)
    starts = np.flatnonzero(np.r_[True, head["h"][1:] != head["h"][:-1]])
    padded = np.r_[body, np.zeros(WINDOW, dtype=np.uint8)]
    right_n, left_n = length + WINDOW - off, off
    right = padded[(begin + off)[:, None] + np.arange(WINDOW)]
    left = padded[np.maximum((begin + off)[:, None] - 1 - np.arange(max(1, most)), 0)]
    right[np.arange(WINDOW) >= right_n[:, None]] = 0
    left[np.arange(left.shape[1]) >= left_n[:, None]] = 0
    right_order, right_lcp = sorted_suffixes(right, right_n, starts)
    left_order, left_lcp = sorted_suffixes(left, left_n, starts)
    again = np.zeros((n, most + 3), dtype=bool)
    right_run, left_run = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for before in range(most + 1):
        valid = np.flatnonzero((before >= off - length) & (before <= off))
        if len(valid) < 2:
            continue
        right_run[right_order] = np.cumsum(right_lcp < WINDOW - before)
        left_run[left_order] = np.cumsum(left_lcp < before)
        key = right_run[valid] * (n + 1) + left_run[valid]
        repeats = np.ones(len(valid), dtype=bool)
        repeats[np.unique(key, return_index=True)[1]] = False
        again[valid[repeats], before + 1] = True
    change = np.diff(again.astype(np.int8), axis=1)
    (row, first), (_, after) = np.nonzero(change == 1), np.nonzero(change == -1)
    return row, first, after - 1


def _first_windows(windows: list[np.ndarray], files: list[np.ndarray]) -> Iterator[tuple[int, int, int, bytes]]:
    """Spans of the windows that are not the first of their hashes."""
    x, file = np.concatenate(windows), np.concatenate(files)
    order = np.lexsort((x["row"], file, x["lo"], x["doc"], x["b"], x["a"]))
    x, file = x[order], file[order]
    again = np.r_[False, (x["a"][1:] == x["a"][:-1]) & (x["b"][1:] == x["b"][:-1])]
    yield from _by_file(*_runs(file[again], x[again]), _SPANS)


def _compare_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of repeats in a bucket of contexts to sort and of windows."""
    rows: list[tuple[int, int, int, bytes]] = []
    heads, bodies, windows, files = [], [], [], []
    for batch in batches:
        for kind, head, body in zip(*(batch.column(c).to_pylist() for c in ("kind", "head", "body")), strict=True):
            if kind == _SORTED:
                heads.append(np.frombuffer(head, dtype=_EDGE))
                bodies.append(np.frombuffer(body, dtype=np.uint8))
                continue
            file = int(np.frombuffer(head, dtype="<u4")[0])
            if kind == _SPANS:
                rows.append((0, file, _SPANS, body))
            else:
                windows.append(_unpack(body, _WINDOW))
                files.append(np.full(len(windows[-1]), file, dtype=np.int64))
    if windows:
        rows += _first_windows(windows, files)
    if heads:
        head, body = np.concatenate(heads), np.concatenate(bodies)
        sizes = head["len"].astype(np.int64) + WINDOW
        begin = np.cumsum(sizes) - sizes
        order = np.lexsort((head["row"], head["file"], head["lo"].astype(np.int64) + head["off"], head["doc"], head["h"]))
        head, begin = head[order], begin[order]
        starts = np.flatnonzero(np.r_[True, head["h"][1:] != head["h"][:-1], True])
        at = 0
        while at < len(starts) - 1:
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + SLICE, "right")) - 1)
            part, where = head[starts[at] : starts[to]], begin[starts[at] : starts[to]]
            index, first, last = repeated_windows(part, body, where)
            own = part[index]
            spans = np.empty(len(index), dtype=_SPAN)
            spans["row"], spans["lo"], spans["len"] = own["row"], own["lo"].astype(np.int64) + own["off"] - last, last - first
            rows += _by_file(own["file"].astype(np.int64), spans, _SPANS)
            at = to
    yield _found(rows)
    _give_back()


# --- the result ------------------------------------------------------------------------------------------------------


def merged(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the maximal runs of bytes covered by windows that begin in the given spans."""
    row, lo = spans["row"].astype(np.int64), spans["lo"].astype(np.int64)
    start, end = row << 33 | lo, row << 33 | lo + spans["len"] + WINDOW
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order]) if len(order) else end
    new = np.r_[True, start[1:] > end[:-1]] if len(start) else np.zeros(0, dtype=bool)
    heads = np.flatnonzero(new)
    tails = np.r_[heads[1:], len(start)] - 1 if len(heads) else heads
    mask = (1 << 33) - 1
    return start[heads] >> 33, start[heads] & mask, end[tails] & mask


def _apply(batches: Iterator[pa.RecordBatch], name: str, replace: str) -> Iterator[pa.RecordBatch]:
    file, blobs = 0, [np.empty(0, dtype=_SPAN)]
    for batch in batches:
        file = batch.column("file")[0].as_py()
        blobs += [np.frombuffer(b, dtype=_SPAN) for b in batch.column("blob").to_pylist() if b]
    row, start, end = merged(np.concatenate(blobs))
    del blobs
    for at, batch in _rows(_path(name, file)):
        cuts = np.searchsorted(row, np.arange(at, at + batch.num_rows + 1)).tolist()
        texts = common.utf8(batch.column("text")).cast(pa.large_binary())
        if replace:
            kept = [None if null else _cut_text(t.as_py(), start[a:b].tolist(), end[a:b].tolist()) for t, null, a, b in zip(texts, batch.column("text").is_null().to_pylist(), cuts[:-1], cuts[1:], strict=True)]
            at_text = batch.schema.get_field_index("text")
            yield pa.RecordBatch.from_arrays([*(pa.array(kept, pa.string()) if k == at_text else c for k, c in enumerate(batch.columns)), pa.array(np.diff(cuts), pa.int64())], names=[*batch.schema.names, replace])
            continue
        out = []
        for text, a, b in zip(texts, cuts[:-1], cuts[1:], strict=True):
            raw = text.as_py()
            left = raw if a == b else _kept(raw, start[a:b].tolist(), end[a:b].tolist())
            out.append((len(raw), len(raw) - len(left), b - a, hashlib.sha256(left).hexdigest()))
        n, removed, spans, sha = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _kept(raw: bytes, starts: list[int], ends: list[int]) -> bytes:
    return b"".join(raw[a:b] for a, b in zip([0, *ends], [*starts, len(raw)]))


def _cut_text(raw: bytes, starts: list[int], ends: list[int]) -> str:
    """What is left as text: a character is cut only if all its bytes are."""
    inside = lambda k: k < len(raw) and raw[k] & 0xC0 == 0x80
    for k, (a, b) in enumerate(zip(starts, ends)):
        while inside(a):
            a += 1
        while inside(b):
            b -= 1
        starts[k], ends[k] = a, max(a, b)
    return _kept(raw, starts, ends).decode()


def _repeats(docs: DataFrame, replace: str, limits: Limits) -> DataFrame:
    """The report, or the rows with texts cut and a column of that name."""
    spark = docs.sparkSession
    folder = common.new_folder(spark, "staged-texts")
    staged = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    staged.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", 0).option("parquet.block.size", 16 << 20).parquet(folder)
    # a row for each staged file, and so for each task that read the input; contents are not read
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select(F.regexp_extract("path", r"(part-)(\d+)([^/]*)$", 2).cast("int").alias("file"), F.regexp_replace(F.regexp_extract("path", r"part-[^/]*$", 0), r"^part-\d+", "part-*").alias("name"), "length")
    n, size, first, last, most = listed.agg(F.count(F.lit(1)), F.sum("length"), F.min("name"), F.max("name"), F.max("file")).first()  # one row
    if not n:
        n, size, first, last, most = 0, 0, "part-*", "part-*", 0
    if first != last:
        raise RuntimeError("staged files are named in more than one way")
    name, buckets = f"{folder}/{first}", max(1, round(size * 2.4 / 39 / PER_BUCKET))
    files = listed.select("file").repartitionById(most + 1, F.col("file"))
    # groups of files meet in fewer buckets each, so that a group of one bucket holds PER_BUCKET anchors whatever the size
    coarse = max(1, buckets // (most // limits.files + 1))
    anchored = files.mapInArrow(partial(_anchor_job, name=name, buckets=coarse, limits=limits), _FOUND_DDL).withColumn("part", F.floor(F.col("file") / limits.files).cast("int"))
    whole = most < limits.files

    def group(last: bool):
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _group_anchors(batches, last, limits, buckets)

        return of

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _context_job(batches, name, buckets)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _apply(batches, name, replace)

    found = common.stored(anchored.groupBy("bucket", "part").applyInArrow(group(whole), _FOUND_DDL), "anchors")
    spans, edges = found.filter(F.col("kind") == _SPANS), found.filter(F.col("kind").isin(_SORTED, _DEALT))
    if not whole:
        more = common.stored(found.filter(F.col("kind").isin(_ON, _HOT_ON)).groupBy("bucket").applyInArrow(group(True), _FOUND_DDL), "anchors")
        spans, edges = spans.unionByName(more.filter(F.col("kind") == _SPANS)), edges.unionByName(more.filter(F.col("kind").isin(_SORTED, _DEALT)))
    compared = edges.groupBy("file").applyInArrow(contexts, _CONTEXT_DDL).groupBy("bucket").applyInArrow(_compare_contexts, _FOUND_DDL)
    every = spans.select("file", "blob").unionByName(compared.select("file", "blob")).unionByName(files.select("file", F.lit(None).cast("binary").alias("blob")))
    if replace:
        schema = StructType([*staged.schema.fields, StructField(replace, LongType())])
    else:
        schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return every.groupBy("file").applyInArrow(apply, schema)


def repeat_report(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """A row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a string of WINDOW bytes that covers it also starts earlier: in a smaller doc_id, or earlier in the
    same document. Strings are judged on the input and never cross documents. Null texts are empty; shorter texts keep
    all; very long ones are judged whole, in overlapping chunks. Null ids come after all others; rows of one id, repeated
    rows among them, are ordered by their place in the staged files. An empty table gives no rows. Only doc_id and text
    are read; other columns have no effect.
    """
    return _repeats(docs.select("doc_id", "text"), "", limits)


def cut_repeats(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The input rows with repeats cut out of text, and cut_spans, how many stretches, as the last column.

    Characters are cut whole; null texts stay null. All other columns pass unchanged; where one is named cut_spans, the
    new column's name is common.fresh(docs.columns, "cut_spans"). The rest as in repeat_report().
    """
    return _repeats(docs, common.fresh(docs.columns, "cut_spans"), limits)


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return repeat_report(common.documents(spark, sf_dir))
