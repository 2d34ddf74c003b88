"""Exact fingerprints of canonical texts.

A text's canonical form is NFKC-normalised, case-folded and has each run of white space as one blank. Its fingerprint is
the 128-bit XXH3 of that form. Documents are grouped by it, and inside a bucket the canonical bytes are compared: the
least and the greatest of a bucket are found by ordinary aggregation, which combines before the shuffle, and where they
differ the bucket's forms are numbered and the number becomes part of the fingerprint.

Texts are shuffled once, compressed, into ranges of ids. Forms travel compressed too: equal forms give equal bytes and
different forms different ones, so comparing those is comparing the forms.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common


def canonical(text: str) -> bytes:
    if not text.isascii():
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    else:
        text = text.lower()
    return " ".join(text.split()).encode("utf-8", "surrogatepass")


BITS = 128


def digest(form: bytes, bits: int = BITS) -> str:
    return xxhash.xxh3_128_hexdigest(form)[: bits // 4]


def likeness(a: tuple[str, bytes], b: tuple[str, bytes]) -> float:
    """1 if the digests are equal and so are the bytes, else 0: an exact digest knows nothing between."""
    return float(a[0] == b[0] and a[1] == b[1])


def _digests(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [digest(canonical(x.as_py()), bits) for x in common.utf8(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], names=["doc_id", "mark", "digest"])


def digests(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, mark (a hash of the text), digest of every row; null texts are empty."""
    text = common.text_or_empty()
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("mark"), text.alias("text")).mapInArrow(partial(_digests, bits=bits), "doc_id long, mark long, digest string")


def resolve(forms: DataFrame) -> DataFrame:
    """From rows digest, form: the forms that are not their bucket's first, with ordinal, from 1. No row unless forms collide.

    A bucket's least and greatest forms are combined before they are shuffled, so its size does not matter.
    """
    clash = forms.groupBy("digest").agg(F.min("form").alias("low"), F.max("form").alias("high")).filter("low <> high").select("digest")
    apart = forms.select("digest", "form").join(clash, "digest", "left_semi").distinct()
    return apart.withColumn("ordinal", F.row_number().over(Window.partitionBy("digest").orderBy("form")) - 1).filter("ordinal > 0")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compress the last column."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = common.utf8(batch.column(batch.num_columns - 1)).cast(pa.large_binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([squeeze(x.as_py()) for x in texts], pa.binary())], names=batch.schema.names)


_RESULT = "doc_id long, n_chars long, edited_sha256 string, digest string, edited_digest string, near_edited double, near_next double, form binary, edited_form binary"
_DDL = f"{_RESULT}, kind int, part int, is_shared boolean, packed binary"
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
#: Kinds of rows that a range of documents gives: results, its first document, and its last, whose next is elsewhere.
_DONE, _FIRST, _LAST = 0, 1, 2


class _Compare:
    """The result of a document and the one after it.

    The form is returned where other documents share the digest, the edited text's form where its digest is one of those
    that were found to stand for several forms.
    """

    def __init__(self, bits: int, clashing: frozenset[str]):
        self.bits, self.clashing, self.squeeze = bits, clashing, zstandard.ZstdCompressor(level=1).compress

    def __call__(self, doc: int | None, text: str, is_shared: bool, following: str) -> tuple:
        form, after = canonical(text), canonical(following)
        own, next_ = (digest(form, self.bits), form), (digest(after, self.bits), after)
        cut = len(text) // 4
        edited, other = text, own
        if cut:
            edited = text[: len(text) - cut] + following[:cut]
            changed = canonical(edited)
            other = (digest(changed, self.bits), changed)
        forms = self.squeeze(form) if is_shared or own[0] in self.clashing else None, self.squeeze(other[1]) if other[0] in self.clashing else None
        return doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), own[0], other[0], likeness(own, other), likeness(own, next_), *forms


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    n = len(rows[0])
    names = [x.split(" ")[0] for x in _DDL.split(", ")][:n]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=False)], names=names)


def _edit(batches: Iterator[pa.RecordBatch], bits: int, clashing: frozenset[str]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in (id, mark, no text first) order: doc_id, mark, packed.

    A row without a text says that the documents of that id and mark share their digest with others. The range's first
    and last documents come out with their texts, so that the last can meet the first of the next range.
    """
    compare, open_ = _Compare(bits, clashing), zstandard.ZstdDecompressor().decompress
    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    held = shared = None
    for batch in batches:
        for doc, mark, packed in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if packed is None:
                shared = (doc, mark)
                continue
            text = open_(packed).decode()
            if held is None:
                out.append((*(None,) * 9, _FIRST, part, None, packed))
            else:
                out.append((*compare(*held[:3], text), _DONE, part, None, None))
            held = (doc, text, shared == (doc, mark), packed)
            if len(out) >= 1024:
                yield _batch(out)
                out = []
    if held is not None:
        out.append((held[0], *(None,) * 8, _LAST, part, held[2], held[3]))
    if out:
        yield _batch(out)


def _close(batches: Iterator[pa.RecordBatch], bits: int, clashing: frozenset[str]) -> Iterator[pa.RecordBatch]:
    compare, open_ = _Compare(bits, clashing), zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for doc, is_shared, own, following in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            yield _batch([compare(doc, open_(own).decode(), is_shared, open_(following).decode())])


def edited_digests(docs: DataFrame, bits: int = BITS, clashing: frozenset[str] = frozenset()) -> DataFrame:
    """Digests of every text and of its edited text, n_chars, edited_sha256, likenesses; form where a digest is shared.

    edited_form is given where the edited digest is one of the clashing ones.

    The next document is the next row by doc_id (nulls first, ties by a hash of the text); after the last comes the
    first. Null texts are empty. Documents are dealt into sorted ranges; each range's last document meets the next
    range's first afterwards, two rows a range. A table of one row is followed by itself; an empty one gives no rows.
    Repeated rows stay; very long texts are read whole, two at a time. Only doc_id and text are read.
    """
    known = common.durable(digests(docs, bits))
    shared = known.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest")
    marks = known.join(shared, "digest", "left_semi").select("doc_id", "mark", F.lit(None).cast("binary").alias("packed"))
    text = common.text_or_empty()
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("mark"), text.alias("text")).mapInArrow(_packed, "doc_id long, mark long, packed binary")
    ranges = texts.unionByName(marks).repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark", F.col("packed").isNotNull())
    found = common.durable(ranges.mapInArrow(partial(_edit, bits=bits, clashing=clashing), _DDL))
    firsts = found.filter(F.col("kind") == _FIRST)
    # one number a range; the last range is followed by the first
    order = firsts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next_part"))
    meeting = found.filter(F.col("kind") == _LAST).join(order, "part").join(firsts.select(F.col("part").alias("next_part"), F.col("packed").alias("following")), "next_part")
    closed = meeting.select("doc_id", "is_shared", "packed", "following").mapInArrow(partial(_close, bits=bits, clashing=clashing), _RESULT)
    return found.filter(F.col("kind") == _DONE).select(*closed.columns).unionByName(closed)


def edited_fingerprints(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """As edited_digests(), with fingerprint and edited_fingerprint: equal if and only if the canonical forms are.

    A fingerprint is the digest; of forms that share one, all but the first have their number after it. Should a digest
    stand for several forms, the edited texts with that digest are numbered among them. Such digests are what the driver
    holds: of n forms n * n / 2**129 are expected, at any real size none.
    """
    found = edited_digests(docs, bits)
    clashes = common.durable(resolve(found.filter("form is not null").select("digest", "form")))
    if clashes.isEmpty():
        return found.withColumn("fingerprint", F.col("digest")).withColumn("edited_fingerprint", F.col("edited_digest"))
    found = common.stored(edited_digests(docs, bits, frozenset(r.digest for r in clashes.select("digest").distinct().collect())), "digests")
    every = found.filter("form is not null").select("digest", "form").unionByName(found.filter("edited_form is not null").select(F.col("edited_digest").alias("digest"), F.col("edited_form").alias("form")))
    numbers = common.durable(resolve(every))
    edited = numbers.select(F.col("digest").alias("edited_digest"), F.col("form").alias("edited_form"), F.col("ordinal").alias("edited_ordinal"))
    both = found.join(numbers, ["digest", "form"], "left").join(edited, ["edited_digest", "edited_form"], "left")
    # concat_ws leaves out a null ordinal: a bucket's first form keeps the bare digest
    return both.withColumn("fingerprint", F.concat_ws("-", "digest", "ordinal")).withColumn("edited_fingerprint", F.concat_ws("-", "edited_digest", "edited_ordinal"))


def op3_canonical_digests(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(common.documents(spark, sf_dir)).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
