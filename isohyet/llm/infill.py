"""Fill-in-middle forms of texts by bit-parallel integers.

A text is cut into units: characters, words with the white space after them, or lines. For each class of bytes that a
unit is told by, bytes.translate gives a string of 0 and 1, read as one integer whose bit i stands for byte i. Shifts and
boolean operations on those integers mark the byte after which each unit ends; bit_count() gives the number of units,
and the byte where the k-th ends is found by halving the integer again and again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


def _table(belongs) -> bytes:
    """A translation of bytes to the digits 1 (in the class) and 0."""
    return bytes(49 if belongs(b) else 48 for b in range(256))


_LEADS = _table(lambda b: b & 0xC0 != 0x80)
_BLANKS = _table(lambda b: b == 32 or 9 <= b <= 13)
_NEWLINES = _table(lambda b: b == 10)


def _mask(data: bytes, table: bytes) -> int:
    """Bit i is set if byte i is in the class."""
    return int(data.translate(table)[::-1], 2)


def ends(data: bytes, unit: str) -> int:
    """The mask of the bytes after which a unit ends; every byte is in exactly one unit, and the last byte ends one."""
    if not data:
        return 0
    last = 1 << len(data) - 1
    if unit == "characters":  # the next byte begins one
        return _mask(data, _LEADS) >> 1 | last
    if unit == "words":  # white space, and the next byte is none
        blanks = _mask(data, _BLANKS)
        return blanks & ~(blanks >> 1) & last - 1 | last
    if unit == "lines":
        return _mask(data, _NEWLINES) | last
    raise ValueError(f"no such unit: {unit}")


def place(mask: int, width: int, k: int) -> int:
    """Bytes in the first k units: the place after the k-th set bit of a mask of that many bits, by halving."""
    if k == 0:
        return 0
    at, rank = 0, k - 1
    while width > 1:
        half = width // 2
        low = mask & (1 << half) - 1
        below = low.bit_count()
        if rank < below:
            mask, width = low, half
        else:
            rank, mask, at, width = rank - below, mask >> half, at + half, width - half
    return at + 1


@dataclass(frozen=True)
class Form:
    """What stands before prefix, suffix and middle, and how often a text gets which form, in hundredths."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    cut_of_100: int = 90
    suffix_first_of_100: int = 20
    salt: str = "1:"

    def draws(self, doc_id: int | None) -> list[int]:
        """Four numbers of 32 bits that depend on the id alone."""
        held = hashlib.sha256(f"{self.salt}{'' if doc_id is None else doc_id}".encode()).digest()
        return [int.from_bytes(held[k : k + 4], "big") for k in (0, 4, 8, 12)]


def fill_in_middle(doc_id: int | None, data: bytes, unit: str = "characters", form: Form = Form()) -> tuple[int, str, bytes, int | None, int | None]:  # noqa: B008  frozen
    """Units, the form's name, the output, and the bytes of prefix and middle (None where the text stays plain)."""
    mask = ends(data, unit)
    n = mask.bit_count()
    h1, h2, h3, h4 = form.draws(doc_id)
    p, s, m = form.prefix.encode(), form.suffix.encode(), form.middle.encode()
    if not data or h3 % 100 >= form.cut_of_100 or p in data or s in data or m in data:
        return n, "plain", data, None, None
    low, high = sorted((place(mask, len(data), h1 % (n + 1)), place(mask, len(data), h2 % (n + 1))))
    before, between, after = data[:low], data[low:high], data[high:]
    if h4 % 100 < form.suffix_first_of_100:
        return n, "spm", b"".join((s, after, p, before, m, between)), low, high - low
    return n, "psm", b"".join((p, before, s, after, m, between)), low, high - low


_DDL = "doc_id long, n long, form string, output string, prefix_units long, middle_units long"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("output", pa.string()), ("prefix_units", pa.int64()), ("middle_units", pa.int64())])
#: Bytes of outputs that one batch carries.
_BATCH_BYTES = 16_000_000


def _transform(batches: Iterator[pa.RecordBatch], unit: str, form: Form) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    held = 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), common.utf8(batch.column(1)).cast(pa.large_binary()), strict=True):
            data = text.as_py()
            n, name, made, before, between = fill_in_middle(doc, data, unit, form)
            counts = (None, None) if before is None else (ends(data[:before], unit).bit_count(), ends(data[before : before + between], unit).bit_count())
            out.append((doc, n, name, made, *counts))
            held += len(made)
            if held >= _BATCH_BYTES:
                yield _batch(out)
                out, held = [], 0
        if out:
            yield _batch(out)
            out, held = [], 0
    common.give_back()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    columns[3] = pa.array(columns[3], pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) if not isinstance(c, pa.Array) else c for c, t in zip(columns, _SCHEMA.types, strict=True)], schema=_SCHEMA)


def transform(docs: DataFrame, unit: str = "characters", form: Form = Form()) -> DataFrame:  # noqa: B008  frozen
    """A row per document: doc_id, n (units), form (plain, psm, spm), output, prefix_units, middle_units (null if plain).

    Where the text is cut depends on the id and n alone, so reruns agree. Null texts are empty ones, and those stay plain,
    as do texts that hold one of the three marks. A null id is drawn as the empty string. Repeated rows stay, each with the
    same output; an empty table gives no rows; very long texts are cut whole, one at a time; other columns have no effect.
    Each row is made where it is read, without a shuffle.
    """
    rows = docs.select(F.col("doc_id").cast("long"), common.text_or_empty().alias("text"))
    return rows.mapInArrow(partial(_transform, unit=unit, form=form), _DDL)


def restored(output: Column, name: Column, form: Form = Form()) -> Column:  # noqa: B008  frozen
    """The text, from the output and the name of its form alone.

    The marks can't stand inside a part, since such texts are left plain, nor begin in one and end outside.
    """

    def parts(first: str, second: str, third: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, F.lit(len(first) + 1), F.char_length(output))
        a = F.substring_index(body, second, 1)
        rest = F.substring(body, F.char_length(a) + len(second) + 1, F.char_length(body))
        b = F.substring_index(rest, third, 1)
        return a, b, F.substring(rest, F.char_length(b) + len(third) + 1, F.char_length(rest))

    p, s, m = parts(form.prefix, form.suffix, form.middle)
    s_, p_, m_ = parts(form.suffix, form.prefix, form.middle)
    return F.when(name == "psm", F.concat(p, m, s)).when(name == "spm", F.concat(p_, m_, s_)).otherwise(output)


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    found = transform(common.documents(spark, sf_dir))
    return found.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP11_SQL = """
with drawn as (
    select doc_id, coalesce(text, '') as text, length(coalesce(text, ''))::bigint as n, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents
), numbers as (
    select doc_id, text, n, ('0x' || substr(h, 1, 8))::bigint % (n + 1) as c1, ('0x' || substr(h, 9, 8))::bigint % (n + 1) as c2,
        ('0x' || substr(h, 17, 8))::bigint % 100 as h3, ('0x' || substr(h, 25, 8))::bigint % 100 as h4
    from drawn
), cut as (
    select doc_id, text, n, least(c1, c2) as a, greatest(c1, c2) as b,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 >= 90 then 'plain' when h4 < 20 then 'spm' else 'psm' end as form
    from numbers
), parts as (
    select *, substr(text, 1, a) as prefix, substr(text, a + 1, b - a) as middle, substr(text, b + 1) as suffix from cut
)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
    sha256(text) as restored_sha256
from parts
"""
