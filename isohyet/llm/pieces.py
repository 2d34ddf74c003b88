"""SentencePiece ids of texts by merging, and texts of ids.

For vocabularies of the merge type. A text's symbols begin as its characters. An agenda holds the pairs of adjacent
symbols whose union is a piece, the best score first and of equal scores the leftmost; its first pair is merged and the
pairs with its new neighbours go onto the agenda, until it is empty. Symbols that are no piece become byte pieces.

No merge joins neighbours that no piece holds side by side: a character and the blank after it, a line feed and
anything, a letter and a stop. Texts are cut there into segments, and each distinct segment is merged once. What is new in an Arrow batch is compared with the sentencepiece library's ids, and so is every decoded text.
"""

from __future__ import annotations

import re
import string
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

#: The stand-in of a blank, in pieces and in normalised texts.
BLANK = "▁"
#: Distinct segments kept by one worker, and their characters and id bytes; beyond either the memo starts anew. A longer
#: segment is not kept.
MEMO_ENTRIES, MEMO_BYTES, LONGEST_KEPT = 400_000, 24_000_000, 64


def _escaped(chars: set[str]) -> str:
    return "".join(re.escape(c) for c in sorted(chars))


class Merger:
    """Ids of normalised texts, from pieces with scores and the ids of the 256 byte pieces."""

    def __init__(self, scored: dict[str, tuple[float, int]], byte_ids: list[int]):
        self.cost, self.ids, self.byte_ids = {p: -score for p, (score, _) in scored.items()}, {p: i for p, (_, i) in scored.items()}, byte_ids
        longer = [p for p in scored if len(p) > 1]
        pairs = {p[k : k + 2] for p in longer for k in range(len(p) - 1)}
        #: A line feed that no longer piece holds stands alone; it comes between most paragraphs.
        self.alone = "" if any("\n" in x for x in pairs) else "\n"
        crossing = any(x[0] != BLANK and x[1] == BLANK for x in pairs)
        # marks such as stops that no piece has after a letter begin a segment, unless what is before them may join them
        marks = {q for q in string.punctuation if not any(x[1] == q and x[0].isalpha() for x in pairs)}
        joining = {x[0] for x in pairs if x[1] in marks} - {BLANK}
        inner = f"[^{BLANK}{self.alone}{_escaped(marks)}]*"
        body = f"[{_escaped(marks)}]?{inner}" + (f"(?:(?<=[{_escaped(joining)}])[{_escaped(marks)}]{inner})*" if joining else "") if marks else inner
        self.segments = None if crossing else re.compile((f"{self.alone}|" if self.alone else "") + f"{BLANK}+{body}|(?!{BLANK})(?=.){body}", re.DOTALL)

    def split(self, text: str) -> list[str]:
        """Segments that no merge crosses; the whole text if pieces may cross blanks."""
        if self.segments is None:
            return [text] if text else []
        return self.segments.findall(text)

    def encode(self, segment: str) -> list[int]:
        """Merge until no two neighbours make a piece; what is no piece becomes its bytes."""
        n = len(segment)
        if n == 1 or n == 2 and segment in self.cost:
            return self.spell(segment)
        cost = self.cost.get
        # symbols are told by where they begin: where they end, which is where the next begins (0: merged away), and the one before
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(c, k, k + 2) for k in range(n - 1) if (c := cost(segment[k : k + 2])) is not None]
        heapify(agenda)
        while agenda:
            _, left, stop = heappop(agenda)
            right = end[left]
            if not right or right >= stop or end[right] != stop:  # one of the two has been merged meanwhile
                continue
            end[left], end[right] = stop, 0
            if stop < n:
                before[stop] = left
                if (c := cost(segment[left : end[stop]])) is not None:
                    heappush(agenda, (c, left, end[stop]))
            if left:
                first = before[left]
                if (c := cost(segment[first:stop])) is not None:
                    heappush(agenda, (c, first, stop))
        out: list[int] = []
        at = 0
        while at < n:
            found = self.ids.get(segment[at : end[at]])
            if found is None:
                out += self.spell(segment[at : end[at]])
            else:
                out.append(found)
            at = end[at]
        return out

    def spell(self, symbol: str) -> list[int]:
        found = self.ids.get(symbol)
        return [self.byte_ids[b] for b in symbol.encode()] if found is None else [found]


class Memo(dict):
    """Segment to ids as bytes; what is missing is merged, kept, and waits in `fresh` to be checked."""

    def __init__(self, merger: Merger):
        self.merger, self.held, self.fresh = merger, 0, []

    def __missing__(self, segment: str) -> bytes:
        if len(self) >= MEMO_ENTRIES or self.held >= MEMO_BYTES:
            self.clear()
            self.held = 0
        found = _packed(self.merger.encode(segment))
        self.fresh.append((segment, found))
        if len(segment) <= LONGEST_KEPT:
            self[segment] = found
            self.held += len(segment) + len(found)
        return found


def _packed(ids: Iterable[int]) -> bytes:
    """Little-endian unsigned numbers of 32 bits."""
    held = array("I", ids)
    if sys.byteorder == "big":
        held.byteswap()
    return held.tobytes()


def _unpacked(data: bytes) -> list[int]:
    held = array("I")
    held.frombytes(data)
    if sys.byteorder == "big":
        held.byteswap()
    return held.tolist()


class Codec:
    """Encoding and decoding by one model file, with the library beside it as the check."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        byte_ids = [i for i in ids if model.is_byte(i)]
        if len(byte_ids) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        ordinary = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.merger = Merger({model.id_to_piece(i): (model.get_score(i), i) for i in ordinary}, sorted(byte_ids, key=lambda i: int(model.id_to_piece(i)[3:5], 16)))
        self.memo = Memo(self.merger)
        self.begin, self.end = _packed([model.bos_id()]), _packed([model.eos_id()])
        spelled = dict.fromkeys(ids, b"")  # control pieces spell nothing
        spelled |= {i: model.id_to_piece(i).replace(BLANK, " ").encode() for i in ordinary}
        spelled |= {i: bytes([b]) for b, i in enumerate(self.merger.byte_ids)}
        self.spelled = spelled
        self.blank_first = model.normalize("x") == BLANK + "x"

    def encode(self, text: str) -> bytes:
        """Ids with the begin and end ids, packed."""
        return b"".join((self.begin, *map(self.memo.__getitem__, self.merger.split(self.library.normalize(text))), self.end))

    def check(self) -> None:
        """Compare what has been merged since the last check with the library's ids.

        A line feed before a segment keeps the blank that the library puts before each text away from it.
        """
        waiting, self.memo.fresh = self.memo.fresh, []
        if not waiting:
            return
        if self.merger.segments is None or not self.merger.alone:
            raise ValueError("segments of this vocabulary can't be checked alone")
        lead = len(self.library.encode("\n"))
        for (segment, found), ids in zip(waiting, self.library.encode(["\n" + s for s, _ in waiting], num_threads=1), strict=True):
            if _packed(ids[lead:]) != found:
                raise ValueError(f"ids of {segment[:80]!r} are not the library's")

    def decode(self, packed: bytes) -> str:
        """The text of ids; the blank that encoding puts first is dropped."""
        spelled = b"".join(map(self.spelled.__getitem__, _unpacked(packed)))
        if self.blank_first and spelled[:1] == b" ":
            spelled = spelled[1:]
        return spelled.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per Python worker: the memo outlives a task."""
    return Codec(path)


#: Bytes of texts or ids that one batch carries.
_BATCH_BYTES = 8_000_000


def _batches(docs: list, made: list, first: pa.DataType, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(made, first)], names=names)


def _encode(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    own = codec(model)
    for batch in batches:
        docs, made, held = [], [], 0
        for doc, text in zip(batch.column(0).to_pylist(), common.utf8(batch.column(1)), strict=True):
            docs.append(doc)
            made.append(own.encode(text.as_py()))
            held += len(made[-1])
            if held >= _BATCH_BYTES:
                own.check()
                yield _batches(docs, made, pa.binary(), ["doc_id", "ids"])
                docs, made, held = [], [], 0
        own.check()
        if docs:
            yield _batches(docs, made, pa.binary(), ["doc_id", "ids"])
    common.give_back()


def encode(docs: DataFrame, model: str) -> DataFrame:
    """A row per document: doc_id, ids (binary: little-endian unsigned 32-bit numbers, with begin and end ids).

    Ids are the sentencepiece library's without sampling. Null texts are empty and have the begin and end ids alone. Null
    ids, repeated rows and ties stay as they are; an empty table gives no rows; other columns have no effect. Very long
    texts are encoded whole, one at a time. A segment whose ids differ from the library's ends the job with an error.
    """
    return docs.select(F.col("doc_id").cast("long"), common.text_or_empty().alias("text")).mapInArrow(partial(_encode, model=model), "doc_id long, ids binary")


def _decode(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    own = codec(model)
    for batch in batches:
        texts = []
        for ids in batch.column(1):
            packed = ids.as_py() or b""
            text = own.decode(packed)
            if text != own.library.decode(_unpacked(packed)):
                raise ValueError(f"the text {text[:80]!r} is not the library's")
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])
    common.give_back()


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, text of rows with doc_id and packed ids; every text is compared with the library's. Null ids: empty."""
    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(partial(_decode, model=model), "doc_id long, ids binary, text string")


def op13_sentencepiece(spark, sf_dir: str) -> DataFrame:
    model = tokens.vocabulary_path("piece_bpe_32k.model")
    found = decode(encode(common.documents(spark, sf_dir), model), model)
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256"))
