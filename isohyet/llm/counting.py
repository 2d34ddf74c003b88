"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie over bytes. Each node has a failure link and the number of pieces popped on the way there, so
one pass over a word's bytes gives the number of pieces of its greedy longest-match segmentation; the pieces themselves
are never built. Every single byte is a piece, so every word can be segmented.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

#: What stands before each word in the vocabulary's pieces.
WORD_START = "▁".encode()
#: Words kept by one worker, none longer than LONGEST_KEPT bytes; the memo starts anew beyond it.
MEMO_ENTRIES, LONGEST_KEPT = 600_000, 64


class LongestMatch:
    """The automaton. children: (node << 8 | byte) to node; fail and popped by node; the root is 0."""

    def __init__(self, pieces: list[bytes]):
        children: dict[int, int] = {}
        is_piece = [False]
        for piece in [*pieces, *(bytes([b]) for b in range(256))]:
            node = 0
            for b in piece:
                key = node << 8 | b
                if key not in children:
                    children[key] = len(is_piece)
                    is_piece.append(False)
                node = children[key]
            is_piece[node] = bool(node)
        below: dict[int, list[tuple[int, int]]] = {}
        for key, child in children.items():
            below.setdefault(key >> 8, []).append((key & 255, child))
        fail, popped = [-1] * len(is_piece), [0] * len(is_piece)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for b, child in below.get(node, ()):
                if is_piece[child]:
                    fail[child], popped[child] = 0, 1
                else:  # pop what the parent pops until the byte can follow
                    at, count = fail[node], popped[node]
                    while at << 8 | b not in children:
                        count += popped[at]
                        at = fail[at]
                    fail[child], popped[child] = children[at << 8 | b], count
                queue.append(child)
        self.children, self.fail, self.popped = children, fail, popped

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest-match segmentation."""
        children, fail, popped = self.children, self.fail, self.popped
        node = total = 0
        for b in word:
            key = node << 8 | b
            while key not in children:
                total += popped[node]
                node = fail[node]
                key = node << 8 | b
            node = children[key]
        while node:
            total += popped[node]
            node = fail[node]
        return total


def greedy_count(pieces: set[bytes], longest: int, word: bytes) -> int:
    """The definition, for tests: take the longest piece, again and again."""
    at = n = 0
    while at < len(word):
        step = next((k for k in range(min(longest, len(word) - at), 1, -1) if word[at : at + k] in pieces), 1)
        at += step
        n += 1
    return n


def model_pieces(path: str) -> list[bytes]:
    """The ordinary pieces of a sentencepiece file as bytes; byte, control and unknown pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i).encode() for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]


@lru_cache(maxsize=4)
def automaton(path: str) -> tuple[LongestMatch, dict[bytes, int]]:
    return LongestMatch(model_pieces(path)), {}


def _count(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    match, memo = automaton(vocabulary)
    for batch in batches:
        n_words, n_pieces, longest = [], [], []
        for text in common.utf8(batch.column(1)).cast(pa.large_binary()):
            words = text.as_py().split()  # bytes split exactly at \x20 and \x09-\x0D
            counts = []
            for w in words:
                c = memo.get(w)
                if c is None:
                    c = match.count(WORD_START + w)
                    if len(w) <= LONGEST_KEPT:
                        if len(memo) >= MEMO_ENTRIES:
                            memo.clear()
                        memo[w] = c
                counts.append(c)
            n_words.append(len(words))
            n_pieces.append(sum(counts))
            longest.append(max(counts, default=0))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_pieces, pa.int64()), pa.array(longest, pa.int64())], names=["doc_id", "n_words", "n_pieces", "max_word_pieces"])


def count_pieces(docs: DataFrame, vocabulary: str) -> DataFrame:
    """A row per document: doc_id, n_words, n_pieces, max_word_pieces.

    Words are runs of bytes other than \\x20 and \\x09-\\x0D, taken as they are. Null and empty texts have 0 words and 0
    pieces; null ids and repeated rows stay; an empty table gives no rows; other columns have no effect. Very long texts and
    words are read whole, in time that grows with their bytes.
    """
    return docs.select(F.col("doc_id").cast("long"), common.text_or_empty().alias("text")).mapInArrow(partial(_count, vocabulary=vocabulary), "doc_id long, n_words long, n_pieces long, max_word_pieces long")


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_pieces(common.documents(spark, sf_dir), tokens.vocabulary_path("piece_bpe_32k.model"))
