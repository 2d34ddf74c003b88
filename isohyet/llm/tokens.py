"""Token ids of whole texts by a tokenizers file, computed once per distinct pre-token."""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

#: Id that ends each document.
END_ID = 2
#: Distinct pre-tokens kept by one worker, and their letters and id bytes; the memo starts anew beyond either, so memory
#: is bounded and ids do not change. A longer pre-token is not kept.
MEMO_ENTRIES, MEMO_BYTES, LONGEST_KEPT = 500_000, 16_000_000, 256

# Of the characters up to U+00FF: letters, numbers and white space, as the pre-tokenizer's pattern has them.
_LETTERS, _NUMBERS, _SPACES = "a-zA-Zªµºß-öø-ÿÀ-ÖØ-Þ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
_PRE_TOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself where printable, else the next from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


class _Memo(dict):
    """Pre-token to ids as bytes; what is missing is computed by the model and kept."""

    def __init__(self, model, code: str):
        self.tokenize, self.code, self.letters, self.held = model.tokenize, code, byte_letters(), 0

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMO_ENTRIES or self.held >= MEMO_BYTES:
            self.clear()
            self.held = 0
        own = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.letters)
        found = array(self.code, [t.id for t in self.tokenize(own)]).tobytes()
        if len(word) <= LONGEST_KEPT:
            self[word] = found
            self.held += len(word) + len(found)
        return found


class PreTokenEncoder:
    """Ids of texts as little-endian bytes, exactly as the tokenizers library gives them.

    The vocabulary's normaliser composes characters, makes white space blanks and lowers case; its pre-tokenizer splits by
    a pattern, and each pre-token is encoded by itself. For texts of characters up to U+00FF, which compose to
    themselves, lowering and splitting are done here, and the library's model encodes each distinct pre-token once. Other
    texts, and those that may spell a special token, go to the library whole.
    """

    def __init__(self, path: str, width: int = 4):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype, self.width = {2: "<u2", 4: "<u4"}[width], width
        self.memo = _Memo(self.tokenizer.model, {2: "H", 4: "I"}[width])

    def encode(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
            plain = "<|" not in text
        except UnicodeEncodeError:
            plain = False
        if plain:
            return b"".join(map(self.memo.__getitem__, _PRE_TOKEN.findall(text.lower())))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()


@lru_cache(maxsize=4)
def encoder(path: str, width: int = 4) -> PreTokenEncoder:
    """One per Python worker: the memo outlives a task."""
    return PreTokenEncoder(path, width)


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
