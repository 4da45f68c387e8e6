"""Ids of the public tokenizers, one distinct word at a time.

A bounded memory of words answers nearly all of a text.  A text in which the library's normaliser, its idea of white
space or its special tokens could act otherwise than Python's string methods is given to the library whole.
"""

from __future__ import annotations

import re
import struct

import regex
from tokenizers import Tokenizer

from tidemark.llm.scratch import here

#: Outside this, lower(), split() and NFC are left to the library.
ODD = re.compile(r"[^\t-\r -~\u0085 -įı-ňŊ-ž]|<\|")
#: Fixed value: the word pattern of the lower-cased word vocabulary.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words that a worker remembers; those of the generation before are looked up once more before they are forgotten.
REMEMBERED = 200_000
_made: dict[str, WordTokenizer] = {}


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it is visible, else the next from U+0100 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b if b in visible else spare))
        spare += b not in visible
    return out


LETTERS = byte_letters()


def lettered(word: str) -> str:
    """A word as byte-level vocabularies spell it."""
    return word if word.isascii() and word.isalnum() else "".join(map(LETTERS.__getitem__, word.encode()))


def packed_ids(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def quiet(path: str) -> Tokenizer:
    """The library's tokenizer, without truncation and padding."""
    tokenizer = Tokenizer.from_file(here(path))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class WordTokenizer:
    """For the word vocabulary, which drops white space; encode() gives ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.tokenizer = quiet(path)
        self.model = self.tokenizer.model
        self.pattern = regex.compile(WORD_PATTERN)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        """The one of this Python worker."""
        if path not in _made:
            _made[path] = cls(path)
        return _made[path]

    def _learn(self, word: str) -> bytes:
        if len(self.known) >= REMEMBERED:
            self.known, self.older = {}, self.known
        found = self.older.get(word)
        if found is None:
            parts = (word,) if word.isalpha() else self.pattern.findall(word)
            found = packed_ids([t.id for part in parts for t in self.model.tokenize(lettered(part))])
        self.known[word] = found
        return found

    def encode(self, text: str) -> bytes:
        if ODD.search(text):
            return packed_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        words = text.lower().split()
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            return b"".join([self.known.get(word) or self._learn(word) for word in words])
