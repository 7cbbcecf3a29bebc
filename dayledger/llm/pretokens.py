"""Texts as streams of distinct pieces, and pieces as pre-tokens.

Tokenizers here never join characters across ASCII white space, so a text's
tokens are those of its pieces one after the other. Each batch is cut into
pieces by arrow, its distinct pieces are numbered, and only those are looked at
in Python; results are gathered back by number."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The letters and numbers among the characters up to U+00FF.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
#: Text of these characters alone is split by the plain patterns below; anything
#: else takes the library's (or the full Unicode) way.
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xff]*").fullmatch
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: The public pre-token patterns of the two vocabularies, on plain text.
BYTE_PATTERN = re.compile(
    rf"{CONTRACTIONS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+")
WORD_PATTERN = re.compile(rf"{CONTRACTIONS}|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+")


def byte_alphabet() -> list[str]:
    """The character of each byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the rest follow from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def specials(path: str) -> list[tuple[str, int]]:
    """The added tokens of a tokenizer file: (text, id)."""
    with open(path, encoding="utf-8") as f:
        return [(t["content"], t["id"]) for t in json.load(f)["added_tokens"]]


def numbered(col: pa.Array, single_space: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct pieces of the texts, the number of each piece in turn, and the
    pieces before each text (one more entry than texts). Pieces are cut at
    every space (``single_space``; empty pieces count) or at runs of ASCII
    white space."""
    split = pc.split_pattern(col, " ") if single_space else pc.ascii_split_whitespace(col)
    offs = np.asarray(split.offsets, dtype=np.int64)
    coded = split.flatten().dictionary_encode()
    offs = offs - offs[0]
    return coded.dictionary, np.asarray(coded.indices, dtype=np.int64), offs


def pieces(col: pa.Array, single_space: bool) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``numbered`` with the distinct pieces as a list."""
    distinct, index, offs = numbered(col, single_space)
    return distinct.to_pylist(), index, offs


class Bounded(dict):
    """A dictionary that takes no more entries once it holds ``limit``."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def put(self, key, value):
        if len(self) < self.limit:
            self[key] = value
        return value


def sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of the values of each row (rows may be empty)."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offs[1:]] - total[offs[:-1]]


def chunks(seq: list, n: int) -> Iterator[list]:
    for lo in range(0, len(seq), n):
        yield seq[lo:lo + n]
