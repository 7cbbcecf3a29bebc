"""Words and hashes of text batches, by whole-array operations on UTF-8 bytes.

A word is a maximal run of bytes outside ``\\x20\\x09-\\x0D`` (multi-byte UTF-8
characters hold none of these bytes, so this equals ``[^\\x20\\x09-\\x0D]+`` on
characters)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: 64-bit values of the bytes; white space counts nothing.
_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE = _rng.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE[SPACE] = 0
LOWER = BYTE.copy()
LOWER[65:91] = BYTE[97:123]
FACTOR = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 21


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a large_string array and the offsets of its rows in them."""
    _, ends, data = col.buffers()
    offs = np.frombuffer(ends, dtype=np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of all words, and for each row the number of words
    before it (one more entry than rows)."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    inside = ~SPACE[data]
    new = inside.copy()
    new[1:] &= ~inside[:-1]
    cut = offs[:-1][(offs[:-1] < len(data))]
    new[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tail = offs[1:][offs[1:] > 0] - 1
    last[tail] = inside[tail]
    starts, ends = np.flatnonzero(new), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs, side="left")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each word; ``lower`` folds A-Z."""
    out = np.empty(len(starts), dtype=np.uint64)
    values = LOWER if lower else BYTE
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _CHUNK, side="right")))
        s, e = starts[at:to], ends[at:to]
        lens = e - s
        pos = np.arange(e[-1] - s[0], dtype=np.int64)
        first = s - s[0]
        pos -= np.repeat(first, np.diff(np.append(first, len(pos))))
        powers = np.cumprod(np.full(int(pos.max()) + 1, FACTOR, dtype=np.uint64))
        v = values[data[s[0]:e[-1]]] * powers[pos]
        out[at:to] = mix(np.add.reduceat(v, first) + lens.astype(np.uint64))
        at = to
    return out


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive words (over row borders as well; callers mask
    those): entry i covers words i .. i+k-1."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = np.full(n, np.uint64(k), dtype=np.uint64)
    for j in range(k):
        g = mix(g * FACTOR + h[j:j + n])
    return g


def row_of(counts: np.ndarray) -> np.ndarray:
    """Row number of each word, from the words before each row."""
    return np.repeat(np.arange(len(counts) - 1), np.diff(counts))


def ragged(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The concatenation of ``flat[starts[i]:starts[i]+lens[i]]``."""
    total = int(lens.sum())
    before = np.cumsum(lens) - lens
    return flat[np.arange(total) + np.repeat(starts - before, lens)]
