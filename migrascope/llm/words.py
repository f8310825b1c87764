"""Words of a text column as 64-bit hashes, computed on whole Arrow buffers with numpy.

A word is a run of characters outside 0x20 and 0x09-0x0D. Those separators are single bytes in UTF-8,
so words are cut on bytes. Equal words have equal hashes; unequal words collide with a probability of
about 2^-64 a pair.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that powers never vanish
LONG = 512  # bytes of a word from which on it is hashed by a digest

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
PLAIN = _SEPARATOR.copy()  # as separators, any ASCII character but letters and digits
PLAIN[[c for c in range(128) if not chr(c).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)


@dataclass
class Words:
    """Words of some rows: row i holds words first[i] to first[i + 1]."""

    data: np.ndarray  # bytes of all rows
    hash: np.ndarray
    start: np.ndarray  # of each word in data
    end: np.ndarray
    first: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of the splitmix64 generator: spreads every bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def split(column: pa.Array, lower: bool = False, separators: np.ndarray = _SEPARATOR) -> Words:
    """Words of each row; a null row has none. ``separators`` tells for each byte whether it ends a word."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or bounds[-1] == bounds[0]:
        empty = np.zeros(0, dtype=np.int64)
        return Words(np.zeros(0, np.uint8), np.zeros(0, np.uint64), empty, empty, np.zeros(len(column) + 1, np.int64))
    raw = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    if lower:
        raw = _LOWER[raw]
    inside = ~separators[raw]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(raw, _hashes(raw, start, end), start, end, np.searchsorted(start, bounds))


def _hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Words are read eight bytes at a time, all words side by side; very long ones by a digest."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    lanes = np.ndarray(len(raw), dtype="<u8", buffer=padded, strides=(1,))
    length = end - start
    out = mix(length.astype(np.uint64) * BASE)
    live = np.flatnonzero(length <= LONG)
    offset = 0
    while len(live):
        left = np.minimum(length[live] - offset, 8)
        lane = lanes[start[live] + offset] & _MASK[left]
        out[live] = mix(out[live] * BASE + lane)
        offset += 8
        live = live[length[live] > offset]
    for i in np.flatnonzero(length > LONG):
        digest = hashlib.blake2b(raw[start[i] : end[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, np.uint64)[0]
    return out


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of k words starting at each word, and which of them stay inside a row.

    A run is built from runs of half its length. The hashes cover all start positions that have k
    words after them in the buffer.
    """
    n = len(words.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    factor, piece, length = powers(k + 1), words.hash, 1
    total, covered = None, 0
    while True:
        if k & length:
            part = piece[covered:]
            total = part if total is None else total[: len(part)] * factor[length] + part[: len(total)]
            covered += length
        if covered == k:
            break
        piece = piece[:-length] * factor[length] + piece[length:]
        length *= 2
    row_end = np.repeat(words.first[1:], np.diff(words.first))[:n]
    return mix(total[:n]), np.arange(n) + k <= row_end


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
