"""Words and word hashes of Arrow text columns, computed over whole buffers at once with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Text handled at once; a longer document is handled alone.
SLICE_BYTES = 1 << 20

_all = np.arange(256)
LOWER = np.where((_all >= 65) & (_all <= 90), _all + 32, _all).astype(np.uint8)
#: Bytes that stand between words: white space, or everything but digits, letters and bytes of non-ASCII characters.
NOT_SPACE = ~((_all == 32) | ((_all >= 9) & (_all <= 13)))
ALNUM = ((_all >= 48) & (_all <= 57)) | ((_all >= 65) & (_all <= 90)) | ((_all >= 97) & (_all <= 122)) | (_all >= 128)

_rng = np.random.Generator(np.random.PCG64(20240601))
BYTE_KEYS = _rng.integers(0, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters close ones (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash base's powers up to n and their inverses, modulo 2**64; kept for the next call."""
    if len(_powers[0]) <= n:
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(n + 1, base, U64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without nulls; no copy of the bytes."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1] if offsets and len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), off.astype(np.int64)


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents with at most `limit` bytes together, or one document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words(NamedTuple):
    data: np.ndarray  # lower-cased bytes of the slice
    start: np.ndarray  # of each word, in data
    end: np.ndarray
    first: np.ndarray  # index of each document's first word, and one past the last
    key: np.ndarray  # 64-bit hash of each word
    total: np.ndarray  # hashes of data's beginnings, for keys of parts of words

    def prefix_key(self, size: int) -> np.ndarray:
        """key_of() of each word's first `size` bytes; of the whole word where it is shorter."""
        end = np.minimum(self.start + size, self.end)
        return _part_key(self.total, self.start, end)


def _part_key(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((total[end] - total[start]) * powers(len(total) - 1)[1][start] + (end - start).astype(U64))


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """Maximal runs of bytes for which inside[byte]; documents are data[offsets[i]:offsets[i + 1]]."""
    base = int(offsets[0])
    data = LOWER[data[base : offsets[-1]]]
    at = offsets - base
    n = len(data)
    within = inside[data]
    opens, closes = within.copy(), within.copy()
    opens[1:] &= ~within[:-1]
    closes[:-1] &= ~within[1:]
    edges = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < n)]
    opens[edges] |= within[edges]
    closes[edges - 1] |= within[edges - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    power, _ = powers(n)
    total = np.zeros(n + 1, U64)
    np.cumsum(BYTE_KEYS[data] * power[:n], out=total[1:])
    return Words(data, start, end, np.searchsorted(start, at), _part_key(total, start, end), total)


def key_of(word: str | bytes) -> int:
    """The hash that words() gives this word."""
    raw = np.frombuffer(word.encode("utf-8") if isinstance(word, str) else word, np.uint8)
    return int(words(raw, np.array([0, len(raw)]), np.ones(256, bool)).key[0])
