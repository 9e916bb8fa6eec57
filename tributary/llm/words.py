"""Word hashes of whole Arrow batches, without a Python object per word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
_RATIO = _U(0x9E3779B97F4A7C15)                 # odd, so it has an inverse modulo 2**64
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = _U(0xD6E8FEB86659FD93)
#: A block of words is hashed at a time, so that a very long text needs no more memory than a short one.
BLOCK_BYTES = 1 << 20

#: Bytes of ``[\x20\x09-\x0D]``.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII bytes other than letters and digits; bytes of non-ASCII characters belong to words.
NOT_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_table = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U)
_powers: dict[str, np.ndarray] = {}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, ratio in (("up", _RATIO), ("down", _INVERSE)):
            steps = np.full(size, ratio, _U)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _MIX
    h = (h ^ (h >> _U(29))) * _RATIO
    return h ^ (h >> _U(32))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(data: np.ndarray) -> np.ndarray:
    """UTF-8 with ASCII and Latin-1 capitals made small; lengths stay."""
    out = _LOWER[data]
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    out[capital] += 32
    return out


@dataclass
class Words:
    """Words of a batch in order: byte range, 64-bit hash, row of each."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    row: np.ndarray

    def per_row(self) -> np.ndarray:
        """Index of the first word of each row; one entry more than rows."""
        return np.searchsorted(self.row, np.arange(len(self.offsets)))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column (nulls are empty)."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def split(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES) -> Words:
    """Words are the maximal runs of bytes that aren't separators, cut at row bounds."""
    inside = ~separators[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(data, offsets, start, end, byte_hash(data, start, end), row)


def byte_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range (ascending, not overlapping): a polynomial over a table of
    random values, from prefix sums modulo 2**64, mixed with the length."""
    out = np.empty(len(start), _U)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + BLOCK_BYTES)))
        lo, hi = int(start[i]), int(end[j - 1])
        up, down = _pow(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, _U)
        np.cumsum(_table[data[lo:hi]] * up[:hi - lo], out=sums[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(_U))
        i = j
    return out


def windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``n`` words inside a row, and the index of its first word."""
    count = len(words.hash) - n + 1
    if count <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    h = np.zeros(count, _U)
    for k in range(n):
        h = h * _RATIO + words.hash[k:k + count]
    at = np.flatnonzero(words.row[n - 1:] == words.row[:count])
    return mix(h[at]), at
