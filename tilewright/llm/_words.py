"""Vectorised tokenising of Arrow string columns: words and 64-bit word hashes straight from UTF-8 bytes.

A word is a maximal run of member bytes; every multi-byte UTF-8 unit is >= 0x80, so byte classes express
both word definitions in use. A word's hash is a polynomial over random byte values modulo 2**64, finished
with a multiply-xorshift mix; prefix sums give all words of a buffer at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(20240501))
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_STEP = 0xD6E8FEB86659FD93
CHUNK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

SPACED = np.ones(256, dtype=bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False

ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:256] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


_POWER_CACHE: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = CHUNK_BYTES + 1
    if n > size:  # one very long text: tables for this call only
        return _powers(_BASE, n), _powers(_BASE_INVERSE, n)
    if "up" not in _POWER_CACHE:
        _POWER_CACHE["up"], _POWER_CACHE["down"] = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
    return _POWER_CACHE["up"], _POWER_CACHE["down"]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(_STEP)
    h ^= h >> np.uint64(29)
    h *= np.uint64(_BASE)
    return h ^ (h >> np.uint64(32))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte buffer and row offsets of a string array; null rows are empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts take about CHUNK_BYTES; a longer text stands alone."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        yield first, last
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of these rows in order, row index bounds into that list)."""
    return word_places(data, offsets, member)[:2]


def word_places(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word of these rows in order, row index bounds into that list, first byte and end of each word in ``data``)."""
    low = int(offsets[0])
    raw = _LOWER[data[low : int(offsets[-1])]]
    bounds = offsets - low
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), np.zeros(len(offsets), np.int64), none, none
    inside = member[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = bounds[:-1][bounds[:-1] < n]
    begins[cut] = inside[cut]
    starts = np.flatnonzero(begins)
    ends_mask = inside.copy()
    ends_mask[:-1] &= ~inside[1:] | begins[1:]
    ends = np.flatnonzero(ends_mask) + 1
    up, down = _power_tables(n)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUE[raw] * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, bounds), starts + low, ends + low


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` adjacent words; the caller keeps to one row's words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        total = total * np.uint64(_BASE) + words[j : j + n]
    return mix(total + np.uint64(size))
