"""Counts of tiles packed for a shuffle, about 3 bytes each, and merged into vector tiles.

A count's key is its basis, its year and its pixel, in this order. A piece is one tile's sorted keys as variable-length integers: how
many, then each one's difference to the key before with a bit that tells whether it counts more than 1, then those counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..sources.shared import lean
from . import tile_arrays
from .bor_year import CODES
from .wire import ENCODED_BYTES

PIECE_BYTES = 1 << 20
#: A tile with its buffers may be 2 to the power of so many pixels wide.
MOST_BITS = 14
_YEARS = 26
_NAMES = {v: k for k, v in CODES.items()}


def bits_of(width: int) -> int:
    return (width - 1).bit_length()


def by_layer(bor: np.ndarray) -> np.ndarray:
    """Encoded basis and year, in the order of basis, then year."""
    bor = bor.astype(np.int64)
    years = np.sign(bor) * (np.abs(bor) // 100)
    return (bor - 100 * years + 99) << _YEARS | (years + (1 << _YEARS - 1))


def _bor(layered: np.ndarray) -> np.ndarray:
    return ((layered & (1 << _YEARS) - 1) - (1 << _YEARS - 1)) * 100 + (layered >> _YEARS) - 99


def pack(key: np.ndarray, n: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, where each piece begins and the last ends) of keys that are sorted from each place in ``begin`` to the next."""
    counts = np.diff(np.append(begin, len(key)))
    owner, more = np.repeat(np.arange(len(begin)), counts), n > 1
    step = np.diff(key, prepend=0)
    step[begin] = key[begin]
    many = np.add.reduceat(more, begin, dtype=np.int64)
    before = np.cumsum(many) - many
    head = begin + np.arange(len(begin)) + before
    said = np.empty(len(key) + len(begin) + int(many.sum()), np.int64)
    said[head] = counts
    said[np.arange(len(key)) + owner + 1 + before[owner]] = step << 1 | more
    k = np.flatnonzero(more)
    said[(head + 1 + counts - before)[owner[k]] + np.arange(len(k))] = n[k]
    sizes = tile_arrays._sizes(said)
    end = np.cumsum(sizes)
    out = np.zeros(int(end[-1]), np.uint8)
    tile_arrays._put(out, end - sizes, said)
    return out, np.append((end - sizes)[head], end[-1])


def unpack(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece's number, key, count)"""
    last = np.flatnonzero(data < 128)
    starts = np.append(0, last[:-1] + 1)
    value, size = np.zeros(len(last), np.int64), last - starts + 1
    for k in range(int(size.max())):
        here = np.flatnonzero(size > k) if k else slice(None)
        value[here] |= (data[starts[here] + k].astype(np.int64) & 0x7F) << 7 * k
    first = np.searchsorted(starts, offsets[:-1])
    counts = value[first]
    begin = np.cumsum(counts) - counts
    step = value[np.repeat(first + 1 - begin, counts) + np.arange(int(counts.sum()))]
    more = step & 1
    step >>= 1
    key = np.cumsum(step)
    key -= np.repeat(key[begin] - step[begin], counts)
    many = np.add.reduceat(more, begin)
    n = np.ones(len(key), np.int64)
    n[more > 0] = value[np.repeat(first + 1 + counts - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
    return np.repeat(np.arange(len(counts)), counts), key, n


def _encoded(tile: np.ndarray, key: np.ndarray, n: np.ndarray, tiles: int, tile_size: int, buffer: int) -> list[bytes]:
    """Tiles of counts that are in any order and may be in parts."""
    bits = bits_of(tile_size + 2 * buffer)
    layered, rank = np.unique(key >> 2 * bits, return_inverse=True)
    order = np.argsort((tile * len(layered) + rank) << 2 * bits | key & (1 << 2 * bits) - 1)
    tile, key, n = tile[order], key[order], n[order]
    begin = np.flatnonzero(np.append(True, (tile[1:] != tile[:-1]) | (key[1:] != key[:-1])))
    if len(begin) < len(key):
        tile, key, n = tile[begin], key[begin], np.add.reduceat(n, begin)
    x, y = key >> bits & (1 << bits) - 1, key & (1 << bits) - 1
    return tile_arrays.encode(tile, tile_arrays.pack(x, y, _bor(key >> 2 * bits), n, 0), tiles, tile_size, buffer)


def _tiles(pieces: pa.Array, new: np.ndarray, tile_size: int, buffer: int) -> Iterator[bytes]:
    """The tile of each run of pieces; one of many counts is made layer by layer."""
    offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset :][: len(pieces) + 1].astype(np.int64)
    data, begin = np.frombuffer(pieces.buffers()[2], np.uint8), np.append(np.flatnonzero(new), len(pieces))
    first = 0
    while first < len(begin) - 1:
        until = max(first + 1, int(np.searchsorted(offsets[begin], offsets[begin[first]] + PIECE_BYTES, side="right")) - 1)
        a, b = int(begin[first]), int(begin[until])
        if until == first + 1 and offsets[b] - offsets[a] > PIECE_BYTES:
            yield b"".join(_by_layers(data, offsets[a : b + 1], tile_size, buffer))
        else:
            piece, key, n = unpack(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield from _encoded((np.cumsum(new[a:b]) - 1)[piece], key, n, until - first, tile_size, buffer)
        first = until


def _by_layers(data: np.ndarray, offsets: np.ndarray, tile_size: int, buffer: int) -> Iterator[bytes]:
    """The layers of one tile; a layer is what is encoded at once."""
    bits, held, first = bits_of(tile_size + 2 * buffer), {}, 0
    while first < len(offsets) - 1:
        until = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE_BYTES, side="right")) - 1)
        _, key, n = unpack(data[offsets[first] : offsets[until]], offsets[first : until + 1] - offsets[first])
        n = n.astype(np.int32) if n.max() < 1 << 31 else n
        codes = key >> _YEARS + 2 * bits
        for code in np.flatnonzero(np.bincount(codes)).tolist():
            mine = codes == code
            held.setdefault(str(_NAMES.get(code - 99)), []).append((key[mine], n[mine]))
        first = until
    for name in sorted(held):
        key, n = (np.concatenate(c) for c in zip(*held.pop(name), strict=True))
        yield _encoded(np.zeros(len(key), np.int64), key, n.astype(np.int64), 1, tile_size, buffer)[0]


def encode_packs(laid: DataFrame, tile_size: int = 512, buffer: int = 64) -> DataFrame:
    """(row_key, value) from (row_key, piece) in the order of row keys. A task holds one tile's pieces, and the counts of one, at least."""

    def made(rows: pa.RecordBatch, new: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, values, size, first = rows.column(0).take(pa.array(np.flatnonzero(new))), [], 0, 0
        for value in _tiles(rows.column(1), new, tile_size, buffer):
            values.append(value)
            size += len(value)
            if size > ENCODED_BYTES or first + len(values) == len(keys):
                yield pa.RecordBatch.from_arrays([keys.slice(first, len(values)), pa.array(values, pa.binary())], ["row_key", "value"])
                first, values, size = first + len(values), [], 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for part in parts(batches, 1):
            size += pc.sum(pc.binary_length(part.column(1))).as_py()
            held.append(part)
            if size < PIECE_BYTES or len(held) > 1 and part.column(0)[-1] == held[0].column(0)[0]:
                continue
            rows = tile_arrays._one(held)
            new = _changes(rows.column(0))
            end = int(np.flatnonzero(new)[-1])
            if end:
                yield from made(rows.slice(0, end), new[:end])
            held = [rows.slice(end)]
            size = pc.sum(pc.binary_length(held[0].column(1))).as_py()
        if held:
            rows = tile_arrays._one(held)
            yield from made(rows, _changes(rows.column(0)))

    return laid.mapInArrow(lean(run), "row_key string, value binary")


def parts(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about PIECE_BYTES in a column of bytes, of a row at least."""
    for batch in batches:
        if batch.num_rows:
            part = np.cumsum(pc.binary_length(batch.column(column)).to_numpy().astype(np.int64)) // PIECE_BYTES
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
            yield from (batch.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True))


def _changes(keys: pa.Array) -> np.ndarray:
    at = keys.dictionary_encode().indices.to_numpy()
    return np.append(True, at[1:] != at[:-1])
