"""Vector tiles made from, and read into, whole columns: the bytes of ``wire.TileWriter``, many tiles at a time.

A tile's counts travel as pieces: 16 bytes a count, of pixel, encoded basis and year, and count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .wire import ENCODED_BYTES, POINT, _fields, read_vector_tile, split_code, tagged, varint, year_label

COUNT = np.dtype([("at", "<u8"), ("n", "<i8")])
PIECE_ROWS = 4096
BATCH_ROWS = 300_000
_SHIFT = np.uint64(16)


def pack(x: np.ndarray, y: np.ndarray, bor: np.ndarray, n: np.ndarray, buffer: int) -> np.ndarray:
    out = np.empty(len(x), COUNT)
    out["at"] = (((x + buffer) << 48) | ((y + buffer) << 32) | (bor.astype(np.int64) + (1 << 31))).astype(np.uint64)
    out["n"] = n
    return out


def unpack(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(x + buffer, y + buffer, borYear, count)"""
    at = counts["at"]
    return (at >> np.uint64(48)).astype(np.int64), (at >> np.uint64(32) & np.uint64(0xFFFF)).astype(np.int64), (at & np.uint64(0xFFFFFFFF)).astype(np.int64) - (1 << 31), counts["n"]


def _sizes(v: np.ndarray) -> np.ndarray:
    """Bytes of each varint."""
    out = np.ones(len(v), np.int64)
    rest = v >> 7
    while rest.any():
        out += rest > 0
        rest = rest >> 7
    return out


def _put(out: np.ndarray, at: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Varints written at their places; the places after them."""
    sizes = _sizes(v)
    for k in range(int(sizes.max(initial=0))):
        here = np.flatnonzero(sizes > k)
        out[at[here] + k] = (v[here] >> 7 * k & 0x7F) | np.where(sizes[here] > k + 1, 0x80, 0)
    return at + sizes


def _numbered(seg: np.ndarray, segs: int, v: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each value's number in its segment, by first appearance, and each segment's values in that order."""
    values, code = np.unique(v, return_inverse=True) if v.max() > 1 << 12 else (np.arange(int(v.max()) + 1), v)
    key = seg * len(values) + code
    if segs * len(values) > 8 * len(v) + (1 << 16):
        kinds, key = np.unique(key, return_inverse=True)
    else:
        kinds = np.arange(segs * len(values))
    first = np.full(len(kinds), len(v))
    first[key[::-1]] = np.arange(len(v))[::-1]
    there = np.flatnonzero(first < len(v))
    there = there[np.argsort(first[there])]
    rank = np.empty(len(kinds), np.int64)
    rank[there] = np.arange(len(there))
    owner = kinds[there] // len(values)
    base = np.searchsorted(owner, np.arange(segs + 1))
    found = values[kinds[there] % len(values)]
    return rank[key] - base[seg], [found[a:b] for a, b in zip(base[:-1].tolist(), base[1:].tolist(), strict=True)]


def _features(seg, x, y, key, value) -> tuple[np.ndarray, np.ndarray]:
    """The features' bytes of all segments, and each row's first byte, for rows sorted by segment and point."""
    begin = np.flatnonzero(np.append(True, (seg[1:] != seg[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
    key_size, value_size = _sizes(key), _sizes(value)
    tags = np.add.reduceat(key_size + value_size, begin)
    zx, zy = ((c[begin] << 1) ^ (c[begin] >> 63) for c in (x, y))
    shape = 1 + _sizes(zx) + _sizes(zy)
    body = 1 + _sizes(tags) + tags + 2 + 2 + shape
    whole = 1 + _sizes(body) + body
    end = np.cumsum(whole)
    start = end - whole
    out = np.zeros(int(end[-1]), np.uint8)
    out[start] = 2 << 3 | 2
    at = _put(out, start + 1, body)
    out[at] = 2 << 3 | 2
    at = _put(out, at + 1, tags)
    each = np.cumsum(key_size + value_size) - key_size - value_size
    each = each - np.repeat(each[begin] - at, np.diff(np.append(begin, len(x))))
    _put(out, _put(out, each, key), value)
    at = at + tags
    for b in (3 << 3, POINT, 4 << 3 | 2):
        out[at] = b
        at = at + 1
    out[at] = shape
    out[at + 1] = 1 | 1 << 3
    _put(out, _put(out, at + 2, zx), zy)
    return out, np.repeat(start, np.diff(np.append(begin, len(x))))


def encode(tile: np.ndarray, counts: np.ndarray, tiles: int, extent: int, buffer: int) -> list[bytes]:
    """The bytes of each tile from its packed counts, in any order; ``tile`` tells whose they are."""
    x, y, bor, n = unpack(counts)
    bors, code = np.unique(bor, return_inverse=True)
    said = [(str(name), year_label(year)) for name, year in map(split_code, bors.tolist())]
    layers, labels = sorted({a for a, _ in said}), sorted({b for _, b in said})
    layer_of, label_of = np.array([layers.index(a) for a, _ in said]), np.array([labels.index(b) for _, b in said])
    rank = np.argsort(np.lexsort((bors, label_of)))  # within a point, by label; the last of a label holds
    seg, minor = tile * len(layers) + layer_of[code], rank[code]
    bits = [int(c.max()).bit_length() for c in (x, y, minor)]
    if int(seg.max()).bit_length() + sum(bits) < 63:
        order = np.argsort(((seg << bits[0] | x) << bits[1] | y) << bits[2] | minor)
    else:
        order = np.lexsort((minor, y, x, seg))
    seg, x, y, n, label = seg[order], x[order] - buffer, y[order] - buffer, n[order], label_of[code[order]]
    del order, minor, bor, code
    last = np.append((seg[1:] != seg[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (label[1:] != label[:-1]), True)
    if not last.all():
        seg, x, y, n, label = (c[last] for c in (seg, x, y, n, label))
    begin = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
    bounds = np.append(begin, len(seg))
    out: list[list[bytes]] = [[] for _ in range(tiles)]
    heads = [tagged(15, 0, 2) + tagged(1, 2, a.encode()) for a in layers]
    keys, tail, known = [tagged(3, 2, b.encode()) for b in labels], tagged(5, 0, extent), {}
    first = 0
    while first < len(begin):  # some whole layers at a time
        until = max(first + 1, int(np.searchsorted(bounds, bounds[first] + BATCH_ROWS, side="right")) - 1)
        lo, hi = int(bounds[first]), int(bounds[until])
        local = np.repeat(np.arange(until - first), np.diff(bounds[first : until + 1]))
        key, used = _numbered(local, until - first, label[lo:hi])
        value, held = _numbered(local, until - first, n[lo:hi])
        data, starts = _features(local, x[lo:hi], y[lo:hi], key, value)
        starts = np.append(starts[bounds[first:until] - lo], len(data)).tolist()
        for k in range(until - first):
            whose, layer = divmod(int(seg[bounds[first + k]]), len(layers))
            values = []
            for v in held[k].tolist():
                if v not in known:
                    known[v] = tagged(4, 2, tagged(4, 0, v))
                values.append(known[v])
            body = b"".join([heads[layer], data[starts[k] : starts[k + 1]].tobytes(), *[keys[j] for j in used[k].tolist()], *values, tail])
            out[whose] += [varint(3 << 3 | 2), varint(len(body)), body]
        if len(known) > 100_000:
            known = {}
        first = until
    return [b"".join(parts) for parts in out]


def encode_pieces(pieces: DataFrame, extent: int = 512, buffer: int = 64) -> DataFrame:
    """(mapKey, tileX, tileY, value) from (mapKey, tileX, tileY, piece). A task holds the counts of one tile at least, and BATCH_ROWS about."""
    names = ["mapKey", "tileX", "tileY"]
    dealt = pieces.select(*names, "piece").repartition(*names).sortWithinPartitions(*names)

    def made(rows: pa.RecordBatch, new: np.ndarray) -> Iterator[pa.RecordBatch]:
        offsets = np.frombuffer(rows.column(3).buffers()[1], np.int32)[rows.column(3).offset :][: rows.num_rows + 1].astype(np.int64)
        counts = np.frombuffer(rows.column(3).buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(COUNT)
        begin = np.flatnonzero(new)
        tile = np.repeat(np.cumsum(new) - 1, np.diff(offsets) // COUNT.itemsize)
        values = encode(tile, counts, len(begin), extent, buffer)
        keys = [rows.column(k).take(pa.array(begin)) for k in range(3)]
        ends, size, first = [], 0, 0
        for k, v in enumerate(values):
            size += len(v)
            if size > ENCODED_BYTES or k == len(values) - 1:
                ends.append(k + 1)
                size = 0
        for end in ends:
            yield pa.RecordBatch.from_arrays([*[c.slice(first, end - first) for c in keys], pa.array(values[first:end], pa.binary())], [*names, "value"])
            first = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += pc.sum(pc.binary_length(batch.column(3))).as_py()
            if size >= BATCH_ROWS * COUNT.itemsize:
                rows = _one(held)
                new = _changes(rows)
                end = int(np.flatnonzero(new)[-1])
                if end:
                    yield from made(rows.slice(0, end), new[:end])
                held = [rows.slice(end)]
                size = pc.sum(pc.binary_length(held[0].column(3))).as_py() if end else size
        if held:
            rows = _one(held)
            yield from made(rows, _changes(rows))

    return dealt.mapInArrow(run, "mapKey string, tileX int, tileY int, value binary")


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _changes(rows: pa.RecordBatch) -> np.ndarray:
    """Where the first three columns differ from the row before."""
    new = np.zeros(rows.num_rows, bool)
    for c in (rows.column(0).dictionary_encode().indices.to_numpy(), *[rows.column(k).to_numpy() for k in (1, 2)]):
        new[1:] |= c[1:] != c[:-1]
    new[0] = True
    return new


def read(tiles: list[bytes]) -> Iterator[tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]]:
    """(tile's number, layers, layer's number, x, y, years, year's number, count): ``wire.read_vector_tile`` as columns, about BATCH_ROWS at a time."""
    names: dict[str, int] = {}
    years: dict[str, int] = {}
    held, points = [], 0
    for tile, data in enumerate(tiles):
        for _, layer in _fields(data):
            found = _layer(layer)
            if found is None:  # not as ``wire`` writes layers
                for name, x, y, year, n in read_vector_tile(tagged(3, 2, layer)):
                    numbers = [np.array([v], np.int64) for v in (tile, names.setdefault(name, len(names)), x, y, years.setdefault(year, len(years)), n)]
                    yield numbers[0], list(names), *numbers[1:4], list(years), *numbers[4:]
                continue
            name, bodies, end, keys, values = found
            said = [years.setdefault(k, len(years)) for k in keys]
            for first in range(0, len(bodies), 2 * BATCH_ROWS):  # a large layer in parts
                after = first + 2 * BATCH_ROWS
                some, start, until = bodies[first:after], bodies[first] if first else 0, bodies[after] if after < len(bodies) else end
                held.append((tile, names.setdefault(name, len(names)), layer[start:until], [b - start for b in some] if start else some, until - start, said, values))
                points += len(some)
                if points > BATCH_ROWS:
                    yield from _columns(held, names, years)
                    held, points = [], 0
    if held:
        yield from _columns(held, names, years)


def _layer(data: bytes) -> tuple[str, list[int], int, list[str], list[int]] | None:
    """(name, where each feature's body begins, where the features end, keys, values)."""
    at, end, name = 0, len(data), None
    while at < end and data[at] != 2 << 3 | 2:
        if data[at] == 15 << 3:
            at += 2
        elif data[at] == 1 << 3 | 2 and data[at + 1] < 128:
            name = data[at + 2 : at + 2 + data[at + 1]]
            at += 2 + data[at + 1]
        else:
            return None
    bodies = []
    add = bodies.append
    while at < end and data[at] == 2 << 3 | 2:
        n = data[at + 1]
        at += 2
        if n > 127:
            n, shift = n & 0x7F, 7
            while True:
                b = data[at]
                at += 1
                n |= (b & 0x7F) << shift
                shift += 7
                if b < 128:
                    break
        add(at)
        at += n
    keys, values = [], []
    for k, v in _fields(data[at:]):
        if k == 3:
            keys.append(v.decode())
        elif k == 4:
            if v[0] != 4 << 3:
                return None
            values.append(v[1] if v[1] < 128 else dict(_fields(v))[4])
        elif k != 5:
            return None
    if name is None or not name.isascii():
        return None
    return name.decode(), bodies, at, keys, values


def _columns(held, names: dict[str, int], years: dict[str, int]):
    """The rows of layers whose features are points, of one MoveTo each."""
    counts = np.array([len(h[3]) for h in held])
    ends = np.cumsum([h[4] for h in held])
    base = ends - [h[4] for h in held]
    body = np.concatenate([np.array(h[3], np.int64) for h in held]) + np.repeat(base, counts)
    raw = np.frombuffer(b"".join(h[2][: h[4]] for h in held), np.uint8)
    last = np.flatnonzero(raw < 128)
    number = np.zeros(len(raw) + 1, np.int64)  # of the varint that a byte is part of; names are such single bytes, too
    number[1:] = np.cumsum(raw < 128)
    starts = np.append(0, last[:-1] + 1)
    value, size = np.zeros(len(last), np.int64), last - starts + 1
    for k in range(int(size.max())):
        here = np.flatnonzero(size > k) if k else slice(None)
        value[here] |= (raw[starts[here] + k].astype(np.int64) & 0x7F) << 7 * k
    first = number[body]
    after = number[body + 1 + size[first + 1] + value[first + 1]]
    form = (value[first] == (2 << 3 | 2)).all() and all((value[after + k] == v).all() for k, v in ((0, 3 << 3), (1, POINT), (2, 4 << 3 | 2), (4, 1 | 1 << 3)))
    if not form:
        raise ValueError("a feature is no point with its tags before its shape")
    x, y = ((v >> 1) ^ -(v & 1) for v in (value[after + 5], value[after + 6]))
    pairs = (after - first - 2) // 2
    each = np.repeat(first + 2 - 2 * (np.cumsum(pairs) - pairs), pairs) + 2 * np.arange(int(pairs.sum()))
    owner = np.repeat(np.repeat(np.arange(len(held)), counts), pairs)
    known = [np.concatenate([np.array(h[k], np.int64) for h in held]) for k in (5, 6)]
    begin = [np.cumsum([len(h[k]) for h in held]) - [len(h[k]) for h in held] for k in (5, 6)]
    year, n = (known[k][begin[k][owner] + value[each + k]] for k in (0, 1))
    tile, layer = (np.array([h[k] for h in held], np.int64)[owner] for k in (0, 1))
    yield tile, list(names), layer, np.repeat(x, pairs), np.repeat(y, pairs), list(years), year, n
