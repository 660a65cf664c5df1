"""All zooms of all projections from one shuffle of records, which are fanned out to their views only after it.

A record's pixel at the highest zoom is a Morton code, which two bits fewer turn into the pixel of the zoom below. Records
are dealt out by their pixel at the lowest zoom and sorted by code, so all that meets in a pixel of any zoom comes to one task in
one run. There they are fanned out and sorted by view, basis and year, and pixel; from then on each lower zoom is a sum over
neighbouring rows. A task holds about CHUNK records, and for each zoom the sums of the one pixel that is not at its end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tile_arrays, tile_packs
from ..functions.map_keys import map_keys
from ..functions.projection import GRIDS, global_pixel, plottable
from ..operators import views
from ..sources.shared import lean

CHUNK = 40_000
_BITS = 56
_LOW = np.int64((1 << _BITS) - 1)
_STEPS = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))

Rows = tuple[np.ndarray, np.ndarray, np.ndarray]
#: (number of the projection, x, y, view's number, borYear, occCount) of the whole pixels of a zoom
Level = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _spread(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.uint64)
    for shift, mask in _STEPS:
        v = (v | v << np.uint64(shift)) & np.uint64(mask)
    return v


def _gather(v: np.ndarray) -> np.ndarray:
    v = v & np.uint64(_STEPS[-1][1])
    masks = [m for _, m in _STEPS]
    for (shift, _), mask in zip(reversed(_STEPS), [*reversed(masks[:-1]), 0xFFFFFFFF], strict=True):
        v = (v | v >> np.uint64(shift)) & np.uint64(mask)
    return v.astype(np.int64)


def morton(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (_spread(x) | _spread(y) << np.uint64(1)).astype(np.int64)


def unmorton(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code = code.astype(np.uint64)
    return _gather(code), _gather(code >> np.uint64(1))


def _numbers(keys: pa.ListArray, known: pa.Array) -> tuple[np.ndarray, pa.ListArray]:
    """How many of each record's keys are among ``known``, and their numbers there."""
    number = pc.index_in(keys.flatten(), value_set=known)
    kept = number.is_valid().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(keys)), pc.list_value_length(keys).to_numpy(zero_copy_only=False))[kept]
    sizes = np.bincount(owner, minlength=len(keys))
    return sizes, pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), number.drop_null().cast(pa.int32()))


def _deal(names, projections: int, down: int):
    """(route, code, borYear, views) of each record in each projection that shows it; views are numbers in ``names``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(names.value, pa.string())
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sizes, lists = _numbers(batch.column(1), known)
            for k in range(projections):
                x, y = batch.column(2 + 2 * k), batch.column(3 + 2 * k)
                shown = x.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0)
                if not shown.any():
                    continue
                code = morton(x.fill_null(0).to_numpy(), y.fill_null(0).to_numpy())
                route = (code >> np.int64(2 * down)) << np.int64(4) | np.int64(k)
                code |= np.int64(k << _BITS)
                yield pa.RecordBatch.from_arrays([pa.array(route), pa.array(code), batch.column(0), lists], ["route", "code", "borYear", "views"]).filter(pa.array(shown))

    return run


def _summed(g: np.ndarray, m: np.ndarray, n: np.ndarray) -> Rows:
    """Sums of rows that are sorted by (g, m)."""
    if not len(g):
        return g, m, n
    begin = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (m[1:] != m[:-1])))
    return (g, m, n) if len(begin) == len(g) else (g[begin], m[begin], np.add.reduceat(n, begin))


class _Zooms:
    """Sums at every zoom, of records that come in the order of their codes."""

    def __init__(self, n_views: int, max_zoom: int, min_zoom: int):
        self.n_views, self.top, self.low = n_views, max_zoom, min_zoom
        self.open: dict[int, Rows] = {}
        self.numbers: dict[int, int] = {}

    def add(self, code: np.ndarray, bor: np.ndarray, sizes: np.ndarray, view: np.ndarray, last: int | None) -> Iterator[tuple[int, Level]]:
        """Records of one chunk. ``last``: a code whose pixels go on after the chunk, at all zooms."""
        found, at = np.unique(bor, return_inverse=True)
        numbers = np.array([self.numbers.setdefault(b, len(self.numbers)) for b in found.tolist()], np.int64)
        values = np.array(list(self.numbers), np.int64)
        place = np.cumsum(np.append(False, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
        bits = np.int64(max(1, int(len(code)).bit_length()))
        packed = np.repeat(numbers[at] * self.n_views, sizes) + view
        packed = np.sort(packed << bits | np.repeat(place, sizes))
        new = np.append(True, packed[1:] != packed[:-1]) if len(packed) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        n = np.diff(np.append(begin, len(packed)))
        packed = packed[begin]
        g, m = packed >> bits, code[np.append(True, code[1:] != code[:-1])][packed & ((np.int64(1) << bits) - np.int64(1))] if len(code) else packed
        for zoom in range(self.top, self.low - 1, -1):
            if zoom in self.open:
                g, m, n = (np.concatenate(c) for c in zip(self.open.pop(zoom), (g, m, n), strict=True))
                order = np.lexsort((m, g))
                g, m, n = g[order], m[order], n[order]
            g, m, n = _summed(g, m, n)
            if last is not None:
                goes_on = m == last
                self.open[zoom] = g[goes_on], m[goes_on], n[goes_on]
                g, m, n = g[~goes_on], m[~goes_on], n[~goes_on]
                last = last & ~int(_LOW) | (last & int(_LOW)) >> 2
            if len(g):
                x, y = unmorton(m & _LOW)
                yield zoom, (m >> np.int64(_BITS), x, y, g % self.n_views, values[g // self.n_views], n)
            m = m & ~_LOW | (m & _LOW) >> np.int64(2)


def zooms_of(batches: Iterator[pa.RecordBatch], n_views: int, max_zoom: int, min_zoom: int, chunk: int = CHUNK) -> Iterator[tuple[int, Level]]:
    """(zoom, whole pixels) of rows (route, code, borYear, views) sorted by code; a pixel's rows come once."""
    zooms, held, size = _Zooms(n_views, max_zoom, min_zoom), None, 0

    def parts(rows: pa.RecordBatch):
        code, bor = (rows.column(k).to_numpy() for k in (1, 2))
        return code, bor, pc.list_value_length(rows.column(3)).to_numpy(), rows.column(3).flatten().to_numpy()

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        size += batch.num_rows
        if size < chunk:
            continue
        held = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        route = held.column(0).to_numpy()
        ended = int(np.flatnonzero(np.append(True, route[1:] != route[:-1]))[-1])
        if ended:
            yield from zooms.add(*parts(held.slice(0, ended)), None)
            waiting = [held.slice(ended)]
        else:  # a place so crowded that one pixel of the lowest zoom fills the chunk
            yield from zooms.add(*parts(held), int(held.column(1)[-1].as_py()))
            waiting = []
        size = sum(b.num_rows for b in waiting)
    if waiting:
        held = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        yield from zooms.add(*parts(held), None)
    elif zooms.open:
        none = np.zeros(0, np.int64)
        yield from zooms.add(none, none, none, none, None)


def _placed(records: DataFrame, projections: tuple[int, ...], max_zoom: int, tile_size: int, strict: bool) -> DataFrame:
    """(borYear, keys, x0, y0, x1, y1, ...): each record's pixel in each projection, null where it is not shown. EPSG:3031 has the places that a map of the south may show."""
    lat, lng = F.col("lat"), F.col("lng")
    placed = []
    for k, epsg in enumerate(projections):
        shown = plottable(epsg, lat) & lng.isNotNull() & ((lat <= 1.0) if epsg == 3031 else F.lit(True))
        placed += [F.when(shown, c).alias(f"{name}{k}") for name, c in zip("xy", global_pixel(epsg, max_zoom, lat, lng, tile_size), strict=True)]
    return views.compact(records, strict).select("borYear", map_keys().alias("keys"), *placed)


def sweep(
    records: DataFrame, large: list[str], projections: tuple[int, ...], max_zoom: int, min_zoom: int, finish: Callable[[Iterator[tuple[int, Level]], list[str]], Iterator[pa.RecordBatch]], shape: str,
    tile_size: int = 512, strict: bool = True, chunk: int = CHUNK,
) -> DataFrame:
    """What ``finish`` makes of (zoom, whole pixels) of the views in ``large``, task by task; its rows are of ``shape``.

    A pixel's rows come in one piece and once.
    """
    names = records.sparkSession.sparkContext.broadcast(large)
    rows = _placed(records, projections, max_zoom, tile_size, strict)
    dealt = rows.mapInArrow(_deal(names, len(projections), max_zoom - min_zoom), "route bigint, code bigint, borYear int, views array<int>").repartition("route").sortWithinPartitions("code")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from finish(zooms_of(batches, len(names.value), max_zoom, min_zoom, chunk), names.value)

    return dealt.mapInArrow(run, shape)


PIXELS = "epsg int, z int, mapKey string, x int, y int, borYear int, occCount bigint"


def pixel_rows(projections: tuple[int, ...]):
    """The rows of each zoom as they are."""

    def finish(levels: Iterator[tuple[int, Level]], names: list[str]) -> Iterator[pa.RecordBatch]:
        known, codes = pa.array(names, pa.string()), np.array(projections, np.int32)
        for zoom, level in levels:
            for first in range(0, len(level[0]), 100_000):
                k, x, y, view, bor, n = (c[first : first + 100_000] for c in level)
                columns = [pa.array(codes[k]), pa.array(np.full(len(k), zoom, np.int32)), known.take(pa.array(view)), *[pa.array(c.astype(np.int32)) for c in (x, y, bor)], pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["epsg", "z", "mapKey", "x", "y", "borYear", "occCount"])

    return finish


TOTALS = "epsg int, z int, pixels bigint, records bigint, check_sum bigint"


def totals(projections: tuple[int, ...]):
    """Pixels, records and a check sum of what each task has of a zoom, to be summed."""

    def finish(levels: Iterator[tuple[int, Level]], names: list[str]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list[int]] = {}
        for zoom, (k, x, y, _, bor, n) in levels:
            check = (x * 31 + y * 17 + bor) * n % 1000003
            for p in range(len(projections)) if k[0] != k[-1] or k.min() != k.max() else [int(k[0])]:
                mine = k == p
                if mine.any():
                    held = found.setdefault((projections[p], zoom), [0, 0, 0])
                    for at, more in enumerate((mine.sum(), n[mine].sum(), check[mine].sum())):
                        held[at] += int(more)
        rows = [(*place, *sums) for place, sums in found.items()]
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["epsg", "z", "pixels", "records", "check_sum"])

    return finish


def on_tiles(grid: tuple[int, int], x: np.ndarray, y: np.ndarray, tile_size: int, buffer: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(pixels' numbers, tileX, tileY, x and y there): all pixels on their own tiles, then those in the buffer of a neighbour, side by side."""
    (nx, ny), (tx, ty) = grid, (x // tile_size, y // tile_size)
    wide, high = (g * tile_size for g in (nx, ny))
    near = {}
    for axis, at, count in (("x", x % tile_size, nx), ("y", y % tile_size, ny)):
        near[axis, 0] = np.ones(len(x), bool)
        near[axis, -1] = (at < buffer) if count > 1 else np.zeros(len(x), bool)  # alone on its axis, a tile is its own neighbour
        near[axis, 1] = (at >= tile_size - buffer) & ~(near[axis, -1] if count == 2 else False) if count > 1 else near[axis, -1]
    for dx in (0, -1, 1):
        for dy in (0, -1, 1):
            k = np.flatnonzero(near["x", dx] & near["y", dy])
            if len(k):
                ax, ay = (tx[k] + dx) % nx, (ty[k] + dy) % ny
                px, py = x[k] - ax * tile_size, y[k] - ay * tile_size
                for at, world in ((px, wide), (py, high)):
                    low, far = at < -buffer, at >= tile_size + buffer
                    at[low] += world
                    at[far] -= world
                yield k, ax, ay, px, py


PIECES = "epsg int, z int, mapKey string, tileX int, tileY int, piece binary"
PIECE_BUFFER = 1_000_000


def tile_pieces(projections: tuple[int, ...], tile_size: int = 512, buffer: int = 64):
    """Counts of tiles, buffers included, packed tile by tile as far as a task has them."""
    grids = [GRIDS[epsg] for epsg in projections]

    def spread(zoom: int, level: Level) -> Iterator[tuple[np.ndarray, ...]]:
        """(projection, view, tileX, tileY, packed counts) for each pixel's own tile, then for those whose buffer holds it."""
        for p in np.unique(level[0]).tolist():
            mine = slice(None) if level[0].min() == level[0].max() else level[0] == p
            x, y, view, bor, n = (c[mine] for c in level[1:])
            for k, ax, ay, px, py in on_tiles(grids[p].tiles(zoom), x, y, tile_size, buffer):
                yield np.full(len(k), p), view[k], ax, ay, tile_arrays.pack(px, py, bor[k], n[k], buffer)

    def pieces(zoom: int, held: list[tuple[np.ndarray, ...]], known: pa.Array) -> Iterator[pa.RecordBatch]:
        p, view, tx, ty, counts = (np.concatenate(c) for c in zip(*held, strict=True))
        tile = ((p << 20 | view) << zoom + 1 | tx) << zoom + 1 | ty
        order = np.argsort(tile, kind="stable")
        p, view, tx, ty, counts, tile = (c[order] for c in (p, view, tx, ty, counts, tile))
        new = np.append(True, tile[1:] != tile[:-1])
        begin = np.flatnonzero(new)
        rank = np.arange(len(tile)) - np.repeat(begin, np.diff(np.append(begin, len(tile))))
        begin = np.flatnonzero(rank % tile_arrays.PIECE_ROWS == 0)
        for first in range(0, len(begin), 4096):
            k = begin[first : first + 4096]
            end = begin[first + 4096] if first + 4096 < len(begin) else len(tile)
            offsets = ((np.append(k, end) - k[0]) * tile_arrays.COUNT.itemsize).astype(np.int32)
            piece = pa.Array.from_buffers(pa.binary(), len(k), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(counts[k[0] : end].tobytes())])
            epsg = np.array(projections, np.int32)[p[k]]
            columns = [pa.array(epsg), pa.array(np.full(len(k), zoom, np.int32)), known.take(pa.array(view[k])), *[pa.array(c[k].astype(np.int32)) for c in (tx, ty)], piece]
            yield pa.RecordBatch.from_arrays(columns, ["epsg", "z", "mapKey", "tileX", "tileY", "piece"])

    def finish(levels: Iterator[tuple[int, Level]], names: list[str]) -> Iterator[pa.RecordBatch]:
        known, held, size = pa.array(names, pa.string()), {}, 0
        for zoom, level in levels:
            for part in spread(zoom, level):
                held.setdefault(zoom, []).append(part)
                size += len(part[0])
            if size > PIECE_BUFFER:
                for z, parts in held.items():
                    yield from pieces(z, parts, known)
                held, size = {}, 0
        for z, parts in held.items():
            yield from pieces(z, parts, known)

    return finish


#: Records times views that a task packs at a time.
PACK_BUFFER = 3_000_000
PACK_PART = 300_000


def numbered(records: DataFrame, large: list[str], projections: tuple[int, ...], max_zoom: int, tile_size: int = 512, strict: bool = True) -> DataFrame:
    """(borYear, views, x0, y0, x1, y1, ...) of the records in a view of ``large``; views are numbers there."""
    names = records.sparkSession.sparkContext.broadcast(large)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(names.value, pa.string())
        for batch in batches:
            if batch.num_rows:
                sizes, lists = _numbers(batch.column(1), known)
                yield pa.RecordBatch.from_arrays([batch.column(0), lists, *batch.columns[2:]], ["borYear", "views", *batch.schema.names[2:]]).filter(pa.array(sizes > 0))

    places = ", ".join(f"x{k} int, y{k} int" for k in range(len(projections)))
    return _placed(records, projections, max_zoom, tile_size, strict).mapInArrow(run, f"borYear int, views array<int>, {places}")


def packs(places: DataFrame, large: list[str], epsg: int, zoom: int, max_zoom: int, tile_size: int = 512, buffer: int = 64) -> DataFrame:
    """(mapKey, tileX, tileY, piece) of one zoom from (borYear, views, x, y) at ``max_zoom``: records summed, tile by tile, as far as a task has them at a time."""
    names, most = places.sparkSession.sparkContext.broadcast(large), PACK_BUFFER
    bits, grid = tile_packs.bits_of(tile_size + 2 * buffer), GRIDS[epsg].tiles(zoom)

    def packed(rows: pa.RecordBatch, known: pa.Array) -> Iterator[pa.RecordBatch]:
        x, y = (rows.column(k).to_numpy().astype(np.int64) >> max_zoom - zoom for k in (2, 3))
        layers, layer = np.unique(tile_packs.by_layer(rows.column(0).to_numpy()), return_inverse=True)
        view, sizes = rows.column(1).flatten().to_numpy().astype(np.int64), pc.list_value_length(rows.column(1)).to_numpy().astype(np.int64)
        starts, low, placed = np.cumsum(sizes) - sizes, 2 * bits + len(layers).bit_length(), []
        ids, most_bits = None, len(known).bit_length() + 2 * zoom + 2
        for k, ax, ay, px, py in on_tiles(grid, x, y, tile_size, buffer):
            many = sizes[k]
            own = view if len(k) == len(x) else view[np.repeat(starts[k] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))]
            tile, count = ax << zoom + 1 | ay, (layer[k] << bits | px + buffer) << bits | py + buffer
            placed.append((own << 2 * zoom + 2 | np.repeat(tile, many), np.repeat(count, many)) if most_bits + low > 63 else own << 2 * zoom + 2 + low | np.repeat(tile << low | count, many))
        if most_bits + low > 63:  # tiles' numbers are too long beside the counts
            ids, tile = np.unique(np.concatenate([c for c, _ in placed]), return_inverse=True)
            placed = [tile << low | np.concatenate([c for _, c in placed])]
        every = np.concatenate(placed)
        del placed, view
        every.sort()
        first, cuts = 0, np.flatnonzero(every[1:] >> low != every[:-1] >> low) + 1
        while first < len(every):  # some whole tiles at a time
            k = int(np.searchsorted(cuts, first + PACK_PART))
            end = int(cuts[k]) if k < len(cuts) else len(every)
            yield pieces(every[first:end], layers, low, ids, known)
            first = end

    def pieces(part: np.ndarray, layers: np.ndarray, low: int, ids: np.ndarray | None, known: pa.Array) -> pa.RecordBatch:
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        n, part = np.diff(np.append(first, len(part))), part[first]
        tile, key = part >> low, part & (1 << low) - 1
        key = layers[key >> 2 * bits] << 2 * bits | key & (1 << 2 * bits) - 1
        begin = np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))
        tile = tile[begin] if ids is None else ids[tile[begin]]
        data, offsets = tile_packs.pack(key, n, begin)
        piece = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
        at = [pa.array(c.astype(np.int32)) for c in ((tile >> zoom + 1) & (1 << zoom + 1) - 1, tile & (1 << zoom + 1) - 1)]
        return pa.RecordBatch.from_arrays([known.take(pa.array(tile >> 2 * zoom + 2)), *at, piece], ["mapKey", "tileX", "tileY", "piece"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = pa.array(names.value, pa.string()), [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += len(batch.column(1).flatten())
                if size >= most:
                    yield from packed(tile_arrays._one(held), known)
                    held, size = [], 0
        if held:
            yield from packed(tile_arrays._one(held), known)

    return places.filter(F.col("x").isNotNull()).mapInArrow(lean(run), "mapKey string, tileX int, tileY int, piece binary")
