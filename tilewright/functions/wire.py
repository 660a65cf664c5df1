"""Binary encodings: Mapbox vector tiles (specification 2.1) and point features as protocol buffers."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .bor_year import CODES

_NAMES = {v: k for k, v in CODES.items()}
POINT = 1
ENCODED_BYTES = 4 << 20


_ONE = [bytes([k]) for k in range(128)]


def varint(n: int) -> bytes:
    if 0 <= n < 128:
        return _ONE[n]
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def zigzag(n: int) -> int:
    return (n << 1) ^ (n >> 63)


def tagged(field: int, kind: int, payload: bytes | int) -> bytes:
    """A field: kind 0 a varint, 1 eight bytes, 2 bytes with their length."""
    head = varint(field << 3 | kind)
    if kind == 0:
        return head + varint(payload)
    return head + payload if kind == 1 else head + varint(len(payload)) + payload


def split_code(bor_year: int) -> tuple[str | None, int | None]:
    """(basis of record, year) of an encoded integer."""
    whole = int(bor_year / 100)
    return _NAMES.get(bor_year - whole * 100), whole if whole > 0 else None


class TileWriter:
    """A vector tile made from counts that come in the order of layer, then point; each byte is written once."""

    def __init__(self, extent: int = 512):
        self.extent, self.out = extent, bytearray()
        self.name: str | None = None
        self.at: tuple[int, int] | None = None

    def add(self, layer: str, x: int, y: int, year: str, count: int) -> None:
        if layer != self.name:
            self._end_layer()
            self.name, self.body = layer, bytearray(tagged(15, 0, 2) + tagged(1, 2, layer.encode()))
            self.keys: dict[str, int] = {}
            self.values: dict[int, int] = {}
        if (x, y) != self.at:
            self._end_point()
            self.at, self.counts = (x, y), {}
        self.counts[year] = count

    def _end_point(self) -> None:
        if self.at is not None:
            tags, keys, values = bytearray(), self.keys, self.values
            for year, count in sorted(self.counts.items()):
                tags += varint(keys.setdefault(year, len(keys))) + varint(values.setdefault(count, len(values)))
            shape = varint(1 | 1 << 3) + varint(zigzag(self.at[0])) + varint(zigzag(self.at[1]))
            self.body += tagged(2, 2, tagged(2, 2, bytes(tags)) + tagged(3, 0, POINT) + tagged(4, 2, shape))
            self.at = None

    def _end_layer(self) -> None:
        self._end_point()
        if self.name is not None:
            self.body += b"".join(tagged(3, 2, k.encode()) for k in self.keys)
            self.body += b"".join(tagged(4, 2, tagged(4, 0, v)) for v in self.values)
            self.body += tagged(5, 0, self.extent)
            self.out += varint(3 << 3 | 2) + varint(len(self.body))
            self.out += self.body
            self.name = None

    def finish(self) -> bytes:
        self._end_layer()
        return bytes(self.out)


def year_label(year: int | None) -> str:
    return "null" if year is None else str(year)


def vector_tile(pixels: Iterable[dict], extent: int = 512) -> bytes:
    """A tile of pixels {x, y, features: [{borYear, occCount}]}.

    One layer for each basis of record, one point for each pixel and basis, an attribute for each year with its
    count; without a year the attribute is "null". Layers, points and attributes are sorted, so equal tiles have
    equal bytes. If a year is there twice for a pixel and basis, the greatest code's count holds.
    """
    tile = TileWriter(extent)
    rows = [(str(split_code(f["borYear"])[0]), p["x"], p["y"], f["borYear"], f["occCount"]) for p in pixels for f in p["features"]]
    for layer, x, y, code, count in sorted(rows):
        tile.add(layer, x, y, year_label(split_code(code)[1]), count)
    return tile.finish()


def encode_tiles(rows: DataFrame, extent: int = 512) -> DataFrame:
    """(mapKey, tileX, tileY, value) from rows (mapKey, tileX, tileY, pixelX, pixelY, layer, borYear, occCount).

    A tile's rows are sorted and streamed through a writer, so a task holds one tile's bytes, and no list of its pixels, however
    many records a view has.
    """
    columns = ("mapKey", "tileX", "tileY", "layer", "pixelX", "pixelY", "borYear", "occCount")
    dealt = rows.select(*columns).repartition("mapKey", "tileX", "tileY").sortWithinPartitions(*columns[:7])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        size, last, tile = 0, None, TileWriter(extent)
        labels: dict[int, str] = {}

        def flush() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], [*columns[:3], "value"])

        for batch in batches:
            for first in range(0, batch.num_rows, 10_000):
                for key, tx, ty, layer, x, y, code, count in zip(*[c.to_pylist() for c in batch.slice(first, 10_000).columns], strict=True):
                    if (key, tx, ty) != last:
                        if last is not None:
                            made.append((*last, tile.finish()))
                            size += len(made[-1][3])
                            if size > ENCODED_BYTES:
                                yield flush()
                                made, size = [], 0
                        last, tile = (key, tx, ty), TileWriter(extent)
                    if code not in labels:
                        labels[code] = year_label(split_code(code)[1])
                    tile.add(layer, x, y, labels[code], count)
        if last is not None:
            made.append((*last, tile.finish()))
            yield flush()

    return dealt.mapInArrow(run, "mapKey string, tileX int, tileY int, value binary")


def point_features(features: Iterable[dict]) -> bytes:
    """Features {lat, lng, borYear}: latitude 1 and longitude 2 as doubles, basis 3 as an enum, year 4 (0 for none)."""
    out = []
    for f in sorted(features, key=lambda f: (f["lat"], f["lng"], f["borYear"])):
        basis, year = split_code(f["borYear"])
        fields = tagged(1, 1, struct.pack("<d", f["lat"])) + tagged(2, 1, struct.pack("<d", f["lng"]))
        out.append(tagged(1, 2, fields + tagged(3, 0, CODES.get(basis, 0)) + tagged(4, 0, year or 0)))
    return b"".join(out)


def encode_column(frame: DataFrame, column: str, encoder, keep: list[str], value: str = "value") -> DataFrame:
    """``keep`` columns and ``value``, the bytes that ``encoder`` makes of each row's ``column``; in Arrow batches."""
    shape = ", ".join([*[f"`{k}` {frame.schema[k].dataType.simpleString()}" for k in keep], f"`{value}` binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                encoded = pa.array([encoder(x.as_py()) for x in part.column(len(keep))], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], encoded], [*keep, value])

    return frame.select(*keep, column).mapInArrow(run, shape)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0

    def number() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 0x7F) << shift
            if b < 0x80:
                return n
            shift += 7

    while at < len(data):
        head = number()
        if head & 7 == 0:
            yield head >> 3, number()
        else:
            size = 8 if head & 7 == 1 else number()
            yield head >> 3, data[at : at + size]
            at += size


def _packed(data: bytes) -> list[int]:
    out, n, shift = [], 0, 0
    for b in data:
        n |= (b & 0x7F) << shift
        shift += 7
        if b < 0x80:
            out.append(n)
            n = shift = 0
    return out


def read_vector_tile(data: bytes) -> list[tuple[str, int, int, str, int]]:
    """(layer, x, y, year, count) rows of a tile."""
    unzig = lambda n: (n >> 1) ^ -(n & 1)
    rows = []
    for _, layer in _fields(data):
        fields = list(_fields(layer))
        name = next(v for k, v in fields if k == 1).decode()
        keys = [v.decode() for k, v in fields if k == 3]
        values = [dict(_fields(v))[4] for k, v in fields if k == 4]
        for k, v in fields:
            if k == 2:
                feature = dict(_fields(v))
                tags, (_, x, y) = _packed(feature.get(2, b"")), _packed(feature[4])
                rows += [(name, unzig(x), unzig(y), keys[a], values[b]) for a, b in zip(tags[::2], tags[1::2], strict=True)]
    return rows


def read_point_features(data: bytes) -> list[tuple[float, float, int, int]]:
    """(latitude, longitude, basis code, year) rows of a point list."""
    rows = []
    for _, feature in _fields(data):
        f = dict(_fields(feature))
        rows.append((struct.unpack("<d", f[1])[0], struct.unpack("<d", f[2])[0], f[3], f[4]))
    return rows
