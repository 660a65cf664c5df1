import math
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tilewright.functions import bor_year, keys, projection, tiling, wire
from tilewright.functions.map_keys import map_keys
from tilewright.functions.projection import GRIDS
from tilewright.sources.occurrences import SCHEMA


def record(spark, **values):
    return spark.createDataFrame([tuple(values.get(f.name) for f in SCHEMA)], SCHEMA)


def keys_of(spark, **values):
    return sorted(record(spark, **values).select(map_keys()).first()[0])


def test_map_keys(spark):
    assert keys_of(spark) == ["0:0"]
    assert keys_of(spark, speciesKey=5, taxonKey=5, networkKey=["a", None, "a"]) == ["0:0", "1:5", "6:a"]
    assert keys_of(spark, networkKey=[]) == ["0:0"]
    assert keys_of(spark, networkKey=[""]) == ["0:0", "6:"]
    assert keys_of(spark, datasetKey="d", publishingOrgKey="o", countryCode="DK", publishingCountry="DK") == ["0:0", "2:d", "3:o", "4:DK", "5:DK"]


def test_bor_year_round_trip(spark):
    rows = [("PRESERVED_SPECIMEN", None, 0), ("HUMAN_OBSERVATION", 1999, 199903), ("FOSSIL_SPECIMEN", 0, 8), ("HUMAN_OBSERVATION", -5, -497)]
    df = spark.createDataFrame(rows, "b string, y int, want int").withColumn("e", bor_year.encode(F.col("b"), F.col("y")))
    got = df.select("want", "e", bor_year.year(F.col("e")).alias("y"), bor_year.basis_of_record(F.col("e")).alias("b")).collect()
    assert [r.e for r in got] == [r.want for r in got]
    assert [(r.y, r.b) for r in got] == [(None, "PRESERVED_SPECIMEN"), (1999, "HUMAN_OBSERVATION"), (None, "FOSSIL_SPECIMEN"), (None, None)]


@pytest.mark.parametrize("basis", ["UNKNOWN", None])
def test_unknown_basis(spark, basis):
    df = spark.createDataFrame([(basis, 2000)], "b string, y int")
    assert df.select(bor_year.encode(F.col("b"), F.col("y"), strict=False)).first()[0] is None
    with pytest.raises(Exception, match="unknown basis"):
        df.select(bor_year.encode(F.col("b"), F.col("y"))).collect()


def adjacent(spark, epsg, zoom, name, x, y):
    return tuple(spark.range(1).select(*tiling.adjacent(GRIDS[epsg], zoom, name, F.lit(x), F.lit(y))).first())


@pytest.mark.parametrize("epsg", [3857, 3575, 3031])
def test_adjacency(spark, epsg):
    assert all(adjacent(spark, epsg, 0, d, 0, 0) == (0, 0) for d in tiling.DIRECTIONS)
    assert adjacent(spark, epsg, 1, "N", 0, 0) == (0, 1)
    assert adjacent(spark, epsg, 1, "E", 1, 0) == (0, 0)


def test_adjacency_two_tiles(spark):
    for x in (0, 1):
        assert adjacent(spark, 4326, 0, "N", x, 0) == adjacent(spark, 4326, 0, "S", x, 0) == (x, 0)
    assert adjacent(spark, 4326, 0, "W", 0, 0) == (1, 0)
    assert adjacent(spark, 4326, 0, "E", 1, 0) == (0, 0)


@pytest.mark.parametrize(("epsg", "zoom", "most"), [(3857, 0, 1), (4326, 0, 2), (3857, 1, 4), (4326, 1, 4), (3575, 2, 4)])
def test_addresses(spark, epsg, zoom, most):
    size, buffer = 512, 64
    across, down = GRIDS[epsg].pixels(zoom, size)
    edge = [0, 1, 63, 64, 255, 447, 448, 511]
    xs = [t * size + e for t in range(across // size) for e in edge]
    ys = [t * size + e for t in range(down // size) for e in edge]
    df = spark.createDataFrame([(x, y) for x in xs for y in ys], "x int, y int")
    for r in df.select("x", "y", tiling.addresses(epsg, zoom, F.col("x"), F.col("y")).alias("a")).collect():
        assert 1 <= len(r.a) <= most and len({(a.tileX, a.tileY) for a in r.a}) == len(r.a)
        assert (r.a[0].tileX, r.a[0].tileY, r.a[0].pixelX, r.a[0].pixelY) == (r.x // size, r.y // size, r.x % size, r.y % size)
        assert all(-buffer <= v < size + buffer for a in r.a for v in (a.pixelX, a.pixelY))
        if most == 4:
            inside = lambda v: buffer <= v % size < size - buffer
            want = (1 if inside(r.x) else 2) * (1 if inside(r.y) else 2)
            assert len(r.a) == want


def test_projection_edges(spark):
    rows = [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (-90.0, 180.0), (85.06, 1.0), (1.0, None)]
    df = spark.createDataFrame(rows, "lat double, lng double")
    for epsg, grid in GRIDS.items():
        across, down = grid.pixels(16, 512)
        for r in df.select("lat", projection.project(epsg, 16, F.col("lat"), F.col("lng")).alias("p"), "lng").collect():
            shown = r.lng is not None and {3857: abs(r.lat) <= 85.0511287798066, 3575: r.lat >= 0, 3031: r.lat <= 0, 4326: True}[epsg]
            assert (r.p is not None) == shown
            if shown:
                assert 0 <= r.p.x < across and 0 <= r.p.y < down
    assert math.isclose(projection.NORTH_RADIUS, 9009964.761231286, rel_tol=1e-12)
    assert math.isclose(projection.SOUTH_RADIUS, 12367396.21845986, rel_tol=1e-12)


def test_keys(spark):
    df = spark.range(1).select(keys.tile_key(F.lit("1:5"), 3, F.lit(2), F.lit(1)).alias("k"))
    assert df.first().k == "1:5:3:2:1"
    r = df.select("k", keys.salted(F.col("k"), 12).alias("s"), keys.salt_of(F.col("k"), 12).alias("n")).first()
    assert r.s == f"{r.n:02d}:1:5:3:2:1" and 0 <= r.n < 12
    assert df.select(keys.salt_from(keys.salted(F.col("k"), 12), 12)).first()[0] == r.n


pixels = st.dictionaries(st.tuples(st.integers(-64, 575), st.integers(-64, 575)), st.dictionaries(st.tuples(st.sampled_from([0, 1800, 2024]), st.integers(0, 8)), st.integers(1, 10**12), min_size=1), max_size=8)


@given(pixels)
@settings(max_examples=100, deadline=None)
def test_vector_tile_round_trip(tile):
    rows = [{"x": x, "y": y, "features": [{"borYear": yr * 100 + b, "occCount": n} for (yr, b), n in counts.items()]} for (x, y), counts in tile.items()]
    names = {v: k for k, v in bor_year.CODES.items()}
    want = {(names[b], x, y, str(yr) if yr else "null", n) for (x, y), counts in tile.items() for (yr, b), n in counts.items()}
    data = wire.vector_tile(rows)
    assert set(wire.read_vector_tile(data)) == want and data == wire.vector_tile(rows[::-1])


def decoded(data):
    """A vector tile read by the specification, with nothing of the package: {layer: {(x, y): {year: count}}}."""

    def numbers(raw):
        out, value, shift = [], 0, 0
        for byte in raw:
            value += (byte % 128) * 2**shift
            shift += 7
            if byte < 128:
                out.append(value)
                value = shift = 0
        return out

    def message(raw):
        found = {}
        while raw:
            size = next(i for i, b in enumerate(raw) if b < 128) + 1
            field, kind = divmod(numbers(raw[:size])[0], 8)
            raw = raw[size:]
            size = next(i for i, b in enumerate(raw) if b < 128) + 1
            value, raw = numbers(raw[:size])[0], raw[size:]
            if kind == 2:
                value, raw = raw[:value], raw[value:]
            found.setdefault(field, []).append(value)
        return found

    tile = {}
    for raw in message(data).get(3, []):
        layer = message(raw)
        assert layer[15] == [2] and len(layer[1]) == len(layer[5]) == 1
        keys, values = [k.decode() for k in layer[3]], [message(v)[4][0] for v in layer[4]]
        points = tile.setdefault(layer[1][0].decode(), {})
        for feature in map(message, layer[2]):
            assert feature[3] == [1]
            command, *at = numbers(feature[4][0])
            assert command == 9  # one MoveTo
            tags = numbers(feature[2][0])
            points[tuple(v // 2 if v % 2 == 0 else -(v + 1) // 2 for v in at)] = {keys[a]: values[b] for a, b in zip(tags[::2], tags[1::2], strict=True)}
    return tile


@given(pixels)
@settings(max_examples=60, deadline=None)
def test_vector_tile_is_read_by_another_decoder(tile):
    rows = [{"x": x, "y": y, "features": [{"borYear": yr * 100 + b, "occCount": n} for (yr, b), n in counts.items()]} for (x, y), counts in tile.items()]
    names = {v: k for k, v in bor_year.CODES.items()}
    want = {}
    for (x, y), counts in tile.items():
        for (yr, b), n in counts.items():
            want.setdefault(names[b], {}).setdefault((x, y), {})[str(yr) if yr else "null"] = n
    assert decoded(wire.vector_tile(rows)) == want


def test_a_full_tile_is_encoded_in_seconds():
    began = time.time()
    data = wire.vector_tile({"x": k % 640 - 64, "y": k // 640 - 64, "features": [{"borYear": 200003, "occCount": k}]} for k in range(400_000))
    assert time.time() - began < 20 and len(data) > 400_000 * 8


def test_tiles_are_streamed(spark, monkeypatch):
    """Tiles made row by row are those made from lists, whatever the batches."""
    monkeypatch.setattr(wire, "ENCODED_BYTES", 200)
    rows = [(k, t, 0, x, y, b, y * 100 + c, n) for k in ("0:0", "1:5") for t in (0, 1, 2) for x in (-3, 5, 500) for y in (0, 7) for b, c in (("HUMAN_OBSERVATION", 3), ("FOSSIL_SPECIMEN", 8)) for n in (x * x + c,)]
    df = spark.createDataFrame(rows, "mapKey string, tileX int, tileY int, pixelX int, pixelY int, layer string, borYear int, occCount bigint")
    got = {(r.mapKey, r.tileX): decoded(bytes(r.value)) for r in wire.encode_tiles(df).collect()}
    want = {}
    for k, t, _, x, y, b, code, n in rows:
        want.setdefault((k, t), {}).setdefault(b, {}).setdefault((x, y), {})[str(code // 100) if code >= 100 else "null"] = n
    assert got == want and wire.encode_tiles(df.limit(0)).count() == 0


def test_point_features_round_trip():
    rows = [{"lat": -1.5, "lng": 180.0, "borYear": 199903, "occCount": 7}, {"lat": 90.0, "lng": -0.25, "borYear": 8, "occCount": 1}]
    assert wire.read_point_features(wire.point_features(rows)) == [(-1.5, 180.0, 3, 1999), (90.0, -0.25, 8, 0)]
    assert wire.point_features([]) == b"" and wire.read_vector_tile(wire.vector_tile([])) == []
