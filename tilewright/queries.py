"""Registered queries of the map engine, each with the same result in DuckDB SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import bor_year, keys, projection, tile_arrays, tile_packs, tiling, wire
from .operators import layout, points, tiles, views
from .plans import build, lifecycle, pyramid, sweep
from .plans.config import Config, Manifest
from .sources import cells, fixtures, occurrences
from .sources.shared import lean, shared_dir, short_lived_shuffles

THRESHOLD = 1000
MODULUS = 12
PIXEL_ZOOM = 16
TILE_ZOOM = 3
CASCADE_TOP = 4
BUILD_TOP, BUILD_PROJECTIONS = 2, (4326, 3031)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.occurrences(spark, sf_dir)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occurrences.map_input(_raw(spark, sf_dir))


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.view_sizes(_records(spark, sf_dir))


def _large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.at_least(_sizes(spark, sf_dir), THRESHOLD)


def _counts(spark: SparkSession, sf_dir: str, approve: bool) -> DataFrame:
    return views.counts_of_views(_records(spark, sf_dir), _large(spark, sf_dir), approve)


@query
def occ_filter(spark, sf_dir):
    return _records(spark, sf_dir).withColumn("networks", F.coalesce(F.array_join("networkKey", "|", "~"), F.lit("none"))).drop("networkKey")


@query
def map_keys_explode(spark, sf_dir):
    return views.fan_out(_records(spark, sf_dir)).select("mapKey", F.col("decimalLatitude").alias("lat"), F.col("decimalLongitude").alias("lng"), "taxonKey")


@query
def map_key_counts(spark, sf_dir):
    return _sizes(spark, sf_dir)


@query
def large_map_keys(spark, sf_dir):
    return _large(spark, sf_dir)


def _kept(spark, sf_dir, approve):
    rows = views.fan_out(_records(spark, sf_dir)).select("mapKey", "year")
    return views.select_views(rows, _large(spark, sf_dir), approve).groupBy("mapKey").agg(F.count("*").alias("records"), F.count("year").alias("dated"))


@query
def approve_keys(spark, sf_dir):
    return _kept(spark, sf_dir, True)


@query
def deny_keys(spark, sf_dir):
    return _kept(spark, sf_dir, False)


@query
def bor_year_encode(spark, sf_dir):
    r = _raw(spark, sf_dir)
    return r.select("basisOfRecord", "year", bor_year.encode(F.col("basisOfRecord"), F.col("year")).alias("borYear")).groupBy("basisOfRecord", "year", "borYear").agg(F.count("*").alias("n"))


@query
def bor_year_decode(spark, sf_dir):
    r = _raw(spark, sf_dir).select(bor_year.encode(F.col("basisOfRecord"), F.col("year")).alias("borYear"))
    every = r.select("borYear").union(r.select((-F.col("borYear") + 6).alias("borYear"))).distinct()
    return every.select("borYear", bor_year.year(F.col("borYear")).alias("year"), bor_year.basis_of_record(F.col("borYear")).alias("basisOfRecord"))


@query
def tile_input(spark, sf_dir):
    return _counts(spark, sf_dir, True)


@query
def point_counts(spark, sf_dir):
    return _counts(spark, sf_dir, False)


@query
def point_features(spark, sf_dir):
    made = points.assemble(_counts(spark, sf_dir, False)).select("mapKey", F.explode("features").alias("f"))
    return made.select("mapKey", "f.*")


def _pixels(epsg: int) -> Query:
    def run(spark, sf_dir):
        places = _records(spark, sf_dir).select(F.col("decimalLatitude").alias("lat"), F.col("decimalLongitude").alias("lng"))
        shown = places.filter(projection.plottable(epsg, F.col("lat")))
        x, y = projection.global_pixel(epsg, PIXEL_ZOOM, F.col("lat"), F.col("lng"))
        return shown.select("lat", "lng", x.alias("x"), y.alias("y"))

    return run


def _tiles(epsg: int) -> Query:
    def run(spark, sf_dir):
        counts = _counts(spark, sf_dir, True)
        counts = tiles.south(counts) if epsg == 3031 else counts
        rows = tiles.tile_rows(tiles.pixel_counts(counts, epsg, TILE_ZOOM), epsg, TILE_ZOOM)
        made = tiles.assemble(rows, TILE_ZOOM).select("mapKey", "z", "tileX", "tileY", F.explode("tile").alias("p"))
        made = made.select("mapKey", "z", "tileX", "tileY", "p.x", "p.y", F.explode("p.features").alias("f"))
        return made.select(keys.tile_key(F.col("mapKey"), F.col("z"), F.col("tileX"), F.col("tileY")).alias("tile"), "x", "y", "f.borYear", "f.occCount")

    return run


for _epsg in projection.GRIDS:
    QUERIES[f"global_pixel_{_epsg}"] = _pixels(_epsg)
    QUERIES[f"tiles_{_epsg}"] = _tiles(_epsg)


@query
def south_filter(spark, sf_dir):
    return tiles.south(_counts(spark, sf_dir, True))


@query
def pixel_counts(spark, sf_dir):
    return tiles.pixel_counts(_counts(spark, sf_dir, True), 3857, TILE_ZOOM)


@query
def pixel_features(spark, sf_dir):
    made = tiles.pixel_features(tiles.pixel_counts(_counts(spark, sf_dir, True), 3857, TILE_ZOOM)).select("mapKey", "x", "y", F.explode("features").alias("f"))
    return made.select("mapKey", "x", "y", "f.*")


@query
def tile_adjacency(spark, sf_dir):
    out = None
    for grid in projection.GRIDS.values():
        for zoom in (0, 1, 2):
            across, down = grid.tiles(zoom)
            cells = spark.range(across * down).select((F.col("id") % across).cast("int").alias("x"), F.floor(F.col("id") / across).cast("int").alias("y"))
            for name in tiling.DIRECTIONS:
                x, y = tiling.adjacent(grid, zoom, name, F.col("x"), F.col("y"))
                part = cells.select(F.lit(grid.epsg).alias("epsg"), F.lit(zoom).alias("z"), "x", "y", F.lit(name).alias("direction"), x.alias("to_x"), y.alias("to_y"))
                out = part if out is None else out.unionByName(part)
    return out


@query
def tile_addresses(spark, sf_dir):
    pixels = _pixels_at(spark, sf_dir)
    at = tiling.addresses(4326, TILE_ZOOM, F.col("x"), F.col("y"))
    return pixels.select("x", "y", F.explode(at).alias("at")).select("x", "y", "at.*")


def _pixels_at(spark, sf_dir):
    x, y = projection.global_pixel(4326, TILE_ZOOM, F.col("decimalLatitude"), F.col("decimalLongitude"))
    return _records(spark, sf_dir).select(x.alias("x"), y.alias("y")).distinct()


def _swept(spark, sf_dir, projections, max_zoom, finish, shape):
    """All zooms of the large views in one sweep; more views than can be broadcast are summed by shuffles."""
    _, large = views.measured(_large(spark, sf_dir), views.BROADCAST_KEYS)
    if large is not None:
        return sweep.sweep(_records(spark, sf_dir), [r.mapKey for r in large], projections, max_zoom, 0, finish(projections), shape)
    counts = _counts(spark, sf_dir, True)
    every = reduce(DataFrame.unionByName, [pyramid.pyramid(tiles.south(counts) if epsg == 3031 else counts, epsg, max_zoom) for epsg in projections])
    if shape == sweep.PIXELS:
        return every
    check = (F.col("x").cast("bigint") * 31 + F.col("y").cast("bigint") * 17 + F.col("borYear")) * F.col("occCount")
    return every.groupBy("epsg", "z").agg(F.count("*").alias("pixels"), F.sum("occCount").alias("records"), F.sum(F.pmod(check, F.lit(1000003))).alias("check_sum"))


@query
def zoom_cascade(spark, sf_dir):
    return _swept(spark, sf_dir, (3857, 3031), CASCADE_TOP, sweep.pixel_rows, sweep.PIXELS)


@query
def pyramid_totals(spark, sf_dir):
    """All projections from zoom 16 down to 0, as a build makes them: pixels, records and a check sum of each zoom."""
    parts = _swept(spark, sf_dir, tuple(projection.GRIDS), PIXEL_ZOOM, sweep.totals, sweep.TOTALS)
    return parts.groupBy("epsg", "z").agg(*[F.sum(c).alias(c) for c in ("pixels", "records", "check_sum")])


@query
def tile_layer_attributes(spark, sf_dir):
    rows = tiles.tile_rows(tiles.pixel_counts(_counts(spark, sf_dir, True), 4326, TILE_ZOOM), 4326, TILE_ZOOM)
    return tiles.layer_attributes(rows)


def _tile_keys(spark, sf_dir):
    rows = tiles.tile_rows(tiles.pixel_counts(_counts(spark, sf_dir, True), 4326, TILE_ZOOM), 4326, TILE_ZOOM)
    return rows.select("mapKey", "tileX", "tileY").distinct().select(keys.tile_key(F.col("mapKey"), TILE_ZOOM, F.col("tileX"), F.col("tileY")).alias("key"))


@query
def salted_tile_key(spark, sf_dir):
    return _tile_keys(spark, sf_dir).select("key", keys.salted(F.col("key"), MODULUS).alias("row_key"))


@query
def salted_point_key(spark, sf_dir):
    return _sizes(spark, sf_dir).select("mapKey", keys.salted(F.col("mapKey"), MODULUS).alias("row_key"))


@query
def salt_layout(spark, sf_dir):
    placed = layout.by_salt(_tile_keys(spark, sf_dir).select(keys.salted(F.col("key"), MODULUS).alias("row_key")), MODULUS)
    return placed.groupBy(F.spark_partition_id().alias("salt")).agg(F.count("*").alias("n"), F.min("row_key").alias("first"), F.max("row_key").alias("last"))


RETENTION = [(m, f"maps_{m}_2020010{d}_{h}00") for m in ("tiles", "points") for d, h in ((1, "00"), (3, "12"), (2, "06"), (4, "00"))][:-1]


@query
def table_retention(spark, sf_dir):
    return layout.superseded(spark.createDataFrame(RETENTION, "mode string, name string"))


@query
def mvt_bytes(spark, sf_dir):
    _, large = views.measured(_large(spark, sf_dir), views.BROADCAST_KEYS)
    if large is not None:
        pieces = sweep.sweep(_records(spark, sf_dir), [r.mapKey for r in large], (4326,), TILE_ZOOM, TILE_ZOOM, sweep.tile_pieces((4326,)), sweep.PIECES)
        return tiles.piece_cells(pieces, 4326, TILE_ZOOM, MODULUS)
    rows = tiles.tile_rows(tiles.pixel_counts(_counts(spark, sf_dir, True), 4326, TILE_ZOOM), 4326, TILE_ZOOM)
    return tiles.cells(rows, 4326, TILE_ZOOM, MODULUS)


@query
def point_pb_bytes(spark, sf_dir):
    return points.cells(points.assemble(_counts(spark, sf_dir, False)), MODULUS)


_TILE_SHAPE = "mapKey string, tileX int, tileY int, layer string, pixelX int, pixelY int, year string, occCount bigint"


def _tile_rows_of(stored: DataFrame) -> DataFrame:
    """Tile cells decoded: what ``tile_layer_attributes`` says of them."""
    key = F.split("row_key", ":")  # salt, view type, view, zoom, x, y
    named = stored.select(F.concat_ws(":", key[1], key[2]).alias("mapKey"), key[4].cast("int").alias("tileX"), key[5].cast("int").alias("tileY"), "value")

    def decode(batches):
        for batch in batches:
            for some in tile_packs.parts([batch], 3):
                for at, layers, layer, x, y, years, year, n in tile_arrays.read(some.column(3).to_pylist()):
                    own = [c.take(pa.array(at)) for c in some.columns[:3]]
                    said = [pa.array(names, pa.string()).take(pa.array(k)) for names, k in ((layers, layer), (years, year))]
                    columns = [*own, said[0], pa.array(x.astype(np.int32)), pa.array(y.astype(np.int32)), said[1], pa.array(n)]
                    rows = pa.RecordBatch.from_arrays(columns, ["mapKey", "tileX", "tileY", "layer", "pixelX", "pixelY", "year", "occCount"])
                    yield from (rows.slice(k, 50_000) for k in range(0, rows.num_rows, 50_000))

    return named.mapInArrow(lean(decode), _TILE_SHAPE)


def _point_rows_of(stored: DataFrame) -> DataFrame:
    """Point cells decoded: (mapKey, lat, lng, basis, year)."""

    def decode(batches):
        for batch in batches:
            rows = [(k.split(":", 1)[1], *r) for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for r in wire.read_point_features(v)]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["mapKey", "lat", "lng", "basis", "year"])

    return stored.select("row_key", "value").mapInArrow(decode, "mapKey string, lat double, lng double, basis bigint, year bigint")


def _scratch(spark: SparkSession, stem: str) -> str:
    """A new folder below the shared one, removed when Spark ends."""
    path = f"{shared_dir(spark)}/{stem}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def _stored(made: DataFrame, mode: str) -> DataFrame:
    """Cells written to the salted store and read back."""
    path = cells.path_of(_scratch(made.sparkSession, "cells"), "cells", mode)
    cells.write(made, path, MODULUS)
    return cells.read(made.sparkSession, path)


@query
def mvt_rows(spark, sf_dir):
    return _tile_rows_of(_stored(mvt_bytes(spark, sf_dir).drop("z"), "tiles"))


@query
def sink_roundtrip(spark, sf_dir):
    return _point_rows_of(_stored(point_pb_bytes(spark, sf_dir), "points"))


def _built(spark: SparkSession, sf_dir: str, mode: str, **settings) -> tuple[Config, str]:
    """A whole build from files in nested folders: its settings and the table that is live after it."""
    base = _scratch(spark, f"build-{mode}")
    with short_lived_shuffles(spark):
        _raw(spark, sf_dir).withColumn("half", F.pmod(F.col("kingdomKey"), F.lit(2))).write.partitionBy("half").option("compression", "zstd").parquet(f"{base}/in/export")
    config = Config(source=f"{base}/in/*", target=f"{base}/maps", threshold=THRESHOLD, salt_modulus=MODULUS, partitions=4, **settings)
    store = build.run(spark, Manifest.from_json(Manifest(mode, "20200101_0000", config).to_json()))
    return config, lifecycle.live(store)[mode]


@query
def build_points(spark, sf_dir):
    config, table = _built(spark, sf_dir, "points")
    return _point_rows_of(cells.read(spark, cells.path_of(config.target, table, "points")))


@query
def build_tiles(spark, sf_dir):
    config, table = _built(spark, sf_dir, "tiles", max_zoom=BUILD_TOP, projections=BUILD_PROJECTIONS)
    parts = [
        _tile_rows_of(cells.read(spark, cells.path_of(config.target, table, "tiles", f"EPSG_{epsg}", z))).select(F.lit(epsg).alias("epsg"), F.lit(z).alias("z"), "*")
        for epsg in config.projections for z in range(config.max_zoom + 1)
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def source_layouts(spark, sf_dir):
    """Records read from nested folders by a glob, under the source's lock, and stored in a given number of files."""
    base = _scratch(spark, "source")
    _raw(spark, sf_dir).withColumn("part", F.pmod(F.col("kingdomKey"), F.lit(3))).write.partitionBy("part").parquet(f"{base}/in/export")
    with lifecycle.pinned(lifecycle.Store(spark, f"{base}/maps"), f"{base}/in/ex*") as files:
        records = occurrences.store(occurrences.map_input(occurrences.read(spark, files)), f"{base}/stored", 5)
    return records.withColumn("networks", F.coalesce(F.array_join("networkKey", "|", "~"), F.lit("none"))).drop("networkKey")


@query
def cell_compression(spark, sf_dir):
    """Point cells stored under each codec: files, one a salt, and cells read back."""
    made, base, parts = point_pb_bytes(spark, sf_dir), _scratch(spark, "codecs"), []
    for codec in ("snappy", "gzip", "zstd"):
        cells.write(made, f"{base}/{codec}", MODULUS, codec)
        stored = spark.read.parquet(f"{base}/{codec}").withColumn("file", F.input_file_name()).filter(F.col("file").contains(f".{ {'gzip': 'gz'}.get(codec, codec) }."))
        counted = stored.agg(F.countDistinct("file").alias("files"), F.count("*").alias("cells"))  # one row without cells, too
        parts.append(counted.select(F.lit(codec).alias("codec"), "*"))
    return reduce(DataFrame.unionByName, parts)


@query
def lifecycle_steps(spark, sf_dir):
    """(step, outcome) of creating, publishing, retiring and cleaning versions of tables."""
    store, steps = lifecycle.Store(spark, f"{_scratch(spark, 'store')}/maps"), []
    made = [Manifest(mode, f"2020010{d}_0000", Config()) for mode in ("tiles", "points") for d in (1, 2, 3, 4)]
    for k, m in enumerate(made):
        lifecycle.create(store, m)
        if k in (0, 4, 6):
            lifecycle.publish(store, m)
    steps += [(f"live {mode}", table) for mode, table in lifecycle.live(store).items()]
    steps += [(f"retired {m.mode}", name) for m in (made[3], made[7]) for name in lifecycle.retire(store, m)]
    steps += [("kept", name) for name in store.folders()]
    steps += [("manifest", lifecycle.load(store, made[0].table).timestamp), ("cleaned", str(lifecycle.clean(store, "hdfs://host/data/maps")))]
    return spark.createDataFrame(steps, "step string, outcome string")
