"""The build: source to stored input, views split by size, point lists and tile pyramids written as cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tile_packs
from ..operators import points, tiles, views
from ..sources import cells, occurrences
from ..sources.shared import short_lived_shuffles, small_batches
from . import lifecycle, pyramid, sweep
from .config import Config, Manifest


def large_views(records: DataFrame, config: Config) -> DataFrame:
    """(mapKey, occCount) of the views that get tiles."""
    return views.at_least(views.view_sizes(records), config.threshold)


def build_points(records: DataFrame, large: DataFrame, config: Config) -> DataFrame:
    """Cells of the views too small for tiles."""
    counts = views.counts_of_views(records, large, False, config.strict)
    return points.cells(points.assemble(counts), config.salt_modulus)


def tile_input(records: DataFrame, large: DataFrame, config: Config) -> DataFrame:
    """Counts by place of the views that get tiles."""
    return views.counts_of_views(records, large, True, config.strict, config.compat_empty_approve)


def build_tiles(counts: DataFrame, epsg: int, config: Config, settle=None):
    """(zoom, cells) of one projection, highest zoom first."""
    source = tiles.south(counts) if epsg == 3031 else counts
    for zoom, pixels in pyramid.levels(source, epsg, config.max_zoom, tile_size=config.tile_size, settle=settle):
        rows = tiles.tile_rows(pixels, epsg, zoom, config.tile_size, config.buffer_size)
        yield zoom, tiles.cells(rows, epsg, zoom, config.salt_modulus, config.tile_size)


def _tile_cells(records: DataFrame, large: DataFrame, config: Config, work: str, done):
    """(epsg, zoom, cells, whether they are laid out by salt) of all projections; ``done`` is called once ``records`` are not read any more.

    Records are stored once more with their pixels and the numbers of their views. From there one zoom at a time is packed, shuffled and
    encoded, so that no counts wait on disk. If there are too many views, counts are shuffled.
    """
    spark = records.sparkSession
    _, few = views.measured(large, views.BROADCAST_KEYS)
    narrow = tile_packs.bits_of(config.tile_size + 2 * config.buffer_size) <= tile_packs.MOST_BITS
    if narrow and (few or (few is not None and not config.compat_empty_approve)):
        names = [r.mapKey for r in few]
        places = sweep.numbered(records, names, config.projections, config.max_zoom, config.tile_size, config.strict)
        with small_batches(spark):
            places.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", occurrences.ROW_GROUP_BYTES).parquet(f"{work}/places")
        done()
        stored = spark.read.schema(places.schema).parquet(f"{work}/places")
        for k, epsg in enumerate(config.projections):
            mine = stored.select("borYear", "views", F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y"))
            for zoom in range(config.max_zoom, -1, -1):
                packs = sweep.packs(mine, names, epsg, zoom, config.max_zoom, config.tile_size, config.buffer_size)
                yield epsg, zoom, tiles.pack_cells(packs, epsg, zoom, config.salt_modulus, config.tile_size, config.buffer_size), True
        return
    tile_input(records, large, config).write.mode("overwrite").parquet(f"{work}/tiles")
    done()
    counts = spark.read.parquet(f"{work}/tiles")
    for epsg in config.projections:
        blocks = iter(range(100))

        def settle(level: DataFrame, epsg=epsg, blocks=blocks) -> DataFrame:
            path = f"{work}/levels/{epsg}/{next(blocks)}"
            level.write.mode("overwrite").partitionBy("z").parquet(path)
            return spark.read.schema(level.schema).parquet(path)

        for zoom, out in build_tiles(counts, epsg, config, settle):
            yield epsg, zoom, out, False


def run(spark: SparkSession, manifest: Manifest, source: DataFrame | None = None) -> lifecycle.Store:
    """A whole run: create the version, build it, make it live and retire old ones.

    The stored input is written below the version's work folder, which is removed at the end.
    """
    config = manifest.config
    store = lifecycle.Store(spark, config.target)
    if config.database:
        occurrences.use_database(spark, config.database)
    lifecycle.create(store, manifest)
    work = f"{store.target}/{manifest.table}/_work"
    try:
        with short_lived_shuffles(spark):
            _build(spark, manifest, source, store, work)
    finally:
        store.delete(work)
    lifecycle.publish(store, manifest)
    lifecycle.retire(store, manifest)
    return store


def _build(spark: SparkSession, manifest: Manifest, source: DataFrame | None, store: lifecycle.Store, work: str) -> None:
    config = manifest.config
    if source is None:
        with lifecycle.pinned(store, config.source) as files:  # until they are copied: what the build reads stays as it is
            base = {} if lifecycle.is_glob(config.source) else {"basePath": config.source}
            source = occurrences.read(spark, files, config.source_format, **base)
            records = occurrences.store(occurrences.map_input(source), f"{work}/input", config.partitions)
    else:
        records = occurrences.store(occurrences.map_input(source), f"{work}/input", config.partitions)
    large = large_views(records, config)
    large.write.mode("overwrite").parquet(f"{work}/large")
    large = spark.read.parquet(f"{work}/large")
    if manifest.mode == "points":
        spark.sparkContext.setJobDescription("points")
        cells.write(build_points(records, large, config), cells.path_of(config.target, manifest.table, "points"), config.salt_modulus)
    else:
        for epsg, zoom, out, laid in _tile_cells(records, large, config, work, lambda: store.delete(f"{work}/input")):
            spark.sparkContext.setJobDescription(f"EPSG:{epsg} zoom {zoom}")
            cells.write(out.drop("z"), cells.path_of(config.target, manifest.table, "tiles", f"EPSG_{epsg}", zoom), config.salt_modulus, "zstd", laid)
    spark.sparkContext.setJobDescription(None)


def main(args: list[str]) -> None:
    spark = SparkSession.builder.appName("tilewright").getOrCreate()
    run(spark, Manifest.from_args(args))


def total(cells_frame: DataFrame) -> DataFrame:
    """Cells by family and qualifier, for a quick look at what a run wrote."""
    return cells_frame.groupBy("family", "qualifier").agg(F.count("*").alias("cells"), F.sum(F.octet_length("value")).alias("bytes"))
