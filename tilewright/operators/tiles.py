"""Pixels and tiles of large views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bor_year import basis_of_record, year
from ..functions.keys import salted, tile_key
from ..functions.projection import global_pixel, plottable
from ..functions.tile_arrays import encode_pieces
from ..functions.tile_packs import encode_packs
from ..functions.tiling import addresses
from ..functions.wire import encode_tiles
from .layout import by_salt


def place_pixels(counts: DataFrame, epsg: int, zoom: int, tile_size: int = 512) -> DataFrame:
    """(mapKey, x, y, borYear, occCount): one row for each plottable place, not yet summed by pixel."""
    lat, lng = F.col("lat"), F.col("lng")
    x, y = global_pixel(epsg, zoom, lat, lng, tile_size)
    return counts.filter(plottable(epsg, lat) & lng.isNotNull()).select("mapKey", x.alias("x"), y.alias("y"), "borYear", "occCount")


def pixel_counts(counts: DataFrame, epsg: int, zoom: int, tile_size: int = 512) -> DataFrame:
    """(mapKey, x, y, borYear, occCount): plottable places summed by global pixel."""
    return place_pixels(counts, epsg, zoom, tile_size).groupBy("mapKey", "x", "y", "borYear").agg(F.sum("occCount").alias("occCount"))


def south(counts: DataFrame, limit: float = 1.0) -> DataFrame:
    """Places that a map of the south may show."""
    return counts.filter(F.col("lat") <= limit)


def pixel_features(pixels: DataFrame) -> DataFrame:
    """(mapKey, x, y, features): each pixel's counts by basis and year, sorted."""
    return pixels.groupBy("mapKey", "x", "y").agg(F.sort_array(F.collect_list(F.struct("borYear", "occCount"))).alias("features"))


def tile_rows(pixels: DataFrame, epsg: int, zoom: int, tile_size: int = 512, buffer: int = 64) -> DataFrame:
    """(mapKey, tileX, tileY, pixelX, pixelY, borYear, occCount): pixels on their tile and on tiles whose buffer holds them.

    Counts in buffers repeat those of neighbouring tiles: sums across tiles are no totals.
    """
    at = addresses(epsg, zoom, F.col("x"), F.col("y"), tile_size, buffer)
    spread = pixels.select("mapKey", "borYear", "occCount", F.explode(at).alias("at"))
    return spread.select("mapKey", "at.*", "borYear", "occCount")


def assemble(rows: DataFrame, zoom: int) -> DataFrame:
    """(mapKey, z, tileX, tileY, tile): tile is the sorted list of pixels {x, y, features}, for looking at tiles as rows.

    The list has at most (tile size + 2 buffers) squared pixels, each with its counts by basis and year. Builds
    encode tiles with ``cells``, which makes no such list.
    """
    rows = rows.repartition("mapKey", "tileX", "tileY")  # serves both groupings below; lists have nothing to combine earlier
    pixel = rows.groupBy("mapKey", "tileX", "tileY", "pixelX", "pixelY").agg(F.sort_array(F.collect_list(F.struct("borYear", "occCount"))).alias("features"))
    entry = F.struct(F.col("pixelX").alias("x"), F.col("pixelY").alias("y"), "features")
    return pixel.groupBy("mapKey", "tileX", "tileY").agg(F.sort_array(F.collect_list(entry)).alias("tile")).withColumn("z", F.lit(zoom))


def cells(rows: DataFrame, epsg: int, zoom: int, modulus: int, tile_size: int = 512) -> DataFrame:
    """(row_key, family, qualifier, value, z): the vector encoding of each tile of ``tile_rows`` under its salted key."""
    layer = F.coalesce(basis_of_record(F.col("borYear")), F.lit("None"))
    return _keyed(encode_tiles(rows.withColumn("layer", layer), tile_size), epsg, zoom, modulus)


def piece_cells(pieces: DataFrame, epsg: int, zoom: int, modulus: int, tile_size: int = 512, buffer: int = 64) -> DataFrame:
    """``cells`` of one projection's and zoom's pieces, which a sweep has packed."""
    return _keyed(encode_pieces(pieces, tile_size, buffer), epsg, zoom, modulus)


def pack_cells(packs: DataFrame, epsg: int, zoom: int, modulus: int, tile_size: int = 512, buffer: int = 64) -> DataFrame:
    """``cells`` of packed counts, laid out by salt: the counts are shuffled to where their tile is written, and tiles are not shuffled."""
    laid = by_salt(packs.select(_key(zoom, modulus).alias("row_key"), "piece"), modulus)
    return _celled(encode_packs(laid, tile_size, buffer), F.col("row_key"), epsg, zoom)


def _keyed(encoded: DataFrame, epsg: int, zoom: int, modulus: int) -> DataFrame:
    return _celled(encoded, _key(zoom, modulus), epsg, zoom)


def _key(zoom: int, modulus: int) -> Column:
    return salted(tile_key(F.col("mapKey"), F.lit(zoom), F.col("tileX"), F.col("tileY")), modulus)


def _celled(encoded: DataFrame, key: Column, epsg: int, zoom: int) -> DataFrame:
    return encoded.select(key.alias("row_key"), F.lit(f"EPSG_{epsg}").alias("family"), F.lit("tile").alias("qualifier"), "value", F.lit(zoom).alias("z"))


def layer_attributes(rows: DataFrame) -> DataFrame:
    """What a tile's encoding says, as rows: (mapKey, tileX, tileY, layer, pixelX, pixelY, year, occCount)."""
    named = rows.select(
        "mapKey", "tileX", "tileY", basis_of_record(F.col("borYear")).alias("layer"), "pixelX", "pixelY", F.coalesce(year(F.col("borYear")).cast("string"), F.lit("null")).alias("year"), "occCount", "borYear"
    )
    keys = ["mapKey", "tileX", "tileY", "layer", "pixelX", "pixelY", "year"]
    return named.groupBy(*keys).agg(F.max_by("occCount", "borYear").alias("occCount"))
