"""The zoom pyramid: places are projected once, at the highest zoom, and each lower zoom sums the pixels above it.

Halving a global pixel gives the pixel of the zoom below exactly, edges included, so no zoom is projected again. The zooms
are made in blocks of a few. A block's pixels are dealt out by map key and a coarse square of pixels; since all pixels
that meet within the block lie in one square, all of its zooms are summed on one shuffle, in one pass. The next block
starts from the lowest zoom of the one before, whose input has shrunk by a power of four a zoom.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tiles import place_pixels

ZOOMS_PER_SHUFFLE = 4


def blocks(counts: DataFrame, epsg: int, max_zoom: int, min_zoom: int = 0, tile_size: int = 512, size: int = ZOOMS_PER_SHUFFLE, settle: Callable[[DataFrame], DataFrame] | None = None) -> Iterator[tuple[range, DataFrame]]:
    """(zooms, pixels) from the highest block down; pixels are (z, mapKey, x, y, borYear, occCount).

    ``settle`` stores a block, for builds: its zooms and the next block are then read from it.
    """
    pixels = place_pixels(counts, epsg, max_zoom, tile_size)
    for top in range(max_zoom, min_zoom - 1, -size):
        zooms = range(top, max(min_zoom, top - size + 1) - 1, -1)
        square = [F.shiftright(c, size).alias(f"b{c}") for c in ("x", "y")]
        dealt = pixels.select("mapKey", "x", "y", "borYear", "occCount", *square).repartition("mapKey", "bx", "by")
        dealt = dealt.groupBy("mapKey", "bx", "by", "x", "y", "borYear").agg(F.sum("occCount").alias("occCount"))  # fewer rows to spread
        spread = dealt.withColumn("down", F.explode(F.array(*[F.lit(k) for k in range(len(zooms))])))
        halved = spread.select("mapKey", "bx", "by", "down", F.expr("shiftright(x, down)").alias("x"), F.expr("shiftright(y, down)").alias("y"), "borYear", "occCount")
        summed = halved.groupBy("mapKey", "bx", "by", "down", "x", "y", "borYear").agg(F.sum("occCount").alias("occCount"))
        block = summed.select((F.lit(top) - F.col("down")).alias("z"), "mapKey", "x", "y", "borYear", "occCount")
        block = settle(block) if settle else block
        yield zooms, block
        pixels = block.filter(F.col("z") == zooms[-1]).select("mapKey", F.shiftright("x", 1).alias("x"), F.shiftright("y", 1).alias("y"), "borYear", "occCount")


def levels(counts: DataFrame, epsg: int, max_zoom: int, min_zoom: int = 0, tile_size: int = 512, settle: Callable[[DataFrame], DataFrame] | None = None) -> Iterator[tuple[int, DataFrame]]:
    """(zoom, pixels) from ``max_zoom`` down; pixels are (mapKey, x, y, borYear, occCount)."""
    for zooms, block in blocks(counts, epsg, max_zoom, min_zoom, tile_size, settle=settle):
        for zoom in zooms:
            yield zoom, block.filter(F.col("z") == zoom).drop("z")


def pyramid(counts: DataFrame, epsg: int, max_zoom: int, min_zoom: int = 0, tile_size: int = 512, settle: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """All zooms as one frame: (epsg, z, mapKey, x, y, borYear, occCount)."""
    parts = [b.select(F.lit(epsg).alias("epsg"), "*") for _, b in blocks(counts, epsg, max_zoom, min_zoom, tile_size, settle=settle)]
    return reduce(DataFrame.unionByName, parts)
