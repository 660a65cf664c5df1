"""Tile addresses of a global pixel, its neighbours' buffers included, and tile adjacency on a wrapping grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .projection import GRIDS, Grid

DIRECTIONS = {"N": (0, -1), "S": (0, 1), "E": (1, 0), "W": (-1, 0), "NE": (1, -1), "NW": (-1, -1), "SE": (1, 1), "SW": (-1, 1)}


def adjacent(grid: Grid, zoom: int, direction: str, x: Column, y: Column) -> tuple[Column, Column]:
    """The neighbouring tile; both axes wrap."""
    (dx, dy), (nx, ny) = DIRECTIONS[direction], grid.tiles(zoom)
    return F.pmod(x + dx, F.lit(nx)).cast("int"), F.pmod(y + dy, F.lit(ny)).cast("int")


def _local(pixel: Column, tile: Column, size: int, buffer: int, world: int) -> Column:
    """The pixel's place on a tile's axis, taken around the world where that brings it into the buffered tile."""
    d = pixel - tile * size
    return F.when(d < -buffer, d + world).when(d >= size + buffer, d - world).otherwise(d).cast("int")


def addresses(epsg: int, zoom: int, x: Column, y: Column, tile_size: int = 512, buffer: int = 64) -> Column:
    """array of struct(tileX, tileY, pixelX, pixelY): the pixel's own tile first, then those whose buffer holds it."""
    grid = GRIDS[epsg]
    (across, down), (lx, ly) = grid.pixels(zoom, tile_size), (x % tile_size, y % tile_size)
    tx, ty = F.floor(x / tile_size).cast("int"), F.floor(y / tile_size).cast("int")
    near = {"N": ly < buffer, "S": ly >= tile_size - buffer, "W": lx < buffer, "E": lx >= tile_size - buffer}

    def on(ax: Column, ay: Column) -> Column:
        return F.struct(ax.alias("tileX"), ay.alias("tileY"), _local(x, ax, tile_size, buffer, across).alias("pixelX"), _local(y, ay, tile_size, buffer, down).alias("pixelY"))

    found = [on(tx, ty)]
    for name in DIRECTIONS:
        holds = F.lit(True)
        for side in name:
            holds = holds & near[side]
        found.append(F.when(holds, on(*adjacent(grid, zoom, name, tx, ty))))
    return F.array_distinct(F.array_compact(F.array(*found)))
