"""Global pixels of a latitude and longitude in four projections, as column expressions.

Formulas: J. P. Snyder, Map Projections - A Working Manual, USGS Professional Paper 1395, on the WGS84 ellipsoid.
Pixels count from the upper left; a place on the far edge belongs to the last pixel.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The WGS84 ellipsoid, and the latitude where the Mercator square ends.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
MERCATOR_LIMIT = 85.0511287798066

ECC2 = FLATTENING * (2 - FLATTENING)
ECC = math.sqrt(ECC2)


def _authalic(s: float) -> float:
    return (1 - ECC2) * (s / (1 - ECC2 * s * s) - math.log((1 - ECC * s) / (1 + ECC * s)) / (2 * ECC))


Q_POLE = _authalic(1.0)
NORTH_RADIUS = SEMI_MAJOR * math.sqrt(Q_POLE)
NORTH_MERIDIAN = 10.0

_TS = math.radians(71)
_M_TS = math.cos(_TS) / math.sqrt(1 - ECC2 * math.sin(_TS) ** 2)
_T_TS = math.tan(math.pi / 4 - _TS / 2) / ((1 - ECC * math.sin(_TS)) / (1 + ECC * math.sin(_TS))) ** (ECC / 2)
SOUTH_RADIUS = SEMI_MAJOR * _M_TS / _T_TS


@dataclass(frozen=True)
class Grid:
    """Tiles across and down at zoom 0."""

    epsg: int
    across: int
    down: int

    @property
    def name(self) -> str:
        return f"EPSG_{self.epsg}"

    def tiles(self, zoom: int) -> tuple[int, int]:
        return self.across << zoom, self.down << zoom

    def pixels(self, zoom: int, tile_size: int) -> tuple[int, int]:
        return (self.across << zoom) * tile_size, (self.down << zoom) * tile_size


GRIDS = {g.epsg: g for g in (Grid(3857, 1, 1), Grid(4326, 2, 1), Grid(3575, 1, 1), Grid(3031, 1, 1))}


def plottable(epsg: int, lat: Column) -> Column:
    """Whether the projection shows the latitude; a predicate on ``lat`` alone, so it reaches the scan."""
    if epsg == 3857:
        return F.abs(lat) <= MERCATOR_LIMIT
    if epsg == 3575:
        return lat >= 0
    if epsg == 3031:
        return lat <= 0
    return lat.isNotNull()


def _world(epsg: int, lat: Column, lng: Column, width: float) -> tuple[Column, Column]:
    phi = F.radians(lat)
    if epsg == 4326:
        half = width / 2
        return (lng + 180.0) / 180.0 * half, (F.lit(90.0) - lat) / 180.0 * half
    if epsg == 3857:
        return (lng + 180.0) / 360.0 * width, (F.lit(0.5) - F.log(F.tan(F.lit(math.pi / 4) + phi / 2.0)) / (2 * math.pi)) * width
    s = F.sin(phi)
    if epsg == 3575:
        q = (s / (F.lit(1.0) - s * s * ECC2) - F.log((F.lit(1.0) - s * ECC) / (F.lit(1.0) + s * ECC)) / (2 * ECC)) * (1 - ECC2)
        rho = F.sqrt(F.greatest(F.lit(Q_POLE) - q, F.lit(0.0))) * SEMI_MAJOR
        turn = F.radians(lng - NORTH_MERIDIAN)
        return (rho * F.sin(turn) / (2 * NORTH_RADIUS) + 0.5) * width, (rho * F.cos(turn) / (2 * NORTH_RADIUS) + 0.5) * width
    t = F.tan(F.lit(math.pi / 4) + phi / 2.0) / F.pow((F.lit(1.0) + s * ECC) / (F.lit(1.0) - s * ECC), F.lit(ECC / 2))
    rho, turn = t * SOUTH_RADIUS, F.radians(lng)
    return (rho * F.sin(turn) / (2 * SOUTH_RADIUS) + 0.5) * width, (F.lit(0.5) - rho * F.cos(turn) / (2 * SOUTH_RADIUS)) * width


def global_pixel(epsg: int, zoom: int, lat: Column, lng: Column, tile_size: int = 512) -> tuple[Column, Column]:
    """Columns x and y (int) of a plottable place; filter with ``plottable`` first."""
    across, down = GRIDS[epsg].pixels(zoom, tile_size)
    x, y = _world(epsg, lat, lng, float(across))
    clamp = lambda v, top: F.least(F.greatest(F.floor(v), F.lit(0)), F.lit(top - 1)).cast("int")
    return clamp(x, across), clamp(y, down)


def project(epsg: int, zoom: int, lat: Column, lng: Column, tile_size: int = 512) -> Column:
    """struct(x, y), or null where the place is not plottable."""
    x, y = global_pixel(epsg, zoom, lat, lng, tile_size)
    return F.when(plottable(epsg, lat) & lng.isNotNull(), F.struct(x.alias("x"), y.alias("y")))
