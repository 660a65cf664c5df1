"""DuckDB SQL for the registered queries of the map engine, written independently of the column expressions."""

from __future__ import annotations

import math

from .queries import BUILD_PROJECTIONS, BUILD_TOP, CASCADE_TOP, MODULUS, PIXEL_ZOOM, RETENTION, THRESHOLD, TILE_ZOOM
from .sources.fixtures import duckdb_sql

TILE, BUFFER = 512, 64
_BASES = ("PRESERVED_SPECIMEN", "MACHINE_OBSERVATION", "OCCURRENCE", "HUMAN_OBSERVATION", "LIVING_SPECIMEN", "OBSERVATION", "MATERIAL_CITATION", "MATERIAL_SAMPLE", "FOSSIL_SPECIMEN")
_CODE = "CASE basisOfRecord " + " ".join(f"WHEN '{b}' THEN {i}" for i, b in enumerate(_BASES)) + " END"
_NAME = lambda e: f"CASE {e} " + " ".join(f"WHEN {i} THEN '{b}'" for i, b in enumerate(_BASES)) + " END"

_KEYS = (
    "list_distinct(list_concat(['0:0', "
    + ", ".join(f"'1:' || {c}" for c in ("kingdomKey", "phylumKey", "classKey", "orderKey", "familyKey", "genusKey", "speciesKey", "taxonKey"))
    + ", '2:' || datasetKey, '3:' || publishingOrgKey, '4:' || countryCode, '5:' || publishingCountry], list_transform(coalesce(networkKey, []), lambda n: '6:' || n)))"
)

_WITH = f"""WITH raw AS ({duckdb_sql()}),
occ AS (SELECT *, {_CODE} AS bor FROM raw WHERE decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL AND hasGeospatialIssues = FALSE AND occurrenceStatus = 'PRESENT'),
fan AS (SELECT k AS mapKey, decimalLatitude AS lat, decimalLongitude AS lng, (coalesce(year, 0) * 100 + bor)::INT AS borYear, taxonKey, year FROM (SELECT *, unnest({_KEYS}) AS k FROM occ) WHERE k IS NOT NULL),
sizes AS (SELECT mapKey, count(*) AS occCount FROM fan GROUP BY 1),
large AS (SELECT mapKey, occCount FROM sizes WHERE occCount >= {THRESHOLD}),
counts AS (SELECT mapKey, lat, lng, borYear, count(*) AS occCount FROM fan GROUP BY ALL),
tin AS (SELECT * FROM counts SEMI JOIN large USING (mapKey)),
pin AS (SELECT * FROM counts ANTI JOIN large USING (mapKey))"""


def _grid(epsg: int, zoom: int) -> tuple[int, int]:
    return (2 if epsg == 4326 else 1) << zoom, 1 << zoom


def _pixel(epsg: int, zoom: int) -> tuple[str, str, str]:
    """(x, y, condition) from lat and lng."""
    nx, ny = _grid(epsg, zoom)
    w, h = nx * TILE, ny * TILE
    a, f = 6378137.0, 1 / 298.257223563
    e2 = f * (2 - f)
    e = math.sqrt(e2)
    num = lambda v: f"CAST({v!r} AS DOUBLE)"
    if epsg == 4326:
        x, y, ok = f"(lng + 180e0) / 180e0 * {num(w / 2)}", f"(90e0 - lat) / 180e0 * {num(w / 2)}", "TRUE"
    elif epsg == 3857:
        x, y = f"(lng + 180e0) / 360e0 * {num(float(w))}", f"(0.5e0 - ln(tan({num(math.pi / 4)} + radians(lat) / 2e0)) / {num(2 * math.pi)}) * {num(float(w))}"
        ok = "abs(lat) <= 85.0511287798066e0"
    elif epsg == 3575:
        qp = (1 - e2) * (1 / (1 - e2) - math.log((1 - e) / (1 + e)) / (2 * e))
        s = "sin(radians(lat))"
        q = f"(({s} / (1e0 - {s} * {s} * {num(e2)}) - ln((1e0 - {s} * {num(e)}) / (1e0 + {s} * {num(e)})) / {num(2 * e)}) * {num(1 - e2)})"
        rho, r = f"(sqrt(greatest({num(qp)} - {q}, 0e0)) * {num(a)})", a * math.sqrt(qp)
        x = f"({rho} * sin(radians(lng - 10e0)) / {num(2 * r)} + 0.5e0) * {num(float(w))}"
        y = f"({rho} * cos(radians(lng - 10e0)) / {num(2 * r)} + 0.5e0) * {num(float(w))}"
        ok = "lat >= 0"
    else:
        ts = math.radians(71)
        m = math.cos(ts) / math.sqrt(1 - e2 * math.sin(ts) ** 2)
        t_ts = math.tan(math.pi / 4 - ts / 2) / ((1 - e * math.sin(ts)) / (1 + e * math.sin(ts))) ** (e / 2)
        r, s = a * m / t_ts, "sin(radians(lat))"
        rho = f"(tan({num(math.pi / 4)} + radians(lat) / 2e0) / pow((1e0 + {s} * {num(e)}) / (1e0 - {s} * {num(e)}), {num(e / 2)}) * {num(r)})"
        x = f"({rho} * sin(radians(lng)) / {num(2 * r)} + 0.5e0) * {num(float(w))}"
        y = f"(0.5e0 - {rho} * cos(radians(lng)) / {num(2 * r)}) * {num(float(w))}"
        ok = "lat <= 0"
    clamp = lambda v, top: f"CAST(least(greatest(floor({v}), 0), {top - 1}) AS INT)"
    return clamp(x, w), clamp(y, h), ok


def _pixel_counts(epsg: int, zoom: int, source: str = "tin") -> str:
    x, y, ok = _pixel(epsg, zoom)
    return f"SELECT mapKey, {x} AS x, {y} AS y, borYear, CAST(sum(occCount) AS BIGINT) AS occCount FROM {source} WHERE {ok} GROUP BY ALL"


def _addresses(epsg: int, zoom: int, source: str, columns: str) -> str:
    """Offset join: every neighbour offset whose buffer holds the pixel, wrapped and de-duplicated."""
    nx, ny = _grid(epsg, zoom)
    wrap = lambda v, n: f"((({v}) % {n}) + {n}) % {n}"
    local = lambda d, world: f"CASE WHEN {d} < {-BUFFER} THEN {d} + {world} WHEN {d} >= {TILE + BUFFER} THEN {d} - {world} ELSE {d} END"
    return f"""SELECT DISTINCT {columns}, tileX, tileY, CAST({local(f'(x - tileX * {TILE})', nx * TILE)} AS INT) AS pixelX, CAST({local(f'(y - tileY * {TILE})', ny * TILE)} AS INT) AS pixelY
FROM (SELECT *, CAST({wrap(f'x // {TILE} + dx', nx)} AS INT) AS tileX, CAST({wrap(f'y // {TILE} + dy', ny)} AS INT) AS tileY
FROM ({source}) s, (VALUES (-1), (0), (1)) ox(dx), (VALUES (-1), (0), (1)) oy(dy)
WHERE (dx = 0 OR (dx = -1 AND x % {TILE} < {BUFFER}) OR (dx = 1 AND x % {TILE} >= {TILE - BUFFER})) AND (dy = 0 OR (dy = -1 AND y % {TILE} < {BUFFER}) OR (dy = 1 AND y % {TILE} >= {TILE - BUFFER})))"""


def _tile_rows(epsg: int, zoom: int) -> str:
    source = "(SELECT * FROM tin WHERE lat <= 1)" if epsg == 3031 else "tin"
    return _addresses(epsg, zoom, _pixel_counts(epsg, zoom, source), "mapKey, x, y, borYear, occCount")


def _salted(key: str) -> str:
    return f"lpad(CAST(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % {MODULUS} AS VARCHAR), {len(str(MODULUS - 1))}, '0') || ':' || {key}"


def _build() -> dict[str, str]:
    key = f"mapKey || ':{TILE_ZOOM}:' || tileX || ':' || tileY"
    tile_keys = f"SELECT DISTINCT {key} AS key FROM ({_tile_rows(4326, TILE_ZOOM)})"
    out = {
        "occ_filter": f"{_WITH} SELECT * EXCLUDE (networkKey, bor), coalesce(array_to_string(list_transform(networkKey, lambda n: coalesce(n, '~')), '|'), 'none') AS networks FROM occ",
        "map_keys_explode": f"{_WITH} SELECT mapKey, lat, lng, taxonKey FROM fan",
        "map_key_counts": f"{_WITH} SELECT * FROM sizes",
        "large_map_keys": f"{_WITH} SELECT * FROM large",
        "approve_keys": f"{_WITH} SELECT mapKey, count(*) AS records, count(year) AS dated FROM fan SEMI JOIN large USING (mapKey) GROUP BY 1",
        "deny_keys": f"{_WITH} SELECT mapKey, count(*) AS records, count(year) AS dated FROM fan ANTI JOIN large USING (mapKey) GROUP BY 1",
        "bor_year_encode": f"{_WITH} SELECT basisOfRecord, year, (coalesce(year, 0) * 100 + {_CODE})::INT AS borYear, count(*) AS n FROM raw GROUP BY ALL",
        "bor_year_decode": f"""{_WITH}, e AS (SELECT (coalesce(year, 0) * 100 + {_CODE})::INT AS b FROM raw), every AS (SELECT DISTINCT b FROM (SELECT b FROM e UNION ALL SELECT 6 - b FROM e))
SELECT b AS borYear, nullif(greatest(b // 100, 0), 0)::INT AS year, {_NAME('b % 100')} AS basisOfRecord FROM every""",
        "tile_input": f"{_WITH} SELECT * FROM tin",
        "point_counts": f"{_WITH} SELECT * FROM pin",
        "point_features": f"{_WITH} SELECT * FROM pin",
        "south_filter": f"{_WITH} SELECT * FROM tin WHERE lat <= 1",
        "pixel_counts": f"{_WITH} {_pixel_counts(3857, TILE_ZOOM)}",
        "pixel_features": f"{_WITH} {_pixel_counts(3857, TILE_ZOOM)}",
        "tile_adjacency": " UNION ALL ".join(
            f"SELECT {epsg} AS epsg, {z} AS z, x::INT AS x, y::INT AS y, direction, ((x + dx + {nx}) % {nx})::INT AS to_x, ((y + dy + {ny}) % {ny})::INT AS to_y FROM range({nx}) a(x), range({ny}) b(y),"
            " (VALUES ('N', 0, -1), ('S', 0, 1), ('E', 1, 0), ('W', -1, 0), ('NE', 1, -1), ('NW', -1, -1), ('SE', 1, 1), ('SW', -1, 1)) d(direction, dx, dy)"
            for epsg in (3857, 4326, 3575, 3031) for z in (0, 1, 2) for nx, ny in [_grid(epsg, z)]
        ),
        "tile_addresses": f"{_WITH}, px AS (SELECT DISTINCT {_pixel(4326, TILE_ZOOM)[0]} AS x, {_pixel(4326, TILE_ZOOM)[1]} AS y FROM (SELECT decimalLatitude AS lat, decimalLongitude AS lng FROM occ)) {_addresses(4326, TILE_ZOOM, 'SELECT * FROM px', 'x, y')}",
        "zoom_cascade": f"{_WITH}, so AS (SELECT * FROM tin WHERE lat <= 1) "
        + " UNION ALL ".join(f"SELECT {epsg} AS epsg, {z} AS z, * FROM ({_pixel_counts(epsg, z, source)})" for epsg, source in ((3857, "tin"), (3031, "so")) for z in range(CASCADE_TOP + 1)),
        "pyramid_totals": f"{_WITH}, so AS (SELECT * FROM tin WHERE lat <= 1) "
        + " UNION ALL ".join(
            f"SELECT {epsg} AS epsg, {z} AS z, count(*) AS pixels, CAST(sum(occCount) AS BIGINT) AS records, CAST(sum(((CAST(x AS BIGINT) * 31 + CAST(y AS BIGINT) * 17 + borYear) * occCount) % 1000003) AS BIGINT) AS check_sum"
            f" FROM ({_pixel_counts(epsg, z, 'so' if epsg == 3031 else 'tin')})"
            for epsg in (3857, 4326, 3575, 3031) for z in range(PIXEL_ZOOM + 1)
        ),
        "tile_layer_attributes": f"{_WITH} SELECT mapKey, tileX, tileY, {_NAME('borYear % 100')} AS layer, pixelX, pixelY, coalesce(nullif(borYear // 100, 0)::VARCHAR, 'null') AS year, occCount FROM ({_tile_rows(4326, TILE_ZOOM)})",
        "salted_tile_key": f"{_WITH} SELECT key, {_salted('key')} AS row_key FROM ({tile_keys})",
        "salted_point_key": f"{_WITH} SELECT mapKey, {_salted('mapKey')} AS row_key FROM sizes",
        "salt_layout": f"{_WITH} SELECT CAST(split_part(r, ':', 1) AS INT) AS salt, count(*) AS n, min(r) AS first, max(r) AS last FROM (SELECT {_salted('key')} AS r FROM ({tile_keys})) GROUP BY 1",
        "table_retention": "SELECT mode, name FROM (SELECT *, row_number() OVER (PARTITION BY mode ORDER BY name DESC) AS r FROM (VALUES " + ", ".join(f"('{m}', '{n}')" for m, n in RETENTION) + ") t(mode, name)) WHERE r > 2",
        "sink_roundtrip": f"{_WITH} SELECT mapKey, lat, lng, (borYear % 100)::BIGINT AS basis, (borYear // 100)::BIGINT AS year FROM pin",
    }
    said = f"mapKey, tileX, tileY, {_NAME('borYear % 100')} AS layer, pixelX, pixelY, coalesce(nullif(borYear // 100, 0)::VARCHAR, 'null') AS year, occCount"
    out["mvt_rows"] = out["tile_layer_attributes"]
    out["build_points"] = out["sink_roundtrip"]
    out["build_tiles"] = f"{_WITH} " + " UNION ALL ".join(f"SELECT {epsg} AS epsg, {z} AS z, {said} FROM ({_tile_rows(epsg, z)})" for epsg in BUILD_PROJECTIONS for z in range(BUILD_TOP + 1))
    out["source_layouts"] = out["occ_filter"]
    out["cell_compression"] = f"{_WITH} SELECT codec, (SELECT count(DISTINCT split_part(row_key, ':', 1)) FROM (SELECT {_salted('mapKey')} AS row_key FROM (SELECT DISTINCT mapKey FROM pin))) AS files, (SELECT count(DISTINCT mapKey) FROM pin) AS cells FROM (VALUES ('snappy'), ('gzip'), ('zstd')) t(codec)"
    out["lifecycle_steps"] = """SELECT step, outcome FROM (VALUES ('live tiles', 'maps_tiles_20200101_0000'), ('live points', 'maps_points_20200103_0000'),
('retired tiles', 'maps_tiles_20200102_0000'), ('retired points', 'maps_points_20200102_0000'), ('retired points', 'maps_points_20200101_0000'),
('kept', 'maps_tiles_20200101_0000'), ('kept', 'maps_tiles_20200103_0000'), ('kept', 'maps_tiles_20200104_0000'), ('kept', 'maps_points_20200103_0000'), ('kept', 'maps_points_20200104_0000'),
('manifest', '20200101_0000'), ('cleaned', 'False')) t(step, outcome)"""
    for epsg in (3857, 4326, 3575, 3031):
        x, y, ok = _pixel(epsg, PIXEL_ZOOM)
        out[f"global_pixel_{epsg}"] = f"{_WITH} SELECT lat, lng, {x} AS x, {y} AS y FROM (SELECT decimalLatitude AS lat, decimalLongitude AS lng FROM occ) WHERE {ok}"
        out[f"tiles_{epsg}"] = f"{_WITH} SELECT {key} AS tile, pixelX AS x, pixelY AS y, borYear, occCount FROM ({_tile_rows(epsg, TILE_ZOOM)})"
    return out


ORACLES: dict[str, str] = _build()
