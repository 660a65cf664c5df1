"""The sweep's zooms are those of direct projections, from one shuffle, also where one place fills many chunks."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tilewright import queries
from tilewright.operators import tiles, views
from tilewright.plans import build, sweep
from tilewright.plans.config import Config, Manifest
from tilewright.sources import cells, fixtures, occurrences

GRIDS = (3857, 4326, 3575, 3031)


@pytest.fixture(scope="module")
def records(spark):
    crowd = fixtures.occurrences(spark, SMALL).withColumn("decimalLatitude", F.when(F.col("taxonKey") % 3 == 0, F.lit(-10.0) + F.col("year") / 1e5).otherwise(F.col("decimalLatitude")))
    return occurrences.map_input(crowd.withColumn("decimalLongitude", F.when(F.col("taxonKey") % 3 == 0, F.lit(20.0)).otherwise(F.col("decimalLongitude")))).cache()


@pytest.mark.parametrize("chunk", [5, 300, sweep.CHUNK])
def test_sweep_is_the_direct_projection(records, chunk):
    large = sorted(r.mapKey for r in views.at_least(views.view_sizes(records), 300).collect())
    got = sweep.sweep(records, large, GRIDS, 9, 3, sweep.pixel_rows(GRIDS), sweep.PIXELS, chunk=chunk).cache()
    counts = views.counts_by_location(records).filter(F.col("mapKey").isin(*large)).cache()
    assert got.select("epsg", "z").distinct().count() == 4 * 7
    for epsg in GRIDS:
        for zoom in (9, 8, 3):
            want = tiles.pixel_counts(tiles.south(counts) if epsg == 3031 else counts, epsg, zoom)
            mine = got.filter((F.col("epsg") == epsg) & (F.col("z") == zoom)).drop("epsg", "z")
            assert mine.exceptAll(want).count() == 0 and want.exceptAll(mine).count() == 0


def test_no_large_view_gives_nothing(records):
    assert sweep.sweep(records, [], GRIDS, 4, 0, sweep.pixel_rows(GRIDS), sweep.PIXELS).count() == 0


def shuffles(df):
    """Shuffles of the plan above the source's joins."""
    plan = df._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    return plan.count("Aggregate [") + plan.count("RepartitionByExpression")


@pytest.mark.parametrize("name, most", [("zoom_cascade", 1), ("pyramid_totals", 2)])
def test_records_are_shuffled_before_they_are_fanned_out(spark, name, most):
    df = queries.QUERIES[name](spark, SMALL)
    assert shuffles(df) == most and "Generate" not in df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("most", [views.BROADCAST_KEYS, 0])
def test_builds_are_the_same_whether_swept_or_shuffled(spark, records, tmp_path, monkeypatch, most):
    """Each tile's bytes are those of the direct projection, buffers included, also where a tile has many pieces."""
    monkeypatch.setattr(views, "BROADCAST_KEYS", most)
    monkeypatch.setattr(sweep, "PIECE_BUFFER", 500)
    config = Config(source="", target=f"file://{tmp_path}/maps", threshold=300, salt_modulus=4, max_zoom=1, partitions=3, projections=(4326, 3575, 3031))
    build.run(spark, Manifest("tiles", "20200101_0000", config), records)
    large = sorted(r.mapKey for r in views.at_least(views.view_sizes(records), 300).collect())
    counts = views.counts_by_location(records).filter(F.col("mapKey").isin(*large)).cache()
    for epsg in config.projections:
        for zoom in (0, 1):
            shown = tiles.south(counts) if epsg == 3031 else counts
            want = tiles.cells(tiles.tile_rows(tiles.pixel_counts(shown, epsg, zoom), epsg, zoom), epsg, zoom, 4).select("row_key", "value")
            got = cells.read(spark, cells.path_of(config.target, "maps_tiles_20200101_0000", "tiles", f"EPSG_{epsg}", zoom)).select("row_key", "value")
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_tiles_take_one_shuffle_of_records_and_one_of_pieces(spark):
    df = queries.QUERIES["mvt_bytes"](spark, SMALL)
    assert shuffles(df) == 2 and "Generate" not in df._jdf.queryExecution().optimizedPlan().toString()
