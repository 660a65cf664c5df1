"""Builds keep no counts on disk while they wait: zooms are packed, shuffled and encoded one at a time, and their shuffles go at once."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.test_tile_arrays import random_tiles
from tilewright.functions import tile_arrays, tile_packs
from tilewright.operators import tiles, views
from tilewright.plans import build, lifecycle, sweep
from tilewright.plans.config import Config, Manifest
from tilewright.sources import cells, fixtures, occurrences
from tilewright.sources.shared import short_lived_shuffles


@pytest.mark.parametrize("most", [1, 10**12])
def test_pieces_are_read_as_packed(most):
    rng = np.random.default_rng(3)
    bor = np.array([0, -5, 99907, 199203, 2147483647, -2147483648, 50])
    key = np.sort(tile_packs.by_layer(rng.choice(bor, 2000)) << 28 | rng.integers(0, 1 << 28, 2000))
    n, begin = rng.integers(1, most + 1, 2000), np.array([0, 1, 700, 1999])
    key = np.concatenate([np.sort(k) for k in np.split(key, begin[1:])])
    data, offsets = tile_packs.pack(key, n, begin)
    piece, *back = tile_packs.unpack(data, offsets)
    assert (back[0] == key).all() and (back[1] == n).all() and (np.bincount(piece) == np.diff([*begin, 2000])).all()
    assert (tile_packs._bor(tile_packs.by_layer(bor)) == bor).all()


def test_a_tile_made_layer_by_layer_is_the_same(monkeypatch):
    _, x, y, bor, n = random_tiles(5, 1, 30_000, 5)
    order = np.lexsort((y, x, tile_packs.by_layer(bor)))
    key = ((tile_packs.by_layer(bor) << 10 | x + 64) << 10 | y + 64)[order]
    parts = [tile_packs.pack(k, c, np.zeros(1, np.int64))[0] for k, c in ((key[::2], n[order][::2]), (key[1::2], n[order][1::2]))]
    data, offsets = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
    monkeypatch.setattr(tile_packs, "PIECE_BYTES", 100)
    assert b"".join(tile_packs._by_layers(data, offsets, 512, 64)) == tile_arrays.encode(x * 0, tile_arrays.pack(x, y, bor, n, 64), 1, 512, 64)[0]


@pytest.mark.parametrize("top, buffer, part, piece", [(1, 700, 50, 200), (2, 3_000_000, 300_000, 1 << 20)])
def test_packed_zooms_are_the_direct_projection(spark, monkeypatch, top, buffer, part, piece):
    for where, name, value in ((sweep, "PACK_BUFFER", buffer), (sweep, "PACK_PART", part), (tile_packs, "PIECE_BYTES", piece)):
        monkeypatch.setattr(where, name, value)
    records = occurrences.map_input(fixtures.occurrences(spark, SMALL)).cache()
    large = sorted(r.mapKey for r in views.at_least(views.view_sizes(records), 300).collect())
    counts = views.counts_by_location(records).filter(F.col("mapKey").isin(*large)).cache()
    places = sweep.numbered(records, large, (4326, 3031), top)
    for k, epsg in enumerate((4326, 3031)):
        for zoom in range(top + 1):
            packs = sweep.packs(places.select("borYear", "views", F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")), large, epsg, zoom, top)
            shown = tiles.south(counts) if epsg == 3031 else counts
            want = tiles.cells(tiles.tile_rows(tiles.pixel_counts(shown, epsg, zoom), epsg, zoom), epsg, zoom, 4).collect()
            assert sorted(map(tuple, tiles.pack_cells(packs, epsg, zoom, 4).collect())) == sorted(map(tuple, want)) != []


def test_high_zooms_are_packed(spark):
    records = occurrences.map_input(fixtures.occurrences(spark, SMALL)).limit(300).cache()
    large = ["0:0"]
    packs = sweep.packs(sweep.numbered(records, large, (3857,), 16).select("borYear", "views", F.col("x0").alias("x"), F.col("y0").alias("y")), large, 3857, 16, 16)
    rows = tiles.tile_rows(tiles.pixel_counts(views.counts_by_location(records).filter("mapKey = '0:0'"), 3857, 16), 3857, 16)
    assert sorted(map(tuple, tiles.pack_cells(packs, 3857, 16, 4).collect())) == sorted(map(tuple, tiles.cells(rows, 3857, 16, 4).collect())) != []


def test_a_build_stores_no_counts_and_drops_its_input(spark, tmp_path, monkeypatch):
    """What waits on disk when a zoom is written: records with their pixels, and neither counts, nor pieces, nor the input they come from."""
    seen, write = [], cells.write

    def told(out, path, *more):
        seen.append(sorted(os.listdir(tmp_path / "maps/maps_tiles_20200101_0000/_work")))
        write(out, path, *more)

    monkeypatch.setattr(cells, "write", told)
    config = Config(source="", target=f"file://{tmp_path}/maps", threshold=300, salt_modulus=4, max_zoom=1, partitions=3, projections=(4326,))
    store = build.run(spark, Manifest("tiles", "20200101_0000", config), fixtures.occurrences(spark, SMALL))
    assert seen == [["large", "places"]] * 2 and lifecycle.live(store)["tiles"] == "maps_tiles_20200101_0000"
    files = [f for d, _, names in os.walk(tmp_path / "maps") for f in names if f.endswith(".parquet")]
    assert len(files) == 8 and all(".zstd." in f for f in files)  # one a salt and zoom


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def stored():
        found = files.getAllFiles()
        return {found.apply(k).getName() for k in range(found.size())}

    before = stored()
    with short_lived_shuffles(spark):
        spark.range(1000).repartition(3, "id").write.parquet(f"{tmp_path}/out")
    assert not {f for f in stored() - before if f.startswith("shuffle_")}
