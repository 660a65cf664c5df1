import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tilewright import queries
from tilewright.functions import wire
from tilewright.operators import layout, tiles, views
from tilewright.plans import build, lifecycle, pyramid
from tilewright.plans.config import Config, Manifest
from tilewright.sources import cells, fixtures, occurrences
from tilewright.streaming import incremental


@pytest.fixture(scope="module")
def records(spark):
    return occurrences.map_input(fixtures.occurrences(spark, SMALL)).cache()


@pytest.fixture(scope="module")
def counts(records):
    return views.counts_by_location(records).cache()


def test_filter_drops_unknowns(spark):
    raw = fixtures.occurrences(spark, SMALL)
    kept = occurrences.map_input(raw.withColumn("extra", F.lit(1)))
    assert kept.columns == [f.name for f in occurrences.SCHEMA]
    assert kept.filter("hasGeospatialIssues is null or hasGeospatialIssues or occurrenceStatus <> 'PRESENT' or decimalLatitude is null").count() == 0


def test_threshold_is_inclusive(records):
    sizes = views.view_sizes(records)
    n = sizes.filter("mapKey = '1:1'").first().occCount
    assert views.at_least(sizes, n).filter("mapKey = '1:1'").count() == 1 and views.at_least(sizes, n + 1).filter("mapKey = '1:1'").count() == 0


@pytest.mark.parametrize("broadcast_keys", [10, 0])
def test_approve_and_deny_split_the_rows(spark, counts, broadcast_keys):
    some = spark.createDataFrame([("0:0",), ("1:1",), ("0:0",)], "mapKey string")
    both = [views.select_views(counts, some, a, broadcast_keys=broadcast_keys) for a in (True, False)]
    assert both[0].count() + both[1].count() == counts.count() and both[0].select("mapKey").distinct().count() == 2
    none = some.filter("mapKey = ''")
    assert views.select_views(counts, none, True).count() == 0 and views.select_views(counts, none, False).count() == counts.count()
    assert views.select_views(counts, none, True, compat_empty_approve=True).count() == counts.count()


@pytest.mark.parametrize("broadcast_keys", [10, 0])
def test_counts_of_views_are_the_split_counts(spark, records, counts, broadcast_keys):
    some = spark.createDataFrame([("0:0",), ("1:1",)], "mapKey string")
    for approve in (True, False):
        got = views.counts_of_views(records, some, approve, broadcast_keys=broadcast_keys)
        want = views.select_views(counts, some, approve)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    plan = views.counts_of_views(records, some, True, broadcast_keys=broadcast_keys)._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.index("Aggregate") < plan.index("Join")) == bool(broadcast_keys)  # the plan's lowest part comes last
    none = some.filter("mapKey = ''")
    assert views.counts_of_views(records, none, True).count() == 0 and views.counts_of_views(records, none, True, compat_empty_approve=True).count() == counts.count()


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0].count("Exchange hashpartitioning")


@pytest.mark.parametrize("epsg", [3857, 4326, 3575, 3031])
def test_cascade_is_the_direct_projection(counts, epsg):
    for zoom, pixels in pyramid.levels(counts, epsg, 9, 6):
        direct = tiles.pixel_counts(counts, epsg, zoom)
        assert pixels.exceptAll(direct).count() == 0 and direct.exceptAll(pixels).count() == 0


def test_a_block_of_zooms_takes_one_shuffle(spark, counts, tmp_path):
    counts.write.parquet(f"{tmp_path}/counts")
    (zooms, block), *_ = pyramid.blocks(spark.read.parquet(f"{tmp_path}/counts"), 3857, 9, 6)
    assert list(zooms) == [9, 8, 7, 6] and exchanges(block) == 1


def test_primary_tiles_keep_the_total(counts):
    pixels = tiles.pixel_counts(counts, 3857, 2)
    rows = tiles.tile_rows(pixels, 3857, 2)
    own = rows.filter("pixelX between 0 and 511 and pixelY between 0 and 511")
    assert own.agg(F.sum("occCount")).first()[0] == pixels.agg(F.sum("occCount")).first()[0]
    assert rows.count() > own.count()


def test_layout(spark):
    keyed = spark.range(500).select(F.concat(F.lpad((F.col("id") % 12).cast("string"), 2, "0"), F.lit(":"), F.col("id")).alias("row_key"))
    placed = layout.by_salt(keyed, 12).withColumn("p", F.spark_partition_id())
    assert placed.filter("p <> cast(substr(row_key, 1, 2) as int)").count() == 0
    for part in placed.drop("p").rdd.map(lambda r: r.row_key).glom().collect():
        assert part == sorted(part)


def test_config():
    c = Config.from_yaml("threshold: 5\nprojections: [4326]\n")
    assert c.threshold == 5 and c.projections == (4326,) and c.tile_size == 512
    for bad in ("nonsense: 1", "max_zoom: 17", "tile_size: 100", "salt_modulus: 0"):
        with pytest.raises(ValueError):
            Config.from_yaml(bad)
    m = Manifest("points", "20200101_0000", c)
    assert Manifest.from_json(m.to_json()) == m and m.table == "maps_points_20200101_0000" and m.families == ["EPSG_4326"]
    with pytest.raises(ValueError):
        Manifest("rasters", "x", c)
    with pytest.raises(ValueError):
        Manifest.from_args(["tiles"])


def test_manifest_from_args(tmp_path):
    (tmp_path / "c.yml").write_text("target: /x\n")
    assert Manifest.from_args(["tiles", f"{tmp_path}/c.yml", "20200101_0000"]).table == "maps_tiles_20200101_0000"
    assert Manifest.from_args(["points", f"{tmp_path}/c.yml"]).mode == "points"


def test_build_and_lifecycle(spark, tmp_path, counts, records):
    source = fixtures.occurrences(spark, SMALL)
    source.write.parquet(f"{tmp_path}/source")
    config = Config(source=f"{tmp_path}/source", target=f"file://{tmp_path}/maps", threshold=1000, salt_modulus=4, max_zoom=2, partitions=3, projections=(4326, 3031))
    store = build.run(spark, Manifest("tiles", "20200101_0000", config))
    build.run(spark, Manifest("points", "20200101_0000", config))
    assert lifecycle.live(store) == {"tiles": "maps_tiles_20200101_0000", "points": "maps_points_20200101_0000"}
    assert not store.exists("maps_tiles_20200101_0000/_work")

    large = {r.mapKey for r in build.large_views(records, config).collect()}
    made = cells.read(spark, cells.path_of(config.target, "maps_points_20200101_0000", "points"))
    point_views = {r.row_key.split(":", 1)[1] for r in made.collect()}
    assert point_views == {r.mapKey for r in counts.select("mapKey").distinct().collect()} - large
    z1 = cells.read(spark, cells.path_of(config.target, "maps_tiles_20200101_0000", "tiles", "EPSG_4326", 1))
    got = {(r.row_key.split(":", 1)[1], *x) for r in z1.collect() for x in wire.read_vector_tile(bytes(r.value))}
    chosen = counts.filter(F.col("mapKey").isin(*large))
    rows = tiles.layer_attributes(tiles.tile_rows(tiles.pixel_counts(chosen, 4326, 1), 4326, 1))
    want = {(f"{r.mapKey}:1:{r.tileX}:{r.tileY}", r.layer, r.pixelX, r.pixelY, r.year, r.occCount) for r in rows.collect()}
    assert got == want
    assert build.total(z1).first().family == "EPSG_4326"

    with pytest.raises(FileExistsError):
        lifecycle.create(store, Manifest("tiles", "20200101_0000", config))
    for stamp in ("20200102_0000", "20200103_0000", "20200104_0000"):
        lifecycle.create(store, m := Manifest("tiles", stamp, config))
    assert lifecycle.retire(store, m) == ["maps_tiles_20200102_0000"]  # the oldest is live
    lifecycle.publish(store, m)
    assert lifecycle.retire(store, m) == ["maps_tiles_20200101_0000"] and lifecycle.live(store)["points"] == "maps_points_20200101_0000"
    assert lifecycle.load(store, m.table) == m


def test_sources_may_be_globs_and_nested(spark, tmp_path):
    store = lifecycle.Store(spark, f"file://{tmp_path}/maps")
    for day in (1, 2):
        spark.range(day).withColumn("country", F.lit("DK")).write.partitionBy("country").parquet(f"{tmp_path}/in/day{day}")
    spark.range(9).write.parquet(f"{tmp_path}/in/_draft")
    with lifecycle.pinned(store, f"{tmp_path}/in") as files:
        assert len({f.split("/day")[1][0] for f in files}) == 2 and all("country=DK" in f and f.endswith(".parquet") for f in files)
        with pytest.raises(BlockingIOError), lifecycle.pinned(store, f"{tmp_path}/in"):
            pass
    with lifecycle.pinned(store, f"{tmp_path}/in/day[2]") as files:
        assert occurrences.read(spark, files).count() == 2
    with pytest.raises(FileNotFoundError), lifecycle.pinned(store, f"{tmp_path}/nothing*"):
        pass


def test_publishing_replaces_the_pointer_in_one_step(spark, tmp_path):
    store = lifecycle.Store(spark, f"file://{tmp_path}")
    for stamp in ("20200101_0000", "20200102_0000"):
        lifecycle.publish(store, Manifest("tiles", stamp, Config()))
        assert lifecycle.live(store)["tiles"] == f"maps_tiles_{stamp}"
    assert [f for f in store.files(store.target) if "live" in f] == [f"file:{tmp_path}/live_tiles.json"]


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    from types import SimpleNamespace

    from tilewright.sources import shared

    fake = lambda master, named: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: named), sparkContext=SimpleNamespace(master=master))
    assert shared.shared_dir(fake("spark://h:1", "hdfs://h/ck/")) == "hdfs://h/ck" and shared.shared_dir(fake("local[4]", None)).startswith("file:///")
    for master in ("spark://h:1", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="share"):
            shared.shared_dir(fake(master, None))


def test_lock_and_clean(spark, tmp_path):
    store = lifecycle.Store(spark, f"file://{tmp_path}")
    with lifecycle.locked(store, "x"):
        with pytest.raises(BlockingIOError), lifecycle.locked(store, "x"):
            pass
    with pytest.raises(RuntimeError), lifecycle.locked(store, "x"):
        raise RuntimeError
    with lifecycle.locked(store, "x"):
        pass
    assert not lifecycle.clean(store, "hdfs://host/data/x") and not lifecycle.clean(store, "hdfs://host/tmp/") and not lifecycle.clean(store, "file:///tmp/../etc")


def test_superseded(spark):
    names = spark.createDataFrame([("tiles", f"p_tiles_2020010{d}_0000") for d in (3, 1, 4, 2)] + [("points", "p_points_20200101_0000")], "mode string, name string")
    assert sorted(r.name for r in layout.superseded(names).collect()) == ["p_tiles_20200101_0000", "p_tiles_20200102_0000"]


def test_streaming_counts_equal_the_batch(spark, tmp_path, counts):
    fixtures.occurrences(spark, SMALL).repartition(4).write.parquet(f"{tmp_path}/in")
    stream = incremental.read_stream(spark, f"{tmp_path}/in", max_files=1)
    incremental.write_changes(incremental.running_counts(stream), f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    got = incremental.latest(spark, f"{tmp_path}/out").select(*counts.columns)
    assert got.exceptAll(counts).count() == 0 and counts.exceptAll(got).count() == 0


def test_codecs_are_counted_without_cells(spark, monkeypatch):
    monkeypatch.setattr(queries, "THRESHOLD", 1)  # every view is large, as in big tables: no point cells
    rows = queries.QUERIES["cell_compression"](spark, SMALL).collect()
    assert sorted(map(tuple, rows)) == [(c, 0, 0) for c in ("gzip", "snappy", "zstd")]


def test_stored_input(spark, tmp_path, records):
    stored = occurrences.store(records, f"{tmp_path}/r1", partitions=3)
    assert stored.count() == records.count() and occurrences.store(records.limit(5), f"{tmp_path}/r1").count() == 5
