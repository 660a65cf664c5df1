from collections import Counter

from pyspark.sql import functions as F

from tests.llm import cases
from tilewright.llm import sharding


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 100, 1023, 1025, 5000):
        out = [r[0] for r in spark.range(n).select(sharding.permute(F.col("id"), n, 3)).collect()]
        assert sorted(out) == list(range(n))
    assert out != list(range(n))


def test_grid_is_tight():
    for n in (1, 2, 3, 10, 99, 100, 101, 10**6 + 7):
        a, b = sharding.grid(n)
        assert a * b >= n and a * b - n < a


def check(rows, n, k):
    counts = Counter(r["shard_"] if "shard_" in r.asDict() else r["shard"] for r in rows)
    assert len(rows) == n and max(counts.values()) - min(counts.get(s, 0) for s in range(k)) <= 1
    slots = {}
    for r in rows:
        d = r.asDict()
        slots.setdefault(d.get("shard_", d["shard"]), []).append(d["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_awkward_rows_and_layout_do_not_matter(spark):
    a = sharding.shard(cases.frame(spark, partitions=1), 4).collect()
    b = sharding.shard(cases.frame(spark, partitions=7), 4).collect()
    check(a, len(cases.rows()), 4)
    assert Counter(map(str, a)) == Counter(map(str, b))
    assert {"shard", "shard_", "row_number", "slot"} <= set(a[0].asDict())


def test_a_row_repeated_often(spark):
    df = spark.createDataFrame([(1, "x")] * 9000 + [(i, "y") for i in range(50)], "doc_id bigint, text string")
    check(sharding.shard(df, 8).collect(), 9050, 8)


def test_copies_of_a_row_do_not_meet_in_a_task(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES_PER_CHUNK", 50)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(1, "x")] * 4000 + [(i, "y") for i in range(50)], "doc_id bigint, text string")
        out = sharding.shard(df, 8)
        held = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        check(out.collect(), 4050, 8)
        assert len(held) == 4 and max(held) < 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty(spark):
    assert sharding.shard(cases.empty(spark), 8).count() == 0
