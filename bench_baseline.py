"""The engine against plainer forms of itself, at $BENCH_SF_DIR: prints one JSON line of seconds.

Zooms by halving against projecting each zoom anew, and projection by column expressions against a Python function.
"""

from __future__ import annotations

import json
import math
import os
import sys
import time
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOP = 10


def main() -> None:
    root = Path(__file__).resolve().parent
    sys.path.insert(0, str(root))
    os.environ["PYTHONPATH"] = f"{root}:{os.environ.get('PYTHONPATH', '')}"
    from tilewright.operators import tiles, views
    from tilewright.plans import pyramid
    from tilewright.sources import fixtures, occurrences
    from tilewright.sources.shared import shared_dir

    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("baseline").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = f"{shared_dir(spark)}/baseline"
    views.counts_by_location(occurrences.map_input(fixtures.occurrences(spark, folder))).write.mode("overwrite").parquet(f"{base}/counts")
    counts = spark.read.parquet(f"{base}/counts")
    made = iter(range(1000))

    def settle(level: DataFrame) -> DataFrame:
        path = f"{base}/levels/{next(made)}"
        level.write.mode("overwrite").parquet(path)
        return spark.read.schema(level.schema).parquet(path)

    def mercator(lat: float, lng: float) -> list[int] | None:
        if lat is None or lng is None or abs(lat) > 85.0511287798066:
            return None
        side = 512 << TOP
        x, y = (lng + 180) / 360 * side, (0.5 - math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)) / (2 * math.pi)) * side
        return [min(max(int(v), 0), side - 1) for v in (x, y)]

    by_function = F.udf(mercator, "array<int>")("lat", "lng")
    forms = {
        "zooms_by_halving": lambda: pyramid.pyramid(counts, 3857, TOP, settle=settle),
        "zooms_projected_anew": lambda: reduce(DataFrame.unionByName, [tiles.pixel_counts(counts, 3857, z) for z in range(TOP, -1, -1)]),
        "projection_by_columns": lambda: tiles.place_pixels(counts, 3857, TOP),
        "projection_by_python": lambda: counts.withColumn("p", by_function).filter("p is not null").select("mapKey", F.col("p")[0], F.col("p")[1], "borYear", "occCount"),
    }
    seconds = {}
    for name, form in forms.items():
        form().write.format("noop").mode("overwrite").save()
        began = time.perf_counter()
        form().write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"unit": "sec", "top_zoom": TOP, "seconds": seconds, "sf": Path(folder).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
