"""Incremental view counts: occurrence records arrive as a stream and the counts by place are kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.views import counts_by_location
from ..sources.occurrences import SCHEMA, map_input


def read_stream(spark: SparkSession, folder: str, fmt: str = "parquet", max_files: int = 100) -> DataFrame:
    return spark.readStream.schema(SCHEMA).format(fmt).option("maxFilesPerTrigger", max_files).load(folder)


def running_counts(stream: DataFrame, strict: bool = False) -> DataFrame:
    """(mapKey, lat, lng, borYear, occCount) of all records so far: the batch plan, which only adds, run as a stream.

    The state has a row for each distinct key, as many as the batch result; records carry no event time to expire it by.
    """
    return counts_by_location(map_input(stream), strict)


def write_changes(counts: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Each batch's changed counts as Parquet, in a folder of its own; a repeated batch replaces what it wrote."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return counts.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, folder: str) -> DataFrame:
    """The newest count of each key from the changes written so far."""
    changes = spark.read.parquet(folder)
    keys = ["mapKey", "lat", "lng", "borYear"]
    return changes.groupBy(*keys).agg(F.max_by("occCount", "batch").alias("occCount"))
