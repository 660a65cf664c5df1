"""Row layout of the output: one partition for each salt, sorted by row key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.keys import salt_from


def by_salt(cells: DataFrame, modulus: int) -> DataFrame:
    """``cells`` with partition i holding exactly the keys of salt i, in key order."""
    salt = salt_from(F.col("row_key"), modulus)
    return cells.withColumn("_salt", salt).repartitionById(modulus, "_salt").sortWithinPartitions("row_key").drop("_salt")


def superseded(names: DataFrame, keep: int = 2) -> DataFrame:
    """Of tables (mode, name), those older than the newest ``keep`` of their mode; names sort by time."""
    newest = W.partitionBy("mode").orderBy(F.col("name").desc())
    return names.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") > keep).drop("rank")
