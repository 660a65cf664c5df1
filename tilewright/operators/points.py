"""Point lists of small views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import salted
from ..functions.wire import encode_column, point_features


def assemble(counts: DataFrame) -> DataFrame:
    """(mapKey, features): each view's places, sorted; a view below the size threshold bounds the list."""
    return counts.groupBy("mapKey").agg(F.sort_array(F.collect_list(F.struct("lat", "lng", "borYear", "occCount"))).alias("features"))


def cells(features: DataFrame, modulus: int) -> DataFrame:
    """(row_key, family, qualifier, value): the encoded list of each view."""
    keyed = features.select(salted(F.col("mapKey"), modulus).alias("row_key"), "features")
    return encode_column(keyed, "features", point_features, ["row_key"]).select("row_key", F.lit("EPSG_4326").alias("family"), F.lit("features").alias("qualifier"), "value")
