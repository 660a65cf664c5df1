"""Occurrence records: schema, scan, the 19-column projection, the filter for mappable records, and the stored input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT, _INT = T.StringType(), T.IntegerType()
# The ranks of the record model.
TAXON_RANKS = ("kingdomKey", "phylumKey", "classKey", "orderKey", "familyKey", "genusKey", "speciesKey", "taxonKey")

# The columns of the record model.
SCHEMA = T.StructType(
    [
        *[T.StructField(c, _TEXT) for c in ("datasetKey", "publishingOrgKey", "publishingCountry")],
        T.StructField("networkKey", T.ArrayType(_TEXT)),
        *[T.StructField(c, _TEXT) for c in ("countryCode", "basisOfRecord")],
        *[T.StructField(c, T.DoubleType()) for c in ("decimalLatitude", "decimalLongitude")],
        *[T.StructField(c, _INT) for c in TAXON_RANKS],
        T.StructField("year", _INT),
        T.StructField("occurrenceStatus", _TEXT),
        T.StructField("hasGeospatialIssues", T.BooleanType()),
    ]
)


def read(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Scan a source of any Spark format (glob paths allowed). ``avro`` needs Spark's Avro package on the class path."""
    return spark.read.format(fmt).options(**options).load(path)


def project(source: DataFrame) -> DataFrame:
    """The 19 columns, cast to the model's types; the source may have any others."""
    return source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMA])


def of_interest(records: DataFrame) -> DataFrame:
    """Records with coordinates, known to have no geospatial issue and known to be present: unknown is left out."""
    return records.filter(
        F.col("decimalLatitude").isNotNull() & F.col("decimalLongitude").isNotNull() & ~F.col("hasGeospatialIssues") & (F.col("occurrenceStatus") == "PRESENT")
    )


def map_input(source: DataFrame) -> DataFrame:
    return of_interest(project(source))


ROW_GROUP_BYTES = 16 << 20


def store(records: DataFrame, target: str, partitions: int | None = None, as_table: bool = False, fmt: str = "parquet") -> DataFrame:
    """Write the build's input once, replacing an earlier one, and return it read back.

    ``partitions`` evens out files that come from many small ones; without it Spark's adaptive rebalancing sizes them.
    Row groups are small, so that few files still keep many tasks busy.
    """
    spark = records.sparkSession
    even = records.repartition(partitions) if partitions else records.hint("rebalance")
    if as_table:
        even.write.mode("overwrite").format(fmt).saveAsTable(target)
        return spark.table(target)
    even.write.mode("overwrite").format(fmt).option("parquet.block.size", ROW_GROUP_BYTES).save(target)
    return spark.read.schema(records.schema).format(fmt).load(target)


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)
