"""Views: fan-out of records to map keys, view sizes, the size threshold, and the split by a set of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bor_year import encode
from ..functions.map_keys import map_keys

BROADCAST_KEYS = 500_000


def fan_out(records: DataFrame, keys: Column | None = None) -> DataFrame:
    """One row for each record and map key; a record without keys vanishes."""
    return records.withColumn("mapKey", F.explode(map_keys() if keys is None else keys))


def view_sizes(records: DataFrame) -> DataFrame:
    """(mapKey, occCount): records in each view, combined before the shuffle."""
    return fan_out(records.select(*_KEY_COLUMNS)).groupBy("mapKey").agg(F.count("*").alias("occCount"))


def at_least(sizes: DataFrame, threshold: int) -> DataFrame:
    """Views of ``threshold`` records or more."""
    return sizes.filter(F.col("occCount") >= threshold)


def compact(records: DataFrame, strict: bool = True) -> DataFrame:
    """The columns that name views, lat, lng and borYear; not ``strict``: without records of an unknown basis."""
    narrow = records.select(
        *_KEY_COLUMNS, F.col("decimalLatitude").alias("lat"), F.col("decimalLongitude").alias("lng"), encode(F.col("basisOfRecord"), F.col("year"), strict).alias("borYear")
    )
    return narrow if strict else narrow.filter(F.col("borYear").isNotNull())


def _sum_places(rows: DataFrame) -> DataFrame:
    return rows.groupBy("mapKey", "lat", "lng", "borYear").agg(F.count("*").alias("occCount"))


def counts_by_location(records: DataFrame, strict: bool = True) -> DataFrame:
    """(mapKey, lat, lng, borYear, occCount): records of each view by place and encoded basis and year.

    ``strict``: an unknown basis of record fails the query; otherwise such records are left out.
    """
    return _sum_places(fan_out(compact(records, strict)))


def counts_of_views(records: DataFrame, keys: DataFrame, approve: bool, strict: bool = True, compat_empty_approve: bool = False, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``counts_by_location`` of the views among ``keys`` (approve), or of the others.

    Few keys are broadcast and drop rows as they are fanned out, before the sums and their shuffle. More are joined by
    shuffle after the sums.
    """
    keys, few = measured(keys, broadcast_keys)
    if few is not None:
        return _sum_places(_split(fan_out(compact(records, strict)), keys, few, approve, compat_empty_approve))
    return _split(counts_by_location(records, strict), keys, few, approve, compat_empty_approve)


def measured(keys: DataFrame, most: int) -> tuple[DataFrame, list | None]:
    """The distinct keys, and the list of them if they are ``most`` or fewer."""
    keys = keys.select("mapKey").distinct()
    found = keys.limit(most + 1).collect()
    return keys, (None if len(found) > most else found)


def _split(rows: DataFrame, keys: DataFrame, few: list | None, approve: bool, compat_empty_approve: bool) -> DataFrame:
    if few is not None:
        if not few and (compat_empty_approve or not approve):
            return rows
        keys = F.broadcast(rows.sparkSession.createDataFrame(few, "mapKey string"))
    return rows.join(keys, "mapKey", "left_semi" if approve else "left_anti")


def select_views(rows: DataFrame, keys: DataFrame, approve: bool, compat_empty_approve: bool = False, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Rows whose mapKey is among ``keys`` (approve), or is not (deny).

    No keys: approve gives nothing and deny gives all; with ``compat_empty_approve`` approve gives all, too.
    Up to ``broadcast_keys`` keys are read once and broadcast; more are shuffled.
    """
    return _split(rows, *measured(keys, broadcast_keys), approve, compat_empty_approve)


# The columns of the record model that name views.
_KEY_COLUMNS = (
    "kingdomKey", "phylumKey", "classKey", "orderKey", "familyKey", "genusKey", "speciesKey", "taxonKey",
    "datasetKey", "publishingOrgKey", "countryCode", "publishingCountry", "networkKey",
)
