"""Map keys: the views a record belongs to, as "<type>:<value>"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.occurrences import TAXON_RANKS

# The view types.
ALL, TAXON, DATASET, PUBLISHER, COUNTRY, PUBLISHING_COUNTRY, NETWORK = range(7)
ALL_KEY = f"{ALL}:0"


def _key(kind: int, value: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), value.cast("string"))  # null for a null value


def map_keys(
    taxa: list[Column] | None = None, dataset: Column | None = None, publisher: Column | None = None, country: Column | None = None, publishing_country: Column | None = None, networks: Column | None = None
) -> Column:
    """The distinct map keys of a record; nulls give none, an empty string is a value, "0:0" is always there.

    By default the columns of the occurrence model are used.
    """
    taxa = [F.col(c) for c in TAXON_RANKS] if taxa is None else taxa
    named = {
        DATASET: F.col("datasetKey") if dataset is None else dataset,
        PUBLISHER: F.col("publishingOrgKey") if publisher is None else publisher,
        COUNTRY: F.col("countryCode") if country is None else country,
        PUBLISHING_COUNTRY: F.col("publishingCountry") if publishing_country is None else publishing_country,
    }
    networks = F.col("networkKey") if networks is None else networks
    single = F.array(F.lit(ALL_KEY), *[_key(TAXON, c) for c in taxa], *[_key(k, c) for k, c in named.items()])
    many = F.transform(F.coalesce(networks, F.array().cast("array<string>")), lambda n: _key(NETWORK, n))
    return F.array_distinct(F.array_compact(F.concat(single, many)))
