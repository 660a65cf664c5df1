"""Basis of record and year in one integer: year * 100 + code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The codes of the bases of record.
CODES = {
    "PRESERVED_SPECIMEN": 0,
    "MACHINE_OBSERVATION": 1,
    "OCCURRENCE": 2,
    "HUMAN_OBSERVATION": 3,
    "LIVING_SPECIMEN": 4,
    "OBSERVATION": 5,
    "MATERIAL_CITATION": 6,
    "MATERIAL_SAMPLE": 7,
    "FOSSIL_SPECIMEN": 8,
}


def _lookup(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def encode(basis: Column, year: Column, strict: bool = True) -> Column:
    """The encoded integer; a null year counts as 0. An unknown or null basis fails the query, or is null if not ``strict``."""
    code = F.try_element_at(_lookup(CODES), basis)
    if strict:
        code = F.coalesce(code, F.raise_error(F.concat(F.lit("unknown basis of record: "), F.coalesce(basis, F.lit("null")))).cast("int"))
    return (F.coalesce(year, F.lit(0)).cast("bigint") * 100 + code).cast("int")


def year(encoded: Column) -> Column:
    """The year; null where it was null, 0 or negative (division truncates)."""
    whole = F.when(encoded >= 0, F.floor(encoded / 100)).otherwise(0).cast("int")
    return F.nullif(whole, F.lit(0))


def basis_of_record(encoded: Column) -> Column:
    """The basis's name; null for a remainder that is no code (the remainder keeps the sign)."""
    return F.try_element_at(_lookup({v: k for k, v in CODES.items()}), (encoded % 100).cast("int"))
