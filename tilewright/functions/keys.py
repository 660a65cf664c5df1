"""Salted row keys: a salt from the key's digest in front spreads neighbouring keys over the store's regions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def salt_of(key: Column, modulus: int) -> Column:
    """The salt (int) of an unsalted key."""
    return (F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint") % modulus).cast("int")


def salted(key: Column, modulus: int) -> Column:
    """``<salt>:<key>``, the salt padded with zeros so that keys sort by salt."""
    return F.concat(F.lpad(salt_of(key, modulus).cast("string"), len(str(modulus - 1)), "0"), F.lit(":"), key)


def salt_from(row_key: Column, modulus: int) -> Column:
    """The salt (int) read back from a salted key."""
    return F.substring(row_key, 1, len(str(modulus - 1))).cast("int")


def tile_key(map_key: Column, zoom: Column | int, x: Column, y: Column) -> Column:
    zoom = F.lit(zoom) if isinstance(zoom, int) else zoom
    return F.concat_ws(":", map_key, zoom.cast("string"), x.cast("string"), y.cast("string"))
