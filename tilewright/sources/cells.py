"""The cell store: versioned folders of Parquet cells, laid out by family and zoom and sorted by salted key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.layout import by_salt
from .shared import small_batches


#: A cell may have megabytes, so the writer looks at its size after each, and row groups are small.
_BOUNDS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 100, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 100}


def path_of(target: str, table: str, mode: str, family: str | None = None, zoom: int | None = None) -> str:
    """The one layout that writers and readers share: points in <table>/points, tiles in <table>/tiles/<family>/z<zoom>."""
    base = f"{target.rstrip('/')}/{table}/{mode}"
    if mode == "tiles" and family is not None:
        base += f"/{family}"
        if zoom is not None:
            base += f"/z{zoom}"
    return base


def write(cells: DataFrame, path: str, modulus: int, compression: str = "snappy", laid: bool = False) -> None:
    """One file for each salt, sorted by row key. ``laid``: the cells come that way."""
    with small_batches(cells.sparkSession):
        (cells if laid else by_salt(cells, modulus)).write.mode("overwrite").options(**_BOUNDS).option("compression", compression).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All cells below ``path``."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)
