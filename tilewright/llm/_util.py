"""Shared plumbing: table reading, collision-free column names, durable intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shared_dir, small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name starting with ``stem`` that ``df`` does not have (Spark compares names without case)."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``; a plain reference inside a lambda would be inlined."""
    return F.element_at(F.transform(F.array(value), body), 1)


def materialize(df: DataFrame, stem: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{stem}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files behind a materialized table that no pending plan reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their first ``keys`` columns, again in batches, none of which ends within a group of equal keys.

    One group is held at a time, besides what came with it.
    """
    held: list[pa.RecordBatch] = []
    last: tuple = ()

    def all_held() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in range(keys)]
        here = tuple(c[-1] for c in columns)
        other = np.flatnonzero(np.logical_or.reduce([c != v for c, v in zip(columns, here, strict=True)]))
        begin = int(other[-1]) + 1 if len(other) else 0
        if begin:
            held.append(batch.slice(0, begin))
        if held and (begin or last != here):
            yield all_held()
            held = []
        held.append(batch.slice(begin))
        last = here
    if held:
        yield all_held()
