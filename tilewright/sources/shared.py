"""The folder that all executors share."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``). Only where it is unset and Spark runs in one process, as in tests, a local one."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="tilewright-"))
    return f"file://{_LOCAL[0]}"


@contextlib.contextmanager
def _held(spark: SparkSession, conf: str, value: str) -> Iterator[None]:
    before = spark.conf.get(conf, None)
    spark.conf.set(conf, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(conf)
        else:
            spark.conf.set(conf, before)


def small_batches(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Arrow batches of at most BATCH_BYTES while plans of wide rows run, so that a task's memory is bounded."""
    return _held(spark, _BATCH_CONF, str(BATCH_BYTES))


def short_lived_shuffles(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """A query's shuffle files go when it ends, and not when the driver happens to collect its garbage."""
    return _held(spark, _CLEANUP_CONF, "true")


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` of a task, which gives freed memory back to the system at its end: the worker lives on, and later stages need it."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no glibc
        ctypes.CDLL(None).malloc_trim(0)
