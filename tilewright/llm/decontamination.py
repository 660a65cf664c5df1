"""Operator 9, benchmark decontamination: Wu-Manber search of benchmark word windows in documents.

Texts become sequences of 64-bit word hashes. All windows of one length m are searched together: a shift table
over hashed blocks of two adjacent words tells how far the window's end may move, a block that ends some window
(shift 0) selects the windows in its suffix bucket that begin with the word at hand, and a direct comparison of the words
themselves confirms each.

The benchmark is compiled on the driver in parts of at most ``part_words`` words, or one item. One part is held, and
broadcast for one pass over the documents, at a time; so what is broadcast has a fixed bound however large the benchmark grows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import lean
from ._util import drop_table, fresh, materialize
from ._words import ALNUM, buffers, chunks, word_places

WINDOW = 10
PART_WORDS = 200_000


class Text:
    """A text's words: hashes, and where each begins and ends in the bytes of its batch."""

    def __init__(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.hashes, self.data, self.starts, self.ends = hashes, data, starts, ends

    def words(self, first: int, size: int) -> bytes:
        """Words in lower case, joined by a space."""
        return b" ".join(self.data[s:e].tobytes().lower() for s, e in zip(self.starts[first : first + size], self.ends[first : first + size], strict=True))


def texts_of(column: pa.Array) -> Iterator[Text]:
    data, offsets = buffers(column)
    for first, last in chunks(offsets):
        hashes, at, starts, ends = word_places(data, offsets[first : last + 1], ALNUM)
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield Text(hashes[lo:hi], data, starts[lo:hi], ends[lo:hi])


class WuManber:
    """Windows of ``size`` words, each (hashes, words) with the items it comes from."""

    def __init__(self, size: int, windows: dict[bytes, tuple[list[int], list[str]]]):
        self.size, self.block = size, min(2, size)
        self.far = size - self.block + 1
        self.shift: dict[int, int] = {}
        self.bucket: dict[int, dict[int, list[tuple[bytes, list[str]]]]] = {}
        for words, (hashes, items) in windows.items():
            for end in range(self.block, size + 1):
                key, left = self._key(hashes[end - self.block : end]), size - end
                self.shift[key] = min(self.shift.get(key, self.far), left)
            ending = self.bucket.setdefault(self._key(hashes[size - self.block :]), {})
            ending.setdefault(hashes[0], []).append((words, items))

    @staticmethod
    def _key(block: list[int]) -> int:
        return (block[0] * 31 + block[-1]) & ((1 << 64) - 1)

    def keys(self, hashes: np.ndarray) -> list[int]:
        """For each word the key of the block that ends with it."""
        before = hashes if self.block == 1 else np.append(np.zeros(1, np.uint64), hashes[:-1])
        return (before * np.uint64(31) + hashes).tolist()

    def search(self, text: Text, hashes: list[int], keys: list[int]) -> Iterator[tuple[int, list[str]]]:
        """(start, items) of each occurrence."""
        shift, far, size, i, n = self.shift, self.far, self.size, self.size - 1, len(hashes)
        while i < n:
            step = shift.get(keys[i], far)
            if step:
                i += step
                continue
            start = i - size + 1
            if tests := self.bucket[keys[i]].get(hashes[start]):
                here = text.words(start, size)
                for words, items in tests:
                    if words == here:
                        yield start, items
            i += 1


def compile_items(items: list[tuple[str, str | None]], window: int) -> list[WuManber]:
    """One searcher for each window length; equal windows of several items are kept once."""
    by_size: dict[int, dict[bytes, tuple[list[int], list[str]]]] = defaultdict(dict)
    for (name, _), text in zip(items, texts_of(pa.array([text or "" for _, text in items], pa.large_string())), strict=True):
        hashes = text.hashes.tolist()
        size = min(window, len(hashes))
        for start in range(len(hashes) - size + 1 if size else 0):
            owners = by_size[size].setdefault(text.words(start, size), (hashes[start : start + size], []))[1]
            if name not in owners[-1:]:
                owners.append(name)
    return [WuManber(size, windows) for size, windows in sorted(by_size.items())]


def _find(text: Text, searchers: list[WuManber]) -> tuple[list[int], list[int], set[str]]:
    """Starts and ends of occurrences, and the items they belong to."""
    starts, ends, found = [], [], set()
    hashes = text.hashes.tolist()
    keys: dict[int, list[int]] = {}
    for s in searchers:
        if len(hashes) < s.size:
            continue
        if s.block not in keys:
            keys[s.block] = s.keys(text.hashes)
        for start, items in s.search(text, hashes, keys[s.block]):
            starts.append(start)
            ends.append(start + s.size)
            found.update(items)
    return starts, ends, found


_FOUND = ("n_words", "starts", "ends", "items")


def _search_part(docs: DataFrame, key: list[str], text: str, names: list[str], searchers: Broadcast) -> DataFrame:
    """One row a row: key columns and what is found, under ``names``."""
    kinds = ("bigint", "array<int>", "array<int>", "array<string>")
    shape = ", ".join([*[f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in key], *[f"`{n}` {kind}" for n, kind in zip(names, kinds, strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, starts, ends, items = [], [], [], []
            for words in texts_of(batch.column(len(key))):
                s, e, found = _find(words, searchers.value)
                count.append(len(words.hashes))
                starts.append(s)
                ends.append(e)
                items.append(sorted(found))
            kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(key)], *[pa.array(c, k) for c, k in zip((count, starts, ends, items), kinds, strict=True)]], [*key, *names])

    body = fresh(docs.select(*[F.col(f"`{k}`") for k in key]), "_text")
    return docs.select(*[F.col(f"`{k}`") for k in key], F.col(f"`{text}`").alias(body)).mapInArrow(lean(run), shape)


def _parts(benchmark: DataFrame, item: str, text: str, part_words: int) -> Iterator[list[tuple[str, str | None]]]:
    """Benchmark items in parts of about ``part_words`` words, streamed to the driver one partition at a time."""
    part, size = [], 0
    for row in benchmark.select(F.col(item).cast("string"), F.col(text)).toLocalIterator():
        part.append((row[0] if row[0] is not None else "", row[1]))
        size += len(row[1] or "") // 4
        if size >= part_words:
            yield part
            part, size = [], 0
    if part:
        yield part


def occurrences(docs: DataFrame, benchmark: DataFrame, key: list[str], text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, part_words: int = PART_WORDS) -> DataFrame:
    """One row per row of ``docs``: key columns, n_words, starts, ends (word intervals of occurrences), items.

    ``key`` is carried along and need not name a row: repeated rows and null keys give a result each. With a benchmark
    of several parts the rows are numbered and stored first, and their findings are gathered by that number.
    Null and empty texts have no words. A benchmark without words matches nothing, and no documents give no rows. Items
    are sorted as strings. Result columns that clash with ``key`` get a trailing underscore.
    """
    spark = docs.sparkSession
    names = [fresh(docs.select(*[F.col(f"`{k}`") for k in key]), n) for n in _FOUND]
    parts = _parts(benchmark, item, item_text, part_words)
    first, second = next(parts, []), next(parts, None)
    if second is None:
        return _search_part(docs, key, text, names, spark.sparkContext.broadcast(compile_items(first, window)))
    row, body = fresh(docs, "_wm_row"), fresh(docs, "_wm_text")
    carried = [F.col(f"`{k}`") for k in key]
    numbered = materialize(docs.select(F.monotonically_increasing_id().alias(row), *carried, F.col(f"`{text}`").alias(body)), "numbered-documents")
    found: list[DataFrame] = []
    part = first
    while part is not None:
        searchers = spark.sparkContext.broadcast(compile_items(part, window))
        # after the first part only rows with findings are needed
        out = _search_part(numbered, [row, *key] if not found else [row], body, names, searchers)
        found.append(materialize(out if not found else out.filter(F.size(names[1]) > 0), "part-findings"))
        searchers.destroy()
        part, second = second, next(parts, None) if second is not None else None
    drop_table(numbered)
    more = found[1]
    for other in found[2:]:
        more = more.unionByName(other)
    flat = lambda c: F.flatten(F.collect_list(c))  # noqa: E731  one list a part
    more = more.groupBy(row).agg(*[flat(n).alias(f"_more_{k}") for k, n in enumerate(names[1:])])
    joined = found[0].join(more.withColumnRenamed(row, "_more_row"), F.col(row) == F.col("_more_row"), "left")
    both = [F.concat(F.col(f"`{n}`"), F.coalesce(F.col(f"_more_{k}"), F.array().cast(joined.schema[n].dataType))) for k, n in enumerate(names[1:])]
    both[2] = F.sort_array(F.array_distinct(both[2]))
    return joined.select(*carried, F.col(f"`{names[0]}`"), *[c.alias(n) for c, n in zip(both, names[1:], strict=True)])


def covered(starts: Iterator[int], ends: Iterator[int]) -> int:
    """Words inside any of the intervals."""
    total, reach = 0, 0
    for s, e in sorted(zip(starts, ends, strict=True)):
        total += max(0, e - max(s, reach))
        reach = max(reach, e)
    return total


def covered_words(starts: str, ends: str):
    """The number of words inside any interval, as a column."""
    both = F.array_sort(F.arrays_zip(F.col(starts).alias("s"), F.col(ends).alias("e")))
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("reach"))
    step = lambda acc, x: F.struct(
        (acc["total"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["reach"]))).alias("total"),
        F.greatest(acc["reach"], x["e"]).alias("reach"),
    )
    return F.aggregate(both, start, step, lambda acc: acc["total"].cast("long"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, part_words: int = PART_WORDS) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; all columns stay, whatever their names.

    Documents with null or empty text stay, nulls in other columns don't count. Repeated rows are judged alike, and an empty
    table or benchmark takes nothing out. With a benchmark of one part this is a
    filter without a shuffle; with more, every part filters what the one before has kept, which is stored in between.
    """
    spark = docs.sparkSession
    if not docs.columns:
        return docs
    out = docs
    parts = _parts(benchmark, item, item_text, part_words)
    items, following = next(parts, None), next(parts, None)
    while items is not None:
        searchers = spark.sparkContext.broadcast(compile_items(items, window))

        def flags(batches, searchers=searchers):
            for batch in batches:
                keep = [not _find(words, searchers.value)[0] for words in texts_of(batch.column(batch.schema.get_field_index(text)))]
                yield batch.filter(pa.array(keep, pa.bool_()))

        before, out = out, out.mapInArrow(lean(flags), docs.schema)
        if following is not None:
            out = materialize(out, "clean-so-far")
            searchers.destroy()
            if before is not docs:
                drop_table(before)
        items, following = following, next(parts, None) if following is not None else None
    return out
