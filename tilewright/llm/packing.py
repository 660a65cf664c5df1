"""Operator 1, best-fit packing with several permitted bin capacities.

A bin of capacity c costs ``c + overhead``. Documents are cut into pieces of at most the largest capacity. The pieces
of a block are placed longest first: each goes into the open bin it leaves the least room in; if none fits, the size
opened is the one of least cost for each token it is likely to hold, judged by the tokens of this block still to be
placed. At the end every bin is downsized to the smallest capacity that holds its contents. So the sizes are weighed
together: large bins while much is left to share their overhead, and what a large one leaves empty is given back. ``cost`` sets the
outcome against a bound that no packing can pass.

Blocks hold about ``block_pieces`` pieces. A row's block follows from its content and from which of its copies it is, never
from files or partitions, and the rows of a block are sorted, so bins are the same however the table is stored. Copies of one row are
counted before they are shuffled and dealt out in chunks. Memory is bounded by a block, and a lost task is recomputed alone. No bin
stays open across blocks; the last bins of a block are downsized like any other.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import lean
from ._util import fresh, materialize, whole_groups

CAPACITIES = (1024, 2048, 4096, 8192)
OVERHEAD = 32
BLOCK_PIECES = 50_000
COPIES_PER_CHUNK = 1024


def cut(length: int, largest: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    return [(s, min(largest, length - s)) for s in range(0, length, largest)]


def best_fit(lengths: list[int], capacities: tuple[int, ...], overhead: int) -> tuple[list[int], list[int], list[int]]:
    """(bin of each piece, offset of each piece, capacity of each bin) for pieces of 1..max(capacities)."""
    sizes = sorted(set(capacities))
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    remaining = sum(lengths)
    bins, offsets, used, caps = [0] * len(lengths), [0] * len(lengths), [], []
    rooms: list[tuple[int, int]] = []  # (room left, bin) of the open bins, ascending
    for i in order:
        n = lengths[i]
        at = bisect_left(rooms, (n, -1))
        if at < len(rooms):
            _, b = rooms.pop(at)
        else:
            # a bin can't hold more than what is left to place; an emptier one pays for room it won't use
            cap = min((c for c in sizes if c >= n), key=lambda c: ((c + overhead) / min(c, remaining), -c))
            b = len(caps)
            caps.append(cap)
            used.append(0)
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        remaining -= n
        if caps[b] > used[b]:
            insort(rooms, (caps[b] - used[b], b))
    return bins, offsets, [sizes[bisect_left(sizes, u)] for u in used]


def pack(docs: DataFrame, length: str, keep: list[str], capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """One row per piece: ``keep`` columns, piece_start, piece_length, bin_id, bin_offset, bin_capacity.

    A document whose length is null or not positive has no tokens to place: one row with piece_length 0 and null bin
    columns. Repeated rows are placed one by one; which of them takes which place is open. Pieces of a document keep their
    order by piece_start, and may lie in different bins. Pieces of one length are placed in the order of a digest of their
    rows. An empty table gives an empty result. Result columns that clash with ``keep`` get a trailing underscore.
    """
    largest = max(capacities)
    mine = docs.select(*[F.col(f"`{k}`") for k in keep])
    names = [fresh(mine, x) for x in ("piece_start", "piece_length", "bin_id", "bin_offset", "bin_capacity")]
    size, copies, chunk, block, digest = (fresh(mine, f"_bf_{x}") for x in ("size", "copies", "chunk", "block", "digest"))
    held = [F.col(f"`{k}`") for k in keep]
    rows = materialize(docs.select(*held, F.col(f"`{length}`").cast("bigint").alias(size)), "lengths")
    pieces = F.ceil(F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(1)) / largest)
    blocks = max(1, -(-(rows.agg(F.sum(pieces)).first()[0] or 0) // block_pieces))
    rows = rows.groupBy(*held, size).agg(F.count("*").alias(copies))
    content = F.to_json(F.struct(*held, F.col(size)))
    rows = rows.withColumn(digest, F.xxhash64(content)).withColumn(chunk, F.explode(F.sequence(F.lit(0), F.floor((F.col(copies) - 1) / COPIES_PER_CHUNK))))
    of_chunk = F.least(F.lit(COPIES_PER_CHUNK), F.col(copies) - F.col(chunk) * COPIES_PER_CHUNK).cast("bigint")
    rows = rows.select(F.pmod(F.xxhash64(digest, chunk), F.lit(blocks)).alias(block), F.coalesce(size, F.lit(0)).alias(size), digest, of_chunk.alias(copies), *held)
    rows = rows.repartition(block).sortWithinPartitions(block, F.col(size).desc(), digest, copies, content.desc())
    shape = ", ".join([*[f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep], *[f"`{n}` bigint" for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, 1):
            which = group.column(0).to_numpy()
            bounds = [0, *(np.flatnonzero(which[1:] != which[:-1]) + 1).tolist(), len(which)]
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                yield from packed(group.slice(lo, hi - lo))

    def packed(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        base = rows.column(0)[0].as_py() << 32
        owner, start, piece = [], [], []
        for r, (n, times) in enumerate(zip(rows.column(1).to_pylist(), rows.column(3).to_pylist(), strict=True)):
            parts = cut(n, largest) if n > 0 else [(0, 0)]
            for s, p in parts * times:
                owner.append(r)
                start.append(s)
                piece.append(p)
        placed = [k for k, p in enumerate(piece) if p]
        bins, offsets, caps = best_fit([piece[k] for k in placed], capacities, overhead)
        ids, at, cap = ([None] * len(piece) for _ in range(3))
        for k, b, o in zip(placed, bins, offsets, strict=True):
            ids[k], at[k], cap[k] = base + b, o, caps[b]
        for first in range(0, len(owner), 10_000):
            part = slice(first, first + 10_000)
            own = pa.Table.from_batches([rows.select(list(range(4, 4 + len(keep))))]).take(pa.array(np.array(owner[part], np.int64))).combine_chunks()
            columns = [c.chunk(0) for c in own.columns]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(x[part], pa.int64()) for x in (start, piece, ids, at, cap)]], [*keep, *names])

    return rows.mapInArrow(lean(run), shape)


def cost(packing: DataFrame, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD) -> DataFrame:
    """One row about what ``pack`` has made: bins, tokens, room, fill, cost, least_cost and excess = cost / least_cost.

    least_cost is what the tokens would cost in full bins of the best size; no packing costs less. The names must be
    pack's own.
    """
    rate = min((c + overhead) / c for c in capacities)
    bins = packing.filter("bin_id is not null").groupBy("bin_id").agg(F.first("bin_capacity").alias("room"), F.sum("piece_length").alias("tokens"))
    total = bins.agg(F.count("*").alias("bins"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("room"), F.lit(0)).alias("room"))
    spent, least = F.col("room") + overhead * F.col("bins"), F.col("tokens") * rate
    return total.select("bins", "tokens", "room", (F.col("tokens") / F.col("room")).alias("fill"), spent.alias("cost"), least.alias("least_cost"), (spent / least).alias("excess"))
