"""Operator 2, sharding: a Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0..n-1 in the order of a digest of their whole content, so the numbering does not depend on
files, partitions or retries. The row number x is split as (x div b, x mod b) over an a x b grid, a*b >= n with
fewer than a cells to spare, and mixed by alternating modular Feistel rounds; a result >= n walks on along its
cycle until it is below n, which keeps the map a permutation of 0..n-1. The permuted number p gives
``shard = p mod k`` and ``slot = p div k``: counts differ by one at most and slots have no gap.

Everything is built from DataFrame functions. Identical rows are counted before anything is shuffled by key,
numbered as one run, and cut into chunks of copies; the chunks are dealt out anew before they are expanded, so a row repeated
any number of times never meets in a task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._util import fresh

ROUNDS = 4
ROWS_PER_BUCKET = 100_000
COPIES_PER_CHUNK = 4096


def grid(n: int) -> tuple[int, int]:
    """Sides (a, b) of the Feistel domain: a*b >= n and a*b - n < a."""
    a = max(1, math.isqrt(max(n, 1)))
    return a, -(-max(n, 1) // a)


def _draw(half: Column, round_no: int, seed: int) -> Column:
    text = F.concat(F.lit(f"{seed}:{round_no}:"), half.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def _feistel(x: Column, a: int, b: int, seed: int) -> Column:
    left, right = F.floor(x / F.lit(b)).cast("long"), F.pmod(x, F.lit(b))
    for r in range(ROUNDS):
        if r % 2 == 0:
            left = F.pmod(left + _draw(right, r, seed), F.lit(a)).cast("long")
        else:
            right = F.pmod(right + _draw(left, r, seed), F.lit(b)).cast("long")
    return left * F.lit(b) + right


def permute(x: Column, n: int, seed: int) -> Column:
    """The permuted number of row ``x``; the walk is as long as the spare cells, so it always ends below n."""
    a, b = grid(n)
    spare = a * b - n
    once = _feistel(x, a, b, seed)
    if not spare:
        return once
    walk = lambda y: F.when(
        y >= n,
        F.aggregate(F.sequence(F.lit(1), F.lit(spare)), y, lambda z, _: F.when(z < n, z).otherwise(_feistel(z, a, b, seed))),
    ).otherwise(y)
    return F.element_at(F.transform(F.array(once), walk), 1)


def shard(docs: DataFrame, n_shards: int, seed: int = 0, content: Column | None = None) -> DataFrame:
    """``docs`` with columns row_number, shard and slot.

    ``content``: a string that tells rows apart, the numbering order's digest is taken of it; by default the
    row as JSON. Rows equal in every column are interchangeable: each copy takes its own number. Nulls in any
    column are ordinary content. An empty table gives an empty result. Extra columns stay; if the input has
    a column named row_number, shard or slot, the added one gets a trailing underscore.
    """
    names = docs.columns
    digest, copies, bucket, base, offset, chunk = (fresh(docs, f"_sh_{x}") for x in ("digest", "copies", "bucket", "base", "offset", "chunk"))
    number, shard_col, slot = (fresh(docs, x) for x in ("row_number", "shard", "slot"))
    content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])) if content is None else content
    digested = docs.withColumn(digest, F.md5(F.coalesce(content, F.lit("")).cast("binary")))
    n, most = digested.groupBy(digest).agg(F.count("*").alias(copies)).agg(F.coalesce(F.sum(copies), F.lit(0)), F.coalesce(F.max(copies), F.lit(0))).first()
    runs = digested.groupBy(*[F.col(f"`{c}`") for c in names], digest).agg(F.count("*").alias(copies))
    hex_digits = min(7, max(1, math.ceil(math.log(max(n / ROWS_PER_BUCKET, 1), 16))))
    runs = runs.withColumn(bucket, F.substring(digest, 1, hex_digits))
    totals = runs.groupBy(bucket).agg(F.sum(copies).alias(base))
    before = W.orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)  # one row a bucket, n / ROWS_PER_BUCKET in all
    totals = totals.select(bucket, F.coalesce(F.sum(base).over(before), F.lit(0)).alias(base))
    inside = W.partitionBy(bucket).orderBy(digest, *[F.col(f"`{c}`").cast("string") for c in names])
    runs = runs.withColumn(offset, F.coalesce(F.sum(copies).over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    runs = runs.join(totals, bucket).withColumn(base, F.col(base) + F.col(offset))
    spread = runs.withColumn(chunk, F.explode(F.sequence(F.lit(0), F.floor((F.col(copies) - 1) / COPIES_PER_CHUNK))))
    if most > COPIES_PER_CHUNK:
        spread = spread.repartition(digest, chunk)
    start, end = F.col(chunk) * COPIES_PER_CHUNK, F.least((F.col(chunk) + 1) * COPIES_PER_CHUNK, F.col(copies))
    numbered = spread.withColumn(number, F.explode(F.sequence(F.col(base) + start, F.col(base) + end - 1)))
    permuted = numbered.withColumn(slot, permute(F.col(number), n, seed))
    return permuted.select(
        *[F.col(f"`{c}`") for c in names], number,
        F.pmod(F.col(slot), F.lit(n_shards)).cast("int").alias(shard_col),
        F.floor(F.col(slot) / n_shards).cast("long").alias(slot),
    )
