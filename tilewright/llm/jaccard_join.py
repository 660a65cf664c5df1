"""Operator 5, n-gram Jaccard join with signature trees.

A document is the set of its distinct five-word shingles (64-bit hashes). Two sets link when their Jaccard similarity
is at least t = NUM/DEN. The join is exact on those hashes:

1. Equal sets are one node, named by a hash of the set.
2. The first REACH of each set's n shingles, or (1 - t) * n + 1 if that is more, are dealt out by shingle. Shingles are taken in hash order, those marked as
   frequent last; the marks are a bitmap of fixed size, made from the most frequent shingles of a sample, and only change the
   order, never the result.
   Of two linked sets, let a be the one whose dealt shingles end first. They share t * n of a's shingles or more, and all
   but (1 - REACH) * n of those are dealt out by both sides. So a set with fewer than (REACH - 1 + t) * n
   dealt shingles in company has no link, and is dropped; few sets but near duplicates stay.
3. Each set left points at the least set of most of its dealt shingles; sets so joined are a family. The sets of a family go to
   one task, which grows a signature tree of them (``signature_tree``): its nodes hold the OR of their sets' bitmaps and the
   range of their sizes, and a dual traversal drops node pairs whose largest possible overlap is too small. The sets
   of the pairs left are compared in the same task. What comes out is one row for each set that links join to a lesser
   one, so a group of any density gives fewer rows than it has sets.
4. Linked sets of different families share at least (REACH - 1 + t) * n dealt shingles that sets of another family
   hold, and one of the first (1 - t) * n + 1. The sets that have so many meet again, by shingle; one shingle
   stands for all with the same sets. Their trees are traversed as before.
5. Components of the links found become components of documents.

A family or shingle of more than BLOCK sets, or WEIGHT shingles in all, is split into blocks. Of its sets those of its main
component are in their block only, as hosts; all others visit every block, too. Two sets of one block, or a
host and a visitor, are compared in one task; two sets of the main component need not be.

``links`` returns every link: labels are not joined there, so all sets are visitors and each pair of sets is compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import lean
from ._marks import MARK_BITS, bitmap, marked
from ._util import drop_table, fresh, materialize, whole_groups
from ._words import SPACED, buffers, chunks, grams, mix, word_hashes
from .components import components
from .signature_tree import Block

SHINGLE = 5
NUM, DEN = 75, 100
REACH = (2, 5)
SAMPLE, SAMPLE_HITS = 16, 4
BROADCAST_ROWS = 100_000
BROADCAST_PLACES = 4 * BROADCAST_ROWS  # places of those rows' sets, 50 bytes each
MOST_MARKS = 1 << MARK_BITS - 3
BLOCK, WEIGHT = 4096, 1 << 21


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than a shingle are one shingle as a whole."""
    return np.unique(grams(words, min(SHINGLE, len(words)))) if len(words) else np.zeros(0, np.uint64)


def set_id(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def sets_of(column: pa.Array) -> Iterator[np.ndarray]:
    data, offsets = buffers(column)
    for first, last in chunks(offsets):
        hashes, at = word_hashes(data, offsets[first : last + 1], SPACED)
        for row in range(last - first):
            yield shingle_set(hashes[at[row] : at[row + 1]])


def in_order(shingles: np.ndarray, hot: np.ndarray | None) -> np.ndarray:
    """The set in the order all sets are dealt out in."""
    if hot is None:
        return shingles
    often = marked(hot, shingles)
    return np.concatenate([shingles[~often], shingles[often]])


def core(n: int, num: int, den: int) -> int:
    """Of how many first shingles two linked sets share one."""
    return n - -(-n * num // den) + 1


def reach(n: int, num: int, den: int) -> int:
    """How many of n shingles are dealt out: REACH of them, and the core at least, which is more at low thresholds."""
    return max(min(n, -(-n * REACH[0] // REACH[1]) + 1), core(n, num, den))


def similar(shared: int, a: int, b: int, num: int, den: int) -> bool:
    return shared * den >= num * (a + b - shared)


def _frequent(source: DataFrame, num: int, den: int) -> DataFrame:
    """(token) of the shingles that one text in SAMPLE deals out most: SAMPLE_HITS times or more, or as often as leaves MOST_MARKS of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [s[: reach(len(s), num, den)] for s in sets_of(batch.column(0)) if len(s)]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts).view(np.int64))], ["token"])

    sample = source.filter(F.pmod("text_hash", F.lit(SAMPLE)) == 0).select("text")
    found = sample.mapInArrow(lean(run), "token bigint").groupBy("token").agg(F.count("*").alias("hits")).filter(F.col("hits") >= SAMPLE_HITS)
    found = materialize(found, "frequent-shingles")
    sizes = found.groupBy(F.floor(F.log2("hits")).alias("power")).agg(F.count("*").alias("n")).collect()  # 64 rows at most
    least, held = SAMPLE_HITS, sum(r.n for r in sizes)
    for power, n in sorted(map(tuple, sizes)):
        if held > MOST_MARKS:
            least, held = 2 << power, held - n
    return found.filter(F.col("hits") >= least)


_ROWS = "member boolean, token bigint, sid bigint, n bigint, first boolean, did bigint, text_hash bigint"
_NAMES = ["member", "token", "sid", "n", "first", "did", "text_hash"]


def _deal(hot, num: int, den: int):
    """One row per document, and one per dealt shingle of its set, ``first`` where it is of the core."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt: set[int] = set()
        for batch in batches:
            sids, sizes, tokens, owners, counts, firsts, held = [], [], [], [], [], [], 0
            for shingles in sets_of(batch.column(2)):
                n = len(shingles)
                sid = set_id(shingles) if n else None
                sids.append(sid)
                sizes.append(n)
                if n and sid not in dealt:
                    dealt.add(sid)
                    part = in_order(shingles, hot.value)[: reach(n, num, den)]
                    tokens.append(part)
                    owners.append(np.full(len(part), sid, np.int64))
                    counts.append(np.full(len(part), n, np.int64))
                    firsts.append(np.arange(len(part)) < core(n, num, den))
                    held += len(part)
                    if held > 100_000:
                        yield _dealt_rows(np.concatenate(tokens).view(np.int64), *map(np.concatenate, (owners, counts, firsts)))
                        tokens, owners, counts, firsts, held = [], [], [], [], 0
            if len(dealt) > 200_000:
                dealt.clear()
            k = batch.num_rows
            route = mix(np.arange(k, dtype=np.uint64) + np.uint64(0x5851F42D)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(k, bool)), pa.array(route), pa.array(sids, pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(k, pa.bool_()), batch.column(0), batch.column(1)], _NAMES)
            if tokens:
                yield _dealt_rows(np.concatenate(tokens).view(np.int64), *map(np.concatenate, (owners, counts, firsts)))

    return run


def _dealt_rows(token, sid, n, first) -> pa.RecordBatch:
    nulls = pa.nulls(len(token), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(token), bool)), *map(pa.array, (token, sid, n, first)), nulls, nulls], _NAMES)


_SHARED = _ROWS + ", lead bigint, lead_n bigint"


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (member, token, sid): the members, and the shingles dealt out by two sets or more, each with its least set."""
    last = lead = None  # the last row of the batch before, and whether it is out; the least set of its shingle
    for batch in batches:
        member = batch.column(0).to_numpy(zero_copy_only=False)
        if member.any():
            people = batch.filter(pa.array(member))
            none = pa.nulls(people.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*people.columns, none, none], [*_NAMES, "lead", "lead_n"])
            batch = batch.filter(pa.array(~member))
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3, 4)]
        if last is not None:
            columns = [np.append(np.array([x], c.dtype), c) for x, c in zip(last[0], columns, strict=True)]
        token, sid = columns[:2]
        once = np.ones(len(token), bool)
        once[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
        columns = [c[once] for c in columns]
        token, sid, n, _ = columns
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        run, begin = np.cumsum(new) - 1, np.flatnonzero(new)
        leads = [sid[begin], n[begin]]
        if lead is not None:
            leads[0][0], leads[1][0] = lead
        shared = np.bincount(run)[run] > 1
        out = shared.copy()
        if last is not None and last[1]:  # its run is known to be shared, and it is out
            out[run == 0] = shared[run == 0] = True
            out[0] = False
        k = np.flatnonzero(out)
        if len(k):
            rows = _dealt_rows(*[c[k] for c in columns])
            yield pa.RecordBatch.from_arrays([*rows.columns, *[pa.array(x[run[k]]) for x in leads]], [*_NAMES, "lead", "lead_n"])
        last, lead = ([c[-1] for c in columns], bool(shared[-1])), (leads[0][-1], leads[1][-1])


_COMPANY = "sid bigint, n bigint, leader bigint, tokens array<bigint>, firsts array<boolean>"


def _enough(count, n, num: int, den: int):
    """Whether ``count`` shared dealt shingles of n may be a link's."""
    return count * (REACH[1] * den) >= n * ((REACH[0] - REACH[1]) * den + REACH[1] * num)


def _accompany(num: int, den: int):
    """Over rows (sid, lead, token, n, first, lead_n) sorted by (sid, lead): one row for each set with enough company."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 1):
            sid, lead, token, n, first, lead_n = (c.to_numpy(zero_copy_only=False) for c in rows.columns)
            begin = np.flatnonzero(np.append(True, sid[1:] != sid[:-1]))
            count = np.diff(np.append(begin, len(sid)))
            good = _enough(count, n[begin], num, den)
            keep = np.repeat(good, count)
            if not keep.any():
                continue
            sid, lead, token, n, first, lead_n = (c[keep] for c in (sid, lead, token, n, first, lead_n))
            begin = np.flatnonzero(np.append(True, sid[1:] != sid[:-1]))
            count = np.diff(np.append(begin, len(sid)))
            vote = np.flatnonzero(np.append(True, (sid[1:] != sid[:-1]) | (lead[1:] != lead[:-1])))
            votes = np.diff(np.append(vote, len(sid)))
            fits = (n[vote] * den >= lead_n[vote] * num) & (lead_n[vote] * den >= n[vote] * num) & (sid[vote] != lead[vote])
            votes = np.where(fits & _enough(votes, n[vote], num, den), votes, 0)
            owner = np.searchsorted(begin, vote, side="right") - 1
            best = np.lexsort((-lead[vote], votes, owner))  # the last of each owner: most votes, then the least leader
            best = best[np.append(owner[best][1:] != owner[best][:-1], True)]
            leader = pa.array(lead[vote[best]], mask=votes[best] == 0)
            offsets = pa.array(np.append(begin, len(sid)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(c)) for c in (token, first)]
            yield pa.RecordBatch.from_arrays([pa.array(sid[begin]), pa.array(n[begin]), leader, *lists], ["sid", "n", "leader", "tokens", "firsts"])

    return run


def _strong(num: int, den: int):
    """Over rows (sid, token, first, n, fam, label) sorted by sid: core rows of the sets with enough of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 1):
            sid, n, first = (rows.column(k).to_numpy(zero_copy_only=False) for k in (0, 3, 2))
            begin = np.flatnonzero(np.append(True, sid[1:] != sid[:-1]))
            count = np.diff(np.append(begin, len(sid)))
            keep = np.repeat(_enough(count, n[begin], num, den), count) & first
            if keep.any():
                yield rows.filter(pa.array(keep))

    return run


def _as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sid, shingles) of rows (mark, text)."""
    for batch in batches:
        for first in range(0, batch.num_rows, 1000):
            sets = [s for s in sets_of(batch.column(1).slice(first, 1000)) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([set_id(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["sid", "shingles"])


def _likely(rows: DataFrame, at: int, wanted: DataFrame, column: str, shape: str) -> DataFrame:
    """Rows whose value (in the column of that number) may be among ``wanted`` (stored), for an exact join to be made of them.

    A bitmap of fixed size tells. It would be too full to do so beyond MOST_MARKS values; then all rows go to the join.
    """
    if wanted.count() > MOST_MARKS:
        return rows
    marks = rows.sparkSession.sparkContext.broadcast(bitmap(wanted, column))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(marked(marks.value, batch.column(at).to_numpy().view(np.uint64))))

    return rows.mapInArrow(lean(run), shape)


def _small(rows: DataFrame) -> DataFrame:
    """Stored rows of a few numbers, broadcast if a count shows that they are few; more are joined by shuffle."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def _compare(num: int, den: int, every: bool):
    """Over rows (grp, i, j, visitor, sid, label, apart, shingles) sorted by the first four, with ``every`` links (a, b) of sets.

    Else the labels that a task's links join to others, each with the least of those: (label, least label).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 3):
            keys = [c.to_numpy() for c in rows.columns[:3]]
            new = np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in keys]))
            bounds = np.append(np.flatnonzero(new), rows.num_rows)
            visitor = rows.column(3).to_numpy(zero_copy_only=False)
            sid, label, apart = (rows.column(k).to_numpy() for k in (4, 5, 6))
            a, b = [], []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                hosts = int((~visitor[lo:hi]).sum())
                if hosts == 0 or hi - lo == 1 or (hosts == hi - lo) != (keys[1][lo] < 0):
                    continue
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column(7).slice(lo, hi - lo)]
                mine = (sid if every else label)[lo:hi]
                found = list(Block(sets, hosts).links(num, den, None if every else label[lo:hi], apart[lo:hi]))
                if found:
                    x, y = (mine[np.concatenate(ends)] for ends in zip(*found, strict=True))
                    x, y = (np.minimum(x, y), np.maximum(x, y)) if every else stars(x, y)
                    a.append(x)
                    b.append(y)
            if a:
                a, b = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"]).filter(pa.array(a != b))

    return run


def stars(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ends of links that join something each, with the least end reached, itself left out."""
    root: dict[int, int] = {}

    def find(k: int) -> int:
        while (up := root.setdefault(k, k)) != k:
            root[k] = k = root[up]
        return k

    for a, b in zip(x.tolist(), y.tolist(), strict=True):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    ends = [k for k in root if find(k) != k]
    return np.array(ends, np.int64), np.array([find(k) for k in ends], np.int64)


_PLACED = ["grp", "i", "j", "visitor", "sid", "label", "apart"]


def _links(placed: DataFrame, sets: DataFrame, num: int, den: int, every: bool) -> DataFrame:
    """Links (a, b) of the sets that ``placed`` (stored) sends to the same task.

    A set is joined with the list of its places, so that it is copied only as it is dealt out, and never shuffled twice for each.
    """
    places = placed.groupBy("sid").agg(F.collect_list(F.struct(*[c for c in _PLACED if c != "sid"])).alias("places"))
    if placed.limit(BROADCAST_PLACES + 1).count() <= BROADCAST_PLACES:
        places = _small(materialize(places, "places"))
    rows = _likely(sets, 0, placed, "sid", "sid bigint, shingles binary").join(places, "sid").select("sid", "shingles", F.explode("places").alias("at"))
    rows = rows.select(*[F.col("sid") if c == "sid" else F.col(f"at.{c}") for c in _PLACED], "shingles")
    dealt = rows.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "visitor")
    return dealt.mapInArrow(lean(_compare(num, den, every)), "a bigint, b bigint")


def _blocks(sets, weight, block: int):
    return F.greatest(F.lit(1), F.ceil(sets / block), F.ceil(weight / WEIGHT)).cast("int")


def _spread(rows: DataFrame, block: int, alone: bool) -> DataFrame:
    """Tasks of rows (grp, blocks, block, sid, n, label, apart): blocks by themselves if ``alone``, and with visitors.

    The members of a group's main label are hosts only, so rows grow with the blocks only for the others.
    """
    own = rows.filter("blocks = 1").select("grp", F.lit(-1).alias("i"), F.lit(0).alias("j"), F.lit(False).alias("visitor"), "sid", "label", "apart")
    wide = rows.filter("blocks > 1")
    by_label = wide.groupBy("grp", "label").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
    main = by_label.groupBy("grp").agg(F.max_by(F.struct("label", "m", "w"), F.struct("m", "label")).alias("main"), F.sum("m").alias("m"), F.sum("w").alias("w"))
    others = F.col("m") - F.col("main.m")
    shelves = F.when(others > 0, _blocks(others, F.col("w") - F.col("main.w"), block)).otherwise(0)
    wide = wide.join(main.select("grp", F.col("main.label").alias("main"), shelves.alias("shelves")), "grp")
    visited = F.when(F.col("shelves") > 0, F.sequence(F.lit(0), F.col("shelves") - 1)).otherwise(F.array().cast("array<int>"))
    tasks = F.concat(F.array(F.lit(-1)), visited) if alone else visited
    hosts = wide.select("grp", F.explode(tasks).alias("i"), F.col("block").alias("j"), F.lit(False).alias("visitor"), "sid", "label", "apart")
    shelf = F.pmod(F.xxhash64("sid", F.lit(1)), F.col("shelves")).cast("int")
    guests = wide.filter("label <> main").select("grp", shelf.alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(True).alias("visitor"), "sid", "label", "apart")
    return (own.unionByName(hosts) if alone else hosts).unionByName(guests)


def _in_families(company: DataFrame, sets: DataFrame, num: int, den: int, block: int, every: bool) -> tuple[DataFrame, DataFrame]:
    """(sid, fam) of the sets in families, and what links inside families give: all of them, or (a, b) with b the root of a."""
    families = components(company.filter("leader is not null"), "sid", "leader").select(F.col("node").alias("sid"), F.col("root").alias("fam"))
    named = company.select("sid", "n").join(_small(families), "sid", "left").withColumn("fam", F.coalesce("fam", "sid"))
    size = named.groupBy("fam").agg(F.count("*").alias("m"), F.sum("n").alias("w")).filter("m > 1")
    home = named.join(size.select("fam", _blocks(F.col("m"), F.col("w"), block).alias("blocks")), "fam")
    home = materialize(home.withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")), "families")
    # here sets are apart from themselves only
    placed = home.select(F.col("fam").alias("grp"), F.lit(-1).alias("i"), F.col("block").alias("j"), F.lit(False).alias("visitor"), "sid", F.col("sid").alias("label"), F.col("sid").alias("apart"))
    found = materialize(_links(placed, sets, num, den, every), "links-in-blocks")
    wide = home.filter("blocks > 1")
    if wide.limit(1).count():
        rows = wide.select(F.col("fam").alias("grp"), "blocks", "block", "sid", "n", F.col("sid").alias("apart"))
        rows = rows.withColumn("label", F.col("sid")) if every else _labelled(rows, found)
        placed = materialize(_spread(rows, block, False), "family-visits")
        both = found.unionByName(_links(placed, sets, num, den, every))
        joined = both if every else components(both, "a", "b").select(F.col("node").alias("a"), F.col("root").alias("b"))
        joined = materialize(joined, "links-in-families")
        for used in (placed, found):
            drop_table(used)
        found = joined
    return home.select("sid", "fam"), found


def _labelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with the label of sid: its root, or itself."""
    roots = roots.select(F.col("a").alias("sid"), F.col("b").alias("label"))
    return rows.join(_small(roots), "sid", "left").withColumn("label", F.coalesce("label", "sid"))


def _across(company: DataFrame, home: DataFrame, roots: DataFrame, sets: DataFrame, num: int, den: int, block: int, every: bool) -> DataFrame:
    """Links between sets of different families and of different components, (a, b) with b the root of a in ``roots``: all, or the labels they join."""
    where = _labelled(company.select("sid", "n", "tokens", "firsts").join(_small(home), "sid", "left").withColumn("fam", F.coalesce("fam", "sid")), roots)
    rows = where.select("sid", "n", "fam", "label", F.explode(F.arrays_zip("tokens", "firsts")).alias("dealt"))
    rows = rows.select("sid", F.col("dealt.tokens").alias("token"), F.col("dealt.firsts").alias("first"), "n", "fam", "label")
    mixed = rows.groupBy("token").agg(F.min("fam").alias("low"), F.max("fam").alias("high")).filter("low <> high").select("token")
    mixed = materialize(mixed, "mixed-tokens")
    shape = "sid bigint, token bigint, first boolean, n bigint, fam bigint, label bigint"
    core = _likely(rows.select("sid", "token", "first", "n", "fam", "label"), 1, mixed, "token", shape).join(_small(mixed), "token", "left_semi")
    core = core.select("sid", "token", "first", "n", "fam", "label").repartition("sid").sortWithinPartitions("sid")
    core = materialize(core.mapInArrow(lean(_strong(num, den)), shape), "mixed-shingles")
    drop_table(mixed)
    several = (F.min("fam") != F.max("fam")) & (F.min("label") != F.max("label"))
    fit = (F.count("*") > 2) | (F.min("n") * den >= F.max("n") * num)  # two sets alone link only if their sizes allow it
    same = [F.bit_xor(F.xxhash64("sid", F.lit(k))).alias(f"same{k}") for k in (0, 1)]
    groups = core.groupBy("token").agg((several & fit).alias("mixed"), F.count("*").alias("m"), F.sum("n").alias("w"), *same).filter("mixed")
    groups = groups.groupBy("same0", "same1", "m").agg(F.min("token").alias("token"), F.first("w").alias("w"))
    groups = groups.select("token", _blocks(F.col("m"), F.col("w"), block).alias("blocks"))
    rows = core.join(groups, "token").withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    rows = rows.select(F.col("token").alias("grp"), "blocks", "block", "sid", "n", "label", F.col("fam").alias("apart"))
    placed = materialize(_spread(rows, block, True), "meetings")
    drop_table(core)
    found = materialize(_links(placed, sets, num, den, every), "links-across")
    drop_table(placed)
    return found


def _dealt(docs: DataFrame, key: str, text: str, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Members (did, text_hash, sid, n), the sets in company, their shingles, and the table that members are read from."""
    if not 0 < num <= den:
        raise ValueError(f"the threshold {num}/{den} is not above 0 and at most 1")
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(F.col(key).cast("bigint").alias("did"), F.xxhash64(body).alias("text_hash"), body.alias("text"))
    hot = spark.sparkContext.broadcast(bitmap(_frequent(source, num, den), "token"))
    dealt = source.mapInArrow(lean(_deal(hot, num, den)), _ROWS)
    met = materialize(dealt.repartition("token").sortWithinPartitions("member", "token", "sid").mapInArrow(lean(_meet), _SHARED), "dealt-shingles")
    members, shared = met.filter("member").select("did", "text_hash", "sid", "n"), met.filter("not member").select("sid", "lead", "token", "n", "first", "lead_n")
    company = materialize(shared.repartition("sid").sortWithinPartitions("sid", "lead").mapInArrow(lean(_accompany(num, den)), _COMPANY), "sets-in-company")
    members = materialize(members, "set-members")
    drop_table(met)
    # one document of each set
    row_mark = F.xxhash64("did", "text_hash")
    chosen = members.groupBy("sid").agg(F.min(row_mark).alias("mark")).join(company.select("sid"), "sid", "left_semi").select("mark")
    chosen = materialize(chosen, "chosen-documents")
    texts = _likely(source.select(row_mark.alias("mark"), "text"), 0, chosen, "mark", "mark bigint, text string")
    texts = texts.join(_small(chosen), "mark", "left_semi").select("mark", "text")
    sets = materialize(texts.mapInArrow(lean(_as_sets), "sid bigint, shingles binary"), "shingle-sets")
    drop_table(chosen)
    hot.unpersist()
    return members, company, sets


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", num: int = NUM, den: int = DEN, block: int = BLOCK) -> DataFrame:
    """One row per document: key, n_shingles, component_id, and is_first (of each component one document).

    component_id is the least key reachable by links; null keys count as greatest, and a component of null keys has
    none. A null, empty or blank text has an empty set and is linked with nothing. Rows equal in key and text
    are one document, and is_first is true for each of them. An empty table gives an empty result. Other columns are
    ignored, whatever their names.
    """
    members, company, sets = _dealt(docs, key, text, num, den)
    home, near = _in_families(company, sets, num, den, block, False)
    far = _across(company, home, near, sets, num, den, block, False)
    joined = components(far, "a", "b").select(F.col("node").alias("label"), "root")
    named = _labelled(members, near).join(_small(joined), "label", "left").withColumn("component", F.coalesce("root", "label"))
    named = materialize(named.select("did", "text_hash", "n", "component"), "members")
    for used in (members, company, sets, home, near, far):
        drop_table(used)
    order = F.struct(F.col("did").isNull().alias("none"), F.col("did"), F.col("text_hash"))
    first = named.filter("component is not null").groupBy("component").agg(F.min(order).alias("first"))
    linked = named.filter("component is not null").join(first, "component").select(
        "did", "n", F.col("first.did").alias("component_id"), "text_hash", (F.col("did").eqNullSafe(F.col("first.did")) & (F.col("text_hash") == F.col("first.text_hash"))).alias("is_first")
    )
    alone = named.filter("component is null").select("did", "n", F.col("did").alias("component_id"), "text_hash", F.lit(True).alias("is_first"))
    kind = docs.schema[key].dataType
    return linked.unionByName(alone).select(F.col("did").cast(kind).alias(key), F.col("n").alias("n_shingles"), F.col("component_id").cast(kind).alias("component_id"), "is_first", "text_hash")


def links(docs: DataFrame, key: str = "doc_id", text: str = "text", num: int = NUM, den: int = DEN, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """All links: (key, n_shingles, set_id) of each row, and (a, b), a < b, once for each two distinct sets that link.

    Rows with equal set_id have equal sets and are linked by that; an empty set has set_id null and links with nothing.
    The links of a group grow with the square of its distinct sets; no pair is left out.
    """
    members, company, sets = _dealt(docs, key, text, num, den)
    home, near = _in_families(company, sets, num, den, block, True)
    none = company.filter("false").select(F.col("sid").alias("a"), F.col("sid").alias("b"))
    far = _across(company, home, none, sets, num, den, block, True)
    rows = members.select(F.col("did").cast(docs.schema[key].dataType).alias(key), F.col("n").alias("n_shingles"), F.col("sid").alias("set_id"))
    return rows, near.unionByName(far).distinct()


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs`` with one document of each component, the one of least key; of rows equal in key and text one stays."""
    found = classes(docs, key, text, num, den).filter("is_first")
    k, h = fresh(docs, "_nd_key"), fresh(docs, "_nd_hash")
    none = F.lit(-(1 << 63))
    first = found.select(F.coalesce(F.col(key).cast("bigint"), none).alias(k), F.col("text_hash").alias(h)).distinct()
    mine = docs.withColumn(k, F.coalesce(F.col(key).cast("bigint"), none)).withColumn(h, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    return mine.join(first, [k, h], "left_semi").dropDuplicates([k, h]).drop(k, h)
