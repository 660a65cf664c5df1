"""Operator 8, removal of repeated byte strings, with deep-shallow suffix sorting.

Every string of LENGTH bytes (a window) holds a minimizer, its leftmost least hash of GRAM bytes. Equal windows have
equal minimizers at equal places, so windows are dealt out by the minimizer's hash, a run of neighbouring windows with
one minimizer as one row: its hash, the hash of the run's bytes, and its place. This gives each window a place to meet
all its equals at about one row for forty bytes of text.

* Runs of equal bytes: all but the earliest lie on an earlier copy entirely. Within an Arrow batch this is settled before
  anything is shuffled, so a passage held by a third of all documents sends few rows to its partition.
* Different runs with one minimizer (the edges of a repeat): the earliest of each bring their bytes, in chunks of at
  most CHUNK runs, and their windows are suffix-sorted: multikey quicksort on 8-byte symbols to a shallow depth, then
  blind tries for the groups that still agree. Windows equal in all bytes form a class; all but its earliest are repeats.
* A minimizer with more runs than a chunk holds: the earliest window of each class of each chunk is compared across the
  chunks by a digest of its bytes.

The removed bytes of a document are the union of its repeated windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._util import fresh, materialize
from ._words import _BYTE_VALUE, _powers, buffers, mix

LENGTH, GRAM = 100, 20
SHALLOW = 32
CHUNK = 2048
PIECE = 1 << 20
_POS_BITS = np.uint64(22)
_POS_MASK = np.uint64((1 << 22) - 1)
TAG_BITS = 22  # of a place: tag (22 bits) | start (33 bits) | windows (8 bits)
_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        size = 2 * PIECE + 2 * LENGTH
        _TABLES["up"], _TABLES["down"] = _powers(0x9E3779B97F4A7C15, size), _powers(pow(0x9E3779B97F4A7C15, -1, 2**64), size)
    return _TABLES["up"], _TABLES["down"]


def pack_place(tag, start, windows):
    return (tag << 41) | (start << 8) | windows


def runs_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start in row, windows, minimizer hash, hash of the run's bytes) for rows data[bounds[i]:bounds[i+1]].

    The rows together take at most 2 * PIECE bytes.
    """
    up, down = _tables()
    n, width = len(data), LENGTH - GRAM + 1
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[:n], out=sums[1:])
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    least = (grams & ~_POS_MASK) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    tail = width - span
    least = np.minimum(least[: len(least) - tail], least[tail:])  # one for each window start 0..n-LENGTH
    row = np.searchsorted(bounds, np.arange(len(least)), side="right") - 1
    valid = np.arange(len(least)) + LENGTH <= bounds[row + 1]
    at = np.flatnonzero(valid)
    if not len(at):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    place = (least[at] & _POS_MASK).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[at[1:]] != row[at[:-1]])
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(at)))
    start, anchor = at[first], place[first]
    end = start + windows + LENGTH - 1
    content = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return row[start], start - bounds[row[start]], windows, grams[anchor], content


def _pieces(offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, begin, end) byte ranges of about PIECE bytes in all; longer texts are cut with an overlap of LENGTH - 1."""
    rows, begins, ends, size = [], [], [], 0
    for r in range(len(offsets) - 1):
        at, stop = int(offsets[r]), int(offsets[r + 1])
        while stop - at >= LENGTH:
            end = min(stop, at + PIECE)
            rows.append(r)
            begins.append(at)
            ends.append(end)
            size += end - at
            if size >= PIECE:
                yield np.array(rows), np.array(begins), np.array(ends)
                rows, begins, ends, size = [], [], [], 0
            if end == stop:
                break
            at = end - (LENGTH - 1)
    if rows:
        yield np.array(rows), np.array(begins), np.array(ends)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (route, settled, content, did, place): settled rows repeat an earlier run of this batch."""
    for batch in batches:
        data, offsets = buffers(batch.column(2))
        did, tag = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        parts = []
        for rows, begins, ends in _pieces(offsets):
            joined = np.concatenate([data[b:e] for b, e in zip(begins, ends, strict=True)])
            bounds = np.concatenate([[0], np.cumsum(ends - begins)])
            row, start, windows, h, c = runs_of(joined, bounds)
            start = start + (begins - offsets[rows])[row]
            parts.append((rows[row], start, windows, h, c))
        if not parts:
            continue
        row, start, windows, h, c = (np.concatenate(x) for x in zip(*parts, strict=True))
        place = pack_place(tag[row], start, windows)
        owner = did[row]
        h, c = h.view(np.int64), c.view(np.int64)
        order = np.lexsort((place, owner, c, h))
        h, c, owner, place = h[order], c[order], owner[order], place[order]
        settled = np.zeros(len(h), bool)
        settled[1:] = (h[1:] == h[:-1]) & (c[1:] == c[:-1]) & ((owner[1:] != owner[:-1]) | (place[1:] != place[:-1]))
        route = np.where(settled, mix(order.astype(np.uint64) + np.uint64(len(h))).view(np.int64), h)
        for first in range(0, len(h), 100_000):
            cut = slice(first, first + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(x[cut]) for x in (route, settled, c, owner, place)], ["route", "settled", "content", "did", "place"])


_ANCHORS = "route bigint, settled boolean, content bigint, did bigint, place bigint"
_MET = "edge boolean, h bigint, chunk int, did bigint, place bigint"


def _meet(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (settled, route, content, did, place): repeats, and the earliest run of each content at edges."""

    def out(edge, h, chunk, did, place):
        return pa.RecordBatch.from_arrays([pa.array(edge, pa.bool_()), pa.array(h, pa.int64()), pa.array(chunk, pa.int32()), pa.array(did, pa.int64()), pa.array(place, pa.int64())], ["edge", "h", "chunk", "did", "place"])

    last_h = last_c = lead = waiting = None  # lead: earliest place of the content; waiting: a first run without company
    seen = 0
    for batch in batches:
        settled = batch.column(1).to_numpy(zero_copy_only=False)
        h, c, did, place = (batch.column(k).to_numpy() for k in (0, 2, 3, 4))
        if settled.any():
            k = np.flatnonzero(settled)
            yield out(np.zeros(len(k), bool), h[k], np.zeros(len(k), np.int32), did[k], place[k])
            k = np.flatnonzero(~settled)
            h, c, did, place = h[k], c[k], did[k], place[k]
        if not len(h):
            continue
        new_h = np.ones(len(h), bool)
        new_h[1:] = h[1:] != h[:-1]
        new_c = new_h.copy()
        new_c[1:] |= c[1:] != c[:-1]
        continued = last_h is not None and h[0] == last_h
        if continued:
            new_h[0] = False
            new_c[0] = c[0] != last_c
        firsts = np.flatnonzero(new_c)
        # of equal runs, rows of the very same place (a repeated input row) are no repeats of each other
        lead_of = np.cumsum(new_c) - 1
        lead_did = np.where(lead_of >= 0, did[firsts[np.maximum(lead_of, 0)]] if len(firsts) else 0, lead[0] if lead else 0)
        lead_place = np.where(lead_of >= 0, place[firsts[np.maximum(lead_of, 0)]] if len(firsts) else 0, lead[1] if lead else 0)
        again = np.flatnonzero(~new_c & ((did != lead_did) | (place != lead_place)))
        if len(again):
            yield out(np.zeros(len(again), bool), h[again], np.zeros(len(again), np.int32), did[again], place[again])
        run = np.cumsum(new_h)  # 0: the run continued from the batch before
        run_f = run[firsts]
        before = seen if continued else 0
        counts = np.bincount(run_f, minlength=run[-1] + 1)
        counts[0] += before
        begin = np.searchsorted(run_f, np.arange(run[-1] + 1))
        ordinal = np.arange(len(firsts)) - begin[run_f] + np.where(run_f == 0, before, 0)
        edge = counts[run_f] > 1
        if waiting is not None and continued and counts[0] > 1:
            yield out([True], [waiting[0]], [0], [waiting[1]], [waiting[2]])
            waiting = None
        if not continued or run[-1] > 0:
            waiting = None
        if edge.any():
            k = firsts[edge]
            yield out(np.ones(len(k), bool), h[k], (ordinal[edge] // chunk).astype(np.int32), did[k], place[k])
        if len(firsts) and counts[run[-1]] == 1 and run_f[-1] == run[-1]:
            k = firsts[-1]
            waiting = (h[k], did[k], place[k])
        seen = int(counts[run[-1]])
        last_h, last_c, lead = h[-1], c[-1], (lead_did[-1], lead_place[-1])


class _Branch:
    __slots__ = ("at", "kids")

    def __init__(self, at: int, kids: dict):
        self.at, self.kids = at, kids


def blind_trie(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """(class of each string, classes in lexicographic order) of strings of one length.

    Branches test single positions; a string found at the end of a blind descent is compared with once.
    """
    classes, leaves, root = [], [], None
    for s in strings:
        if root is None:
            root = 0
            leaves.append(s)
            classes.append(0)
            continue
        node = root
        while type(node) is _Branch:
            node = node.kids.get(s[node.at], node.kids[next(iter(node.kids))])
        other = leaves[node]
        if other == s:
            classes.append(node)
            continue
        differ = int.from_bytes(s, "big") ^ int.from_bytes(other, "big")
        at = len(s) - (differ.bit_length() + 7) // 8
        mine = len(leaves)
        leaves.append(s)
        classes.append(mine)
        parent, node = None, root
        while type(node) is _Branch and node.at < at:
            parent, node = node, node.kids[s[node.at]]
        if type(node) is _Branch and node.at == at:
            node.kids[s[at]] = mine
            continue
        branch = _Branch(at, {other[at]: node, s[at]: mine})
        if parent is None:
            root = branch
        else:
            parent.kids[s[parent.at]] = branch
    order, work = [], [root] if root is not None else []
    while work:
        node = work.pop()
        if type(node) is _Branch:
            work += [node.kids[b] for b in sorted(node.kids, reverse=True)]
        else:
            order.append(node)
    return classes, order


def multikey_quicksort(buffer: bytes, starts: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, first place of each segment): the strings at ``starts`` by group, then by their first ``depth`` bytes.

    A segment is split three ways by one symbol of 8 bytes of its pivot, the median of three: what is less, what is equal and goes on
    with the next symbol, and what is greater. All segments that are not done are split in one pass.
    """
    data = np.frombuffer(buffer + bytes(8), np.uint8)
    symbols = np.lib.stride_tricks.sliding_window_view(data, 8)
    order = np.argsort(group, kind="stable")
    begin = np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1])) if len(order) else np.zeros(0, np.int64)
    size, at = np.diff(np.append(begin, len(order))), np.zeros(len(begin), np.int64)
    done = []
    while len(begin):
        settled = (size == 1) | (at >= depth)
        done.append(begin[settled])
        begin, size, at = begin[~settled], size[~settled], at[~settled]
        if not len(begin):
            break
        head = np.cumsum(size) - size  # of each segment among the rows at hand
        mine = np.repeat(np.arange(len(begin)), size)
        rows = np.arange(len(mine)) + np.repeat(begin - head, size)
        held = order[rows]
        key = np.ascontiguousarray(symbols[starts[held] + at[mine]]).view(">u8").ravel().astype(np.uint64)
        three = np.sort(np.stack([key[head], key[head + size // 2], key[head + size - 1]]), axis=0)
        side = (key >= three[1][mine]).astype(np.int64) + (key > three[1][mine])
        counts = np.bincount(mine * 3 + side, minlength=3 * len(begin)).reshape(-1, 3)
        to = np.cumsum(counts, axis=1) - counts + head[:, None]
        place = np.empty(len(mine), np.int64)
        for k in range(3):
            which = np.flatnonzero(side == k)
            own = mine[which]
            before = np.cumsum(counts[:, k]) - counts[:, k]
            place[which] = to[own, k] + np.arange(len(which)) - before[own]
        moved = np.empty(len(held), held.dtype)
        moved[place] = held
        order[rows] = moved
        full = counts > 0
        begin, at = (to + (begin - head)[:, None])[full], (at[:, None] + np.array([0, 8, 0]))[full]
        size = counts[full]
    return order, np.sort(np.concatenate(done)) if done else np.zeros(0, np.int64)


def deep_shallow(buffer: bytes, starts: np.ndarray, group: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(order, class) of the windows buffer[s:s+length]: order sorts by (group, bytes); equal windows share a class.

    Windows of different groups are never compared. Shallow: multikey quicksort to the depth of SHALLOW bytes; deep: a blind
    trie for each set that agrees in them.
    """
    order, begin = multikey_quicksort(buffer, starts, group, min(SHALLOW, length - length % 8))
    classes = np.zeros(len(starts), np.int64)
    used = 0
    for lo, hi in zip(begin.tolist(), [*begin[1:].tolist(), len(order)], strict=True) if len(begin) else ():
        if hi - lo == 1:
            classes[order[lo]] = used
            used += 1
            continue
        members = order[lo:hi]
        own, sequence = blind_trie([buffer[s : s + length] for s in starts[members].tolist()])
        rank = np.empty(len(sequence), np.int64)
        rank[sequence] = np.arange(len(sequence))
        mine = rank[own]
        classes[members] = used + mine
        order[lo:hi] = members[np.argsort(mine, kind="stable")]
        used += len(sequence)
    return order, classes


_SORTED = "h bigint, d1 bigint, d2 bigint, did bigint, place bigint"


def _sort_edges(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Over rows (h, chunk, many, did, place, bytes) sorted by (h, chunk): repeated windows (d1 null), and for
    minimizers of many chunks the earliest window of each class with its digest."""
    held: list[tuple] = []

    def settle(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        buffer = b"".join(r[5] for r in rows)
        begin = np.concatenate([[0], np.cumsum([len(r[5]) for r in rows])])
        windows = np.array([r[4] & 0xFF for r in rows])
        owner = np.repeat(np.arange(len(rows)), windows)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        starts = begin[owner] + within
        keys = [(r[0], r[1]) for r in rows]
        change = np.array([0, *(a != b for a, b in zip(keys[1:], keys[:-1], strict=True))])
        _, classes = deep_shallow(buffer, starts, np.cumsum(change)[owner])
        did = np.array([r[3] for r in rows], np.int64)[owner]
        base = np.array([r[4] & ~0xFF for r in rows], np.int64)[owner]
        at = base + (within << 8) + 1
        rank = np.lexsort((at, did, classes))
        first = np.ones(len(rank), bool)
        first[1:] = classes[rank[1:]] != classes[rank[:-1]]
        leader = rank[np.flatnonzero(first)][np.cumsum(first) - 1]
        repeat = rank[(did[rank] != did[leader]) | (at[rank] != at[leader])]
        repeat.sort()
        if len(repeat):  # neighbouring windows of a run as one row
            new = np.ones(len(repeat), bool)
            new[1:] = (repeat[1:] != repeat[:-1] + 1) | (owner[repeat[1:]] != owner[repeat[:-1]])
            k = np.flatnonzero(new)
            size = np.diff(np.append(k, len(repeat)))
            nulls = pa.nulls(len(k), pa.int64())
            yield pa.RecordBatch.from_arrays([nulls, nulls, nulls, pa.array(did[repeat[k]]), pa.array(at[repeat[k]] - 1 + size)], ["h", "d1", "d2", "did", "place"])
        many = np.array([r[2] for r in rows], bool)[owner]
        alone = rank[first & many[rank]]
        if len(alone):
            digests = [hashlib.blake2b(buffer[s : s + LENGTH], digest_size=16).digest() for s in starts[alone].tolist()]
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            h = np.array([r[0] for r in rows], np.int64)[owner]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h[alone], np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1]), did[alone], at[alone])], ["h", "d1", "d2", "did", "place"])

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns, strict=True):
            if len(held) >= chunk and (row[0], row[1]) != (held[-1][0], held[-1][1]):
                yield from settle(held)
                held = []
            held.append(row)
    if held:
        yield from settle(held)


def _cut_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        out: list[list] = [[], [], [], [], [], []]
        for r, (did, edges) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
            text = data[offsets[r] : offsets[r + 1]].tobytes()
            for e in edges:
                start, windows = (e["place"] >> 8) & ((1 << 33) - 1), e["place"] & 0xFF
                for column, value in zip(out, (e["h"], e["chunk"], e["many"], did, e["place"], text[start : start + windows + LENGTH - 1]), strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["h", "chunk", "many", "did", "place", "bytes"])


def merged(places: list[int]) -> list[tuple[int, int]]:
    """Maximal removed byte runs from packed places of repeated windows."""
    out: list[tuple[int, int]] = []
    for place in sorted(places, key=lambda p: (p >> 8) & ((1 << 33) - 1)):
        start = (place >> 8) & ((1 << 33) - 1)
        end = start + (place & 0xFF) + LENGTH - 1
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _apply(key_count: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(key_count))
            size, gone, spans, kept = [], [], [], []
            for r, places in enumerate(batch.column(key_count + 1).to_pylist()):
                text = data[offsets[r] : offsets[r + 1]].tobytes()
                cuts = merged(places or [])
                at, parts = 0, []
                for s, e in cuts:
                    parts.append(text[at:s])
                    at = e
                parts.append(text[at:])
                size.append(len(text))
                gone.append(sum(e - s for s, e in cuts))
                spans.append([{"start": s, "end": e} for s, e in cuts])
                kept.append(b"".join(parts))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:key_count], *columns], names)

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per document: key, n_bytes, n_removed, spans (byte runs removed), kept (the bytes left).

    A byte goes if a string of LENGTH bytes that covers it also starts earlier: in a document of smaller key (null
    before all others), or earlier in the same document. Texts are UTF-8 bytes, a null text is empty, and matches never
    cross documents. Rows that share a key but not the text are ordered by a hash of the text; rows equal in
    both are one document, and each of them gets that document's result. Ties within a document go to the earlier start. An
    empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    did = F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63)))
    body = F.coalesce(F.col(text), F.lit(""))
    tag = F.xxhash64(body).bitwiseAND((1 << TAG_BITS) - 1)
    source = docs.select(did.alias("did"), tag.alias("tag"), body.alias("text"))
    anchors = source.filter(F.octet_length("text") >= LENGTH).mapInArrow(_anchors, _ANCHORS)
    shuffled = anchors.repartition("route").sortWithinPartitions("settled", "route", "content", "did", "place")
    met = materialize(shuffled.mapInArrow(partial(_meet, chunk=chunk), _MET), "repeat-runs")
    tag_of = F.shiftright("place", 41)
    edges = met.filter("edge").withColumn("tag", tag_of)
    crowded = edges.filter("chunk = 1").select("h").distinct().withColumn("many", F.lit(True))
    edges = edges.join(crowded, "h", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    per_doc = edges.groupBy("did", "tag").agg(F.collect_list(F.struct("h", "chunk", "many", "place")).alias("edges"))
    cuts = source.join(per_doc, ["did", "tag"]).select("did", "text", "edges").mapInArrow(_cut_edges, "h bigint, chunk int, many boolean, did bigint, place bigint, bytes binary")
    windows = materialize(cuts.repartition("h", "chunk").sortWithinPartitions("h", "chunk").mapInArrow(partial(_sort_edges, chunk=chunk), _SORTED), "repeat-windows")
    same = W.partitionBy("h", "d1", "d2").orderBy("did", "place")  # at most one row a chunk
    first = F.first(F.struct("did", "place")).over(same)
    across = windows.filter("d1 is not null").withColumn("lead", first).filter((F.col("did") != F.col("lead.did")) | (F.col("place") != F.col("lead.place")))
    repeats = met.filter("not edge").select("did", "place").unionByName(windows.filter("d1 is null").select("did", "place")).unionByName(across.select("did", "place"))
    places = repeats.groupBy("did", tag_of.alias("tag")).agg(F.collect_set("place").alias("places"))
    out_key = fresh(docs, "_key")
    every = docs.select(F.col(key).alias(out_key), did.alias("did"), tag.alias("tag"), body.alias("text"))
    joined = every.join(places, ["did", "tag"], "left").select(out_key, "text", "places")
    kind = docs.schema[key].dataType.simpleString()
    shape = f"`{key}` {kind}, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    return joined.mapInArrow(_apply(1, [key, "n_bytes", "n_removed", "spans", "kept"]), shape)
