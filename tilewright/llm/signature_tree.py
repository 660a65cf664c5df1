"""Signature trees: find the pairs of sets that are similar enough, without comparing all of them.

A leaf holds a few sets, a node the OR of the token bitmaps below it, the range of the sizes, and the most tokens that a
bitmap below has lost to shared bits. Two trees are walked together from their roots. A pair of nodes is dropped if the
largest overlap that any two sets below can have, by common bits and sizes, is too small; the same test is made for each
pair of sets under the leaves left. What remains is compared token by token, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

LEAF, FAN = 16, 4
LEAST_BITS, MOST_BITS = 256, 16384
CHUNK = 1024


@dataclass
class Level:
    """Nodes of one level: bitmaps, range of sizes, lost tokens; node k has the entries first[k]..first[k+1] below."""

    bits: np.ndarray
    least: np.ndarray
    most: np.ndarray
    lost: np.ndarray
    first: np.ndarray


def width(sizes: np.ndarray) -> int:
    """Bits of a bitmap: about eight for each token of a middling set."""
    middle = int(np.median(sizes)) if len(sizes) else 0
    return min(MOST_BITS, max(LEAST_BITS, 1 << max(0, 8 * middle - 1).bit_length()))


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """One row of 64-bit words for each set (uint64 tokens)."""
    out = np.empty((len(sets), bits // 64), np.uint64)
    for first in range(0, len(sets), 256):
        flags = np.zeros((min(256, len(sets) - first), bits), bool)
        for k, tokens in enumerate(sets[first : first + 256]):
            flags[k, ((tokens >> np.uint64(20)) % np.uint64(bits)).astype(np.int64)] = True
        out[first : first + 256] = np.packbits(flags, axis=1).view(np.uint64)
    return out


def tree(bits: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> list[Level]:
    """Levels from the sets (in ``order``) up to the root."""
    bits, sizes = bits[order], sizes[order]
    lost = sizes - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
    levels = [Level(bits, sizes, sizes, lost, np.arange(len(order) + 1))]
    while len(levels[-1].least) > 1 or len(levels) < 2:
        below = levels[-1]
        first = np.arange(0, len(below.least), LEAF if len(levels) == 1 else FAN)
        levels.append(
            Level(
                np.bitwise_or.reduceat(below.bits, first, axis=0), np.minimum.reduceat(below.least, first), np.maximum.reduceat(below.most, first),
                np.maximum.reduceat(below.lost, first), np.append(first, len(below.least)),
            )
        )
    return levels


def possible(a: Level, i: np.ndarray, b: Level, j: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets below a[i] and b[j] can be similar enough: an overlap is the common bits plus what one side lost, at most."""
    fits = (a.most[i] * den >= num * b.least[j]) & (b.most[j] * den >= num * a.least[i])
    common = np.bitwise_count(a.bits[i] & b.bits[j]).sum(axis=1).astype(np.int64)
    overlap = np.minimum(np.minimum(a.most[i], b.most[j]), common + np.minimum(a.lost[i], b.lost[j]))
    return fits & (overlap * (den + num) >= num * (a.least[i] + b.least[j]))


def _below(level: Level, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``nodes``, entry) of all entries below them."""
    sizes = level.first[nodes + 1] - level.first[nodes]
    which = np.repeat(np.arange(len(nodes)), sizes)
    return which, level.first[nodes][which] + np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def dual_traversal(a: list[Level], b: list[Level], num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (place in a's order, place in b's order) that the bounds can't exclude; each once, i < j where a is b."""
    work = [(len(a) - 1, len(b) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while work:
        x, y, i, j = work.pop()
        if len(i) > CHUNK:
            work += [(x, y, i[k : k + CHUNK], j[k : k + CHUNK]) for k in range(0, len(i), CHUNK)]
            continue
        keep = possible(a[x], i, b[y], j, num, den)
        if a is b:
            keep |= (i == j) & (x > 0)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if not x and not y:
            yield i, j
            continue
        if x >= y:
            which, i = _below(a[x], i)
            j, x = j[which], x - 1
            if a is not b:
                work.append((x, y, i, j))
                continue
        which, j = _below(b[y], j)  # the deeper tree, or both sides of one tree
        i, y = i[which], y - 1
        if a is b:
            upper = i < j if not y else i <= j
            i, j = i[upper], j[upper]
        work.append((x, y, i, j))


class Block:
    """Sets of one task: hosts, and visitors that are compared with the hosts only."""

    def __init__(self, sets: list[np.ndarray], n_hosts: int):
        self.sets, self.n_hosts = sets, n_hosts
        self.sizes = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        _, tokens, count = np.unique(every, return_inverse=True, return_counts=True)
        held = count[tokens] > 1
        owner = np.repeat(np.arange(len(sets)), self.sizes)[held]
        _, self.tokens = np.unique(tokens[held], return_inverse=True)
        self.at = np.searchsorted(owner, np.arange(len(sets) + 1))
        self.mark = np.zeros(len(self.tokens) and int(self.tokens.max()) + 1, bool)

    def overlaps(self, i: int, others: np.ndarray) -> np.ndarray:
        """Tokens that set i shares with each of the others."""
        mine = self.tokens[self.at[i] : self.at[i + 1]]
        sizes = self.at[others + 1] - self.at[others]
        out = np.zeros(len(others), np.int64)
        some = np.flatnonzero(sizes)
        if not len(mine) or not len(some):
            return out
        sizes = sizes[some]
        begin = np.cumsum(sizes) - sizes
        places = np.repeat(self.at[others[some]] - begin, sizes) + np.arange(int(sizes.sum()))
        self.mark[mine] = True
        out[some] = np.add.reduceat(self.mark[self.tokens[places]].astype(np.int64), begin)
        self.mark[mine] = False
        return out

    def _trees(self) -> tuple[list[Level], np.ndarray, list[Level], np.ndarray]:
        bits = bitmaps(self.sets, width(self.sizes))
        least = np.array([s[0] if len(s) else 0 for s in self.sets], np.uint64)  # near copies often share it

        def grown(rows: np.ndarray) -> tuple[list[Level], np.ndarray]:
            order = rows[np.lexsort((least[rows], np.frexp(self.sizes[rows])[1]))]
            return tree(bits, self.sizes, order), order

        hosts = grown(np.arange(self.n_hosts))
        visitors = grown(np.arange(self.n_hosts, len(self.sets))) if self.n_hosts < len(self.sets) else hosts
        return *visitors, *hosts

    def links(self, num: int, den: int, label: np.ndarray | None = None, apart: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Linked pairs (rows i, j); sets of one ``apart`` value are not compared.

        With ``label``, only links that join sets of different labels: two labels that a link has joined count as one from
        then on, so at most one link fewer than there are labels comes out, and no more are compared than that needs.
        """
        if not self.n_hosts:
            return
        label = label.copy() if label is not None else None
        a, order_a, b, order_b = self._trees()
        for i, j in dual_traversal(a, b, num, den):
            i, j = order_a[i], order_b[j]
            sub = np.argsort(i, kind="stable")
            i, j = i[sub], j[sub]
            starts = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
            for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(i)], strict=True):
                x, others = int(i[lo]), j[lo:hi]
                if apart is not None:
                    others = others[apart[others] != apart[x]]
                if label is not None:
                    others = others[label[others] != label[x]]
                if not len(others):
                    continue
                shared = self.overlaps(x, others)
                near = others[shared * den >= num * (self.sizes[x] + self.sizes[others] - shared)]
                if label is not None:
                    joins = []
                    for y in near.tolist():
                        if label[y] != label[x]:
                            label[label == label[y]] = label[x]
                            joins.append(y)
                    near = np.array(joins, np.int64)
                if len(near):
                    yield np.full(len(near), x), near
