from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import cases
from tilewright.llm import packing as P


@given(st.lists(st.integers(1, 100), max_size=60), st.sets(st.integers(20, 100), min_size=1, max_size=4))
@settings(max_examples=150, deadline=None)
def test_best_fit(lengths, capacities):
    capacities = tuple(capacities | {100})
    bins, offsets, caps = P.best_fit(lengths, capacities, 3)
    held = defaultdict(list)
    for n, b, o in zip(lengths, bins, offsets, strict=True):
        held[b].append((o, n))
    for b, parts in held.items():
        parts.sort()
        assert parts[0][0] == 0 and all(p[0] + p[1] == q[0] for p, q in zip(parts, parts[1:], strict=False))
        used = sum(n for _, n in parts)
        assert caps[b] == min(c for c in capacities if c >= used)
    assert sorted(held) == list(range(len(caps)))


def test_best_fit_takes_the_tightest_open_bin():
    bins, _, caps = P.best_fit([60, 50, 40, 30], (100,), 0)
    assert bins[2] == bins[0] and caps == [100, 100]


def test_documents(spark):
    df = cases.frame(spark).selectExpr("*", "n_chars as bin_id")
    out = P.pack(df, "n_chars", ["doc_id", "bin_id"], capacities=(256, 1024), block_pieces=10).collect()
    sizes, pieces = defaultdict(int), defaultdict(int)
    for r in out:
        pieces[r.doc_id] += r.piece_length
        assert (r.bin_id_ is None) == (r.piece_length == 0)
        if r.bin_id_ is not None:
            sizes[r.bin_id_, r.bin_capacity] += r.piece_length
            assert r.bin_offset + r.piece_length <= r.bin_capacity
    assert all(used <= cap and cap in (256, 1024) for (_, cap), used in sizes.items())
    want = defaultdict(int)
    for r in cases.rows():
        want[r[0]] += r[4] or 0
    assert pieces == want
    assert P.pack(cases.empty(spark), "n_chars", ["doc_id"]).count() == 0


def plain_best_fit(lengths, capacities, overhead):
    """(contents, capacity) of the bins, by trying every open bin for every piece."""
    bins, left = [], sum(lengths)
    for n in sorted(lengths, reverse=True):
        fits = [(b["cap"] - sum(b["held"]) - n, k) for k, b in enumerate(bins) if b["cap"] - sum(b["held"]) >= n]
        if fits:
            bins[min(fits)[1]]["held"].append(n)
        else:
            costs = {c: (c + overhead) / min(c, left) for c in capacities if c >= n}
            cap = max(c for c in costs if costs[c] == min(costs.values()))
            bins.append({"cap": cap, "held": [n]})
        left -= n
    return sorted((sorted(b["held"]), min(c for c in capacities if c >= sum(b["held"]))) for b in bins)


@given(st.lists(st.integers(1, 100), max_size=40), st.sets(st.integers(20, 100), max_size=4), st.integers(0, 30))
@settings(max_examples=200, deadline=None)
def test_best_fit_against_brute_force(lengths, capacities, overhead):
    capacities = tuple(capacities | {100})
    bins, _, caps = P.best_fit(lengths, capacities, overhead)
    held = defaultdict(list)
    for n, b in zip(lengths, bins, strict=True):
        held[b].append(n)
    assert sorted((sorted(v), caps[b]) for b, v in held.items()) == plain_best_fit(lengths, capacities, overhead)


def test_bins_do_not_depend_on_the_layout(spark):
    rows = [(i, 37 * i * i % 900 - 20) for i in range(300)] + [(7, 50)] * 40 + [(None, None), (None, 64)]
    made = []
    for parts in (1, 3, 8):
        out = P.pack(spark.createDataFrame(rows, "doc_id bigint, n bigint").repartition(parts), "n", ["doc_id"], (64, 256), block_pieces=60)
        made.append(sorted(map(str, out.collect())))
        c = P.cost(out, (64, 256)).first()
    assert made[0] == made[1] == made[2] and len(made[0]) >= len(rows)
    assert c.tokens == sum(max(n or 0, 0) for _, n in rows) and 1 <= c.excess < 1.3 and c.fill > 0.9


def test_copies_of_a_row_lie_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "COPIES_PER_CHUNK", 10)
    out = P.pack(spark.createDataFrame([(1, 30)] * 500, "doc_id bigint, n bigint"), "n", ["doc_id"], (64,), block_pieces=50).collect()
    assert len(out) == 500 and len({r.bin_id >> 32 for r in out}) > 3
