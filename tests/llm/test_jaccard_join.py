import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute, cases
from tilewright.llm import jaccard_join as J
from tilewright.llm._util import materialize
from tilewright.llm._util import materialize, whole_groups
from tilewright.llm._words import mix
from tilewright.llm.components import components
from tilewright.llm.signature_tree import Block, dual_traversal


def corpus(seed, n=150):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    passage = [word() for _ in range(60)]
    rows, texts = [], []
    for i in range(n):
        if texts and rng.random() < 0.6:
            w = list(rng.choice(texts))
            for _ in range(rng.randrange(0, 1 + len(w) // 25)):
                w[rng.randrange(len(w))] = word()
        else:
            w = [word() for _ in range(rng.choice([1, 3, 5, 6, 20, 60, 150]))]
            w += passage if rng.random() < 0.5 else []
        texts.append(w)
        rows.append((i * 2, " ".join(x.upper() if rng.random() < 0.2 else x for x in w)))
    return [*rows, (1001, None), (1003, ""), (1005, " \n"), (1007, "lonely"), (1009, "Lonely"), (1011, "w1 w2 w3 w4"), (1013, "w1\tw2 w3 W4")]


@pytest.mark.parametrize(("seed", "block", "marks"), [(1, J.BLOCK, J.MOST_MARKS), (2, 3, 0)])
def test_against_brute_force(spark, monkeypatch, seed, block, marks):
    monkeypatch.setattr(J, "MOST_MARKS", marks)  # 0: no bitmap helps, all rows go to the joins
    monkeypatch.setattr(J, "BROADCAST_ROWS", marks)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.classes(df, block=block).collect()}
    want = brute.near_classes(rows)
    assert got == {i: (len(brute.shingles(t)), want[i]) for i, t in rows}
    kept = {r.doc_id for r in J.keep_first(df).collect()}
    assert kept == set(want.values())


def test_awkward_rows(spark):
    df = cases.frame(spark)
    rows = cases.rows()
    out = J.classes(df).collect()
    assert len(out) == len(rows)
    ids = {r[0]: r[1] for r in rows if r[0] is not None}
    want = brute.near_classes(sorted(ids.items()))
    for r in out:
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id]
    kept = J.keep_first(df)
    assert kept.columns == df.columns and kept.count() == len(set(want.values())) + 1  # and the row of nulls
    assert J.classes(cases.empty(spark)).count() == 0 and J.keep_first(cases.empty(spark)).count() == 0


@given(st.lists(st.sets(st.integers(0, 60), min_size=1, max_size=40), min_size=1, max_size=60), st.integers(0, 60), st.booleans(), st.sampled_from([50, 75, 90]))
@settings(max_examples=150, deadline=None)
def test_traversal_loses_no_pair(sets, visitors, labelled, num):
    """Every link between hosts, or between visitors and hosts; with labels those that join them, and never a link too many."""
    rows = [np.sort(np.array([x * 7919 << 20 for x in s], np.uint64)) for s in sets]
    hosts = max(1, len(sets) - visitors)
    like = lambda i, j: J.similar(len(sets[i] & sets[j]), len(sets[i]), len(sets[j]), num, 100)
    pairs = [(i, j) for j in range(hosts) for i in (range(hosts, len(sets)) if hosts < len(sets) else range(j)) if like(i, j)]
    label = np.array([k % 7 if labelled else k for k in range(len(sets))])
    apart = np.arange(len(sets))
    every = [(int(i), int(j)) for x, y in Block(rows, hosts).links(num, 100, None, apart) for i, j in zip(x, y, strict=True)]
    assert sorted(tuple(sorted(p)) for p in every) == sorted(tuple(sorted(p)) for p in pairs)
    some = [(int(i), int(j)) for x, y in Block(rows, hosts).links(num, 100, label, apart) for i, j in zip(x, y, strict=True)]
    assert set(map(frozenset, some)) <= set(map(frozenset, pairs)) and len(some) < max(2, len(set(label.tolist())))
    joined = lambda found: brute.roots(set(label.tolist()), [(int(label[i]), int(label[j])) for i, j in found])
    assert joined(some) == joined(pairs)


def test_bounds_drop_what_is_far():
    """Sets without a common token are dropped at the trees' upper levels; their pairs are never listed."""
    sets = [np.sort(mix(np.arange(k * 100, k * 100 + 100, dtype=np.uint64))) for k in range(200)]
    block = Block(sets, len(sets))
    a, _, b, _ = block._trees()
    assert sum(len(i) for i, _ in dual_traversal(a, b, 75, 100)) < 200 and not list(block.links(75, 100))


@pytest.mark.parametrize("block", [J.BLOCK, 16])
def test_a_dense_group_gives_few_links(spark, block):
    """Near copies that are not all near one leader: one component, from fewer links than there are sets in a block and its visitors."""
    rng = random.Random(11)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randrange(1, 6)):
            w[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = brute.near_classes(rows)
    assert {r.doc_id: r.component_id for r in J.classes(df, block=block).collect()} == want
    members, company, sets = J._dealt(df, "doc_id", "text", 75, 100)
    _, found = J._in_families(company, sets, 75, 100, block, False)
    assert found.count() <= 120 * (1 if block > 120 else 3)


def test_whole_groups():
    rng = random.Random(3)
    keys = sorted((rng.randrange(6), rng.randrange(3)) for _ in range(200))
    rows = pa.RecordBatch.from_arrays([pa.array([a for a, _ in keys]), pa.array([b for _, b in keys]), pa.array(range(200))], ["a", "b", "c"])
    for size in (1, 7, 50, 200):
        parts = list(whole_groups(iter([rows.slice(k, size) for k in range(0, 200, size)] + [rows.slice(0, 0)]), 2))
        ends = [set(zip(p.column(0).to_pylist(), p.column(1).to_pylist(), strict=True)) for p in parts]
        assert sum(map(len, ends)) == len(set().union(*ends)) and [x for p in parts for x in p.column(2).to_pylist()] == list(range(200))


def test_components(spark):
    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.root for r in components(df, "a", "b").collect()}
    nodes = {x for p in links for x in p if x is not None}
    want = brute.roots(nodes, [p for p in links if None not in p])
    assert got == {n: r for n, r in want.items() if n != r}
    assert components(df.filter("a < 0"), "a", "b").count() == 0


@pytest.mark.parametrize(("seed", "block"), [(4, J.BLOCK), (5, 3)])
def test_links_are_complete(spark, seed, block):
    """Every link between distinct sets, in a dense group too, where components need a spanning part only."""
    rng = random.Random(seed)
    rows = corpus(seed)
    dense = [f"d{k}" for k in range(200)]
    for i in range(30):
        w = list(dense)
        w[rng.randrange(200)] = f"x{i}"
        rows.append((3001 + 2 * i, " ".join(w)))
    rows.append((3101, rows[-1][1].upper()))
    sets = {i: brute.shingles(t) for i, t in rows}
    want = {(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and J.similar(len(sets[i] & sets[j]), len(sets[i]), len(sets[j]), J.NUM, J.DEN)}
    members, pairs = J.links(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), block=block)
    of = {r.doc_id: (r.n_shingles, r.set_id) for r in members.collect()}
    found = [(r.a, r.b) for r in pairs.collect()]
    assert len(set(found)) == len(found) and all(a < b for a, b in found)
    linked = set(found) | {(b, a) for a, b in found}
    got = {(i, j) for i in of for j in of if i < j and of[i][1] is not None and (of[i][1] == of[j][1] or (of[i][1], of[j][1]) in linked)}
    assert got == want and {i: n for i, (n, _) in of.items()} == {i: len(s) for i, s in sets.items()}
    assert J.links(cases.empty(spark))[1].count() == 0


def test_low_thresholds_lose_no_link(spark):
    """A text of one shingle in a text of four: similarity 1/4, by a shingle that may come last in the order."""
    texts = [[f"v{i}x{k}" for k in range(8)] for i in range(30)]
    rows = [(2 * i + j, " ".join(w[: 5 + 3 * j])) for i, w in enumerate(texts) for j in (0, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in J.classes(df, num=25).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}
    with pytest.raises(ValueError, match="threshold"):
        J.classes(df, num=0)


def test_sets_are_dealt_out_to_their_places_without_a_shuffle_of_their_own(spark, monkeypatch):
    """Sets of many places, more than the rows that are broadcast, are joined by broadcast and shuffled once."""
    sets = spark.createDataFrame([(k, shingle_bytes(range(k, k + 40))) for k in range(6)], "sid bigint, shingles binary")
    rows = [(g, -1, 0, False, k, k, k) for g in range(50) for k in range(6)]
    placed = materialize(spark.createDataFrame(rows, "grp bigint, i int, j int, visitor boolean, sid bigint, label bigint, apart bigint"), "placed")
    monkeypatch.setattr(J, "BROADCAST_ROWS", 100)
    links = J._links(placed, materialize(sets, "sets"), 75, 100, True)
    assert {tuple(r) for r in links.distinct().collect()} == {(a, b) for a in range(6) for b in range(a + 1, 6) if (40 - (b - a)) * 100 >= 75 * (40 + b - a)}
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "strategy=broadcast" in plan and plan.count("RepartitionByExpression") == 1


def shingle_bytes(values):
    return np.array(sorted(values), np.uint64).tobytes()
