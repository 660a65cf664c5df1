import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute, cases
from tilewright.llm import decontamination as D


def corpus(seed=3):
    rng = random.Random(seed)
    w = lambda k: [rng.choice("The cat, sat On a mat. AND ran far Away über 12 x".split()) for _ in range(k)]
    items = [(i, " ".join(w(rng.choice([1, 3, 6, 10, 14, 25])) if i else w(2))) for i in range(12)] + [(20, None), (21, "  ..")]
    items[1] = (1, " ".join(f"q{k}" for k in range(12)))
    items[2] = (2, items[3][1])
    docs = [(i, " - ".join(w(rng.randrange(0, 60)))) for i in range(40)]
    docs += [(50, "start " + items[1][1].upper() + "! end"), (51, "q0 q1 q2"), (52, None), (53, ""), (54, "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 " * 3)]
    return docs, items


@pytest.mark.parametrize("part_words", [10**6, 5])
def test_against_brute_force(spark, part_words):
    docs, items = corpus()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = D.occurrences(frame, bench, ["doc_id"], part_words=part_words)
    got = {r.doc_id: r for r in found.withColumn("n_hit", D.covered_words("starts", "ends")).collect()}
    for i, text in docs:
        n, hit, its = brute.contamination(text, items)
        r = got[i]
        assert (r.n_words, r.n_hit, list(r["items"])) == (n, hit, its)
        assert D.covered(r.starts, r.ends) == hit
    clean = {r.doc_id for r in D.decontaminate(frame, bench, part_words=part_words).collect()}
    assert clean == {i for i, t in docs if not brute.contamination(t, items)[1]}


def test_awkward_rows(spark):
    bench = spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11")], "item_id bigint, text string")
    none = bench.filter(F.lit(False))
    df = cases.frame(spark)
    assert D.decontaminate(df, bench).columns == df.columns
    assert D.decontaminate(df, none).count() == len(cases.rows())
    assert D.occurrences(df, none, ["doc_id"]).filter("size(starts) > 0").count() == 0
    assert D.occurrences(cases.empty(spark), bench, ["doc_id"]).count() == 0


def test_awkward_rows_are_kept_apart_with_several_parts(spark):
    """Repeated rows, null keys and texts that share a key: one result a row, however many parts the benchmark has."""
    words = cases.rows()[0][1].split()
    items = [(1, " ".join(words[:12])), (2, "w1"), (3, " ".join(words[1:13])), (4, "w7 w8")]
    bench = spark.createDataFrame(items, "item_id bigint, text string").coalesce(1)
    extra = [(0, "w7 w8 w9"), (0, "w1"), (None, "w1 w1"), (None, "w7 w8")]
    rows = [(r[0], r[1]) for r in cases.rows()] + extra
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = D.occurrences(df, bench, ["doc_id"], part_words=5).withColumn("n_hit", D.covered_words("starts", "ends")).collect()
    order = lambda x: (x[0] is None, str(x))
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found), key=order)
    assert got == sorted(((i, *brute.contamination(t, items)) for i, t in rows), key=order)


def test_equal_hashes_are_no_match(monkeypatch):
    """With hashes that say nothing, only the words themselves decide."""
    place = D.word_places

    def blind(*args):
        hashes, *rest = place(*args)
        return hashes & np.uint64(1), *rest

    monkeypatch.setattr(D, "word_places", blind)
    docs, items = corpus()
    searchers = D.compile_items([(str(i), t) for i, t in items], D.WINDOW)
    for words, (_, text) in zip(D.texts_of(pa.array([t for _, t in docs], pa.string())), docs, strict=True):
        starts, ends, found = D._find(words, searchers)
        assert (D.covered(starts, ends), sorted(found)) == brute.contamination(text, items)[1:]


def test_clashing_names(spark):
    bench = spark.createDataFrame([(1, "a b c", "x")], "item bigint, body string, text string")
    df = spark.createDataFrame([("i", "a b c d", 7, 1), ("j", None, None, None)], "items string, text string, n_words int, starts int")
    for part_words in (10**6, 1):
        both = bench.union(bench.selectExpr("2", "'c d'", "'y'"))
        out = D.occurrences(df, both, ["items", "text", "n_words", "starts"], item="item", item_text="body", part_words=part_words)
        assert out.columns == ["items", "text", "n_words", "starts", "n_words_", "starts_", "ends", "items_"]
        assert {(r["items"], r.n_words_, tuple(r.items_)) for r in out.collect()} == {("i", 4, ("1", "2")), ("j", 0, ())}
    assert [r["items"] for r in D.decontaminate(df, bench, item="item", item_text="body").collect()] == ["j"]
