import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute, cases
from tilewright.llm import quality_rules as Q


@pytest.mark.parametrize("broadcast_lines", [4096, 0])
def test_against_brute_force(spark, broadcast_lines):
    rng = random.Random(5)
    shared = ["Subscribe to our   letter now", "all rights reserved by the owner of this page"]
    rows = []
    for i in range(80):
        lines = [" ".join(f"v{rng.randrange(60)}" for _ in range(rng.randrange(0, 14))) for _ in range(rng.randrange(0, 6))]
        lines += [x.upper() if rng.random() < 0.5 else x for x in shared if rng.random() < 0.5]
        lines += lines[:2] if rng.random() < 0.3 else []
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), rng.choice(["a", "a", "b", None])))
    rows += [(99, None, "a"), (98, "", None), rows[3], (None, "one two", "a"), (97, "a b c d e f g h i " * 9, "b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {(r.doc_id, r.text): r.quality for r in Q.judge(df, least_docs=5, share=0.2, broadcast_lines=broadcast_lines).collect()}
    for (i, text, _), (gone, kept) in zip(rows, brute.line_rules([r[1:] for r in rows], 5, 0.2, Q.REMAIN), strict=True):
        q = got[i, text]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == brute.base_rules(text)
        assert (q.removed_words, q.kept) == (gone, kept)
        assert len(brute.WORD.findall(q.clean_text or "")) == q.n_words - gone
    assert any(q.removed_words for q in got.values())


def test_awkward_rows(spark):
    out = Q.judge(cases.frame(spark)).withColumn("r", F.struct("quality_.*")).collect()
    assert len(out) == len(cases.rows()) and "quality" in out[0].asDict()
    for r in out:
        assert tuple(r.r)[:6] == brute.base_rules(r.text)
    assert Q.judge(cases.empty(spark)).count() == 0


def test_copies_of_a_text_count_once(spark):
    text = " ".join(f"word{i}" for i in range(40))
    df = spark.createDataFrame([(i, text, "h") for i in range(60)], "doc_id bigint, text string, source string")
    assert Q.judge(df).filter("quality.kept").count() == 60
