import math
import random
import re
import unicodedata

import numpy as np
from pyspark.sql import functions as F

from tests.llm import cases
from tilewright.llm import quality_model as Q


def labelled(spark, n=400, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"word{rng.randrange(500)}" for _ in range(rng.randrange(5, 60))]
        good = rng.random() < 0.7
        rows.append((i, " ".join(words if good else [w + rng.choice("#$%*") for w in words]), int(good)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    return df.select("doc_id", "text"), df.select("doc_id", "quality")


def test_learns_rules_and_scores_natively(spark):
    docs, labels = labelled(spark)
    model = Q.fit(*Q.training_sample(docs, labels.filter("doc_id % 2 = 0"), "doc_id", "text", "quality"))
    assert 0 < len(model.rules) < 200 and model.describe()
    scored = Q.score(docs, model, ["doc_id"])
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert np.mean([r.predicted == truth[r.doc_id] for r in scored.collect() if r.doc_id % 2]) > 0.95


def plain_statistics(text):
    text = text or ""
    words, lines = re.findall(r"[^\x20\x09-\x0D]+", text), text.split("\n")
    n = max(1, len(words))
    counts = [sum(c in "#$%*&<>" for c in text), text.count("|"), text.count("!"), sum(c in "0123456789" for c in text), sum(c in ".,;:?" for c in text)]
    upper = sum(unicodedata.category(c) == "Lu" for c in text)
    return [len(text), len(words), sum(map(len, words)) / n, *[c / n for c in (upper, *counts)], len(lines) / n, (len(lines) - len(set(lines))) / len(lines), len(set(words)) / n]


def test_compiled_columns_against_plain_rules(spark):
    """The statistics and the score of each text, computed once more by plain Python from the model's rules."""
    docs, labels = labelled(spark, 120)
    model = Q.fit(*Q.training_sample(docs, labels, "doc_id", "text", "quality"))
    texts = [r.text for r in docs.limit(60).collect()] + [r[1] for r in cases.rows()] + ["A|b! c9. Éa\n\nA|b! c9.\n#$%*&<>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(2)
    got = {r.doc_id: r for r in df.select("doc_id", Q.statistics(F.col("text")).alias("s")).collect()}
    scores = {r.doc_id: r for r in Q.score(df, model, ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        stats = plain_statistics(text)
        assert np.allclose(list(got[i].s), stats, rtol=1e-12), text
        margin = model.bias
        for rule, weight in zip(model.rules, model.weights, strict=True):
            if all(stats[k] <= cut if at_most else stats[k] > cut for k, at_most, cut in rule):
                margin += weight
        score = 1 / (1 + math.exp(-margin))
        assert math.isclose(scores[i].score, score, rel_tol=1e-9) and scores[i].predicted == int(score >= 0.5)


def test_rules_hold_for_the_rows_of_their_path():
    x = np.array([[0.0, 1], [1, 2], [2, 3], [3, 4]])
    assert Q._holds(x, ((0, True, 1.0), (1, False, 1.0))).tolist() == [False, True, False, False]
    assert Q._simplify(((0, True, 3.0), (0, True, 1.0), (0, False, 0.0))) == ((0, False, 0.0), (0, True, 1.0))


def test_awkward_rows(spark):
    constant = Q.fit(np.zeros((0, len(Q.STATISTICS))), np.zeros(0), np.zeros(0))
    out = Q.score(cases.frame(spark), constant, ["doc_id", "score"]).collect()
    assert len(out) == len(cases.rows()) and {r.score_ for r in out} == {0.5} and {r.predicted for r in out} == {1}
    docs, labels = labelled(spark, 60)
    model = Q.fit(*Q.training_sample(docs, labels, "doc_id", "text", "quality"))
    assert all(0 <= r.score_ <= 1 for r in Q.score(cases.frame(spark), model, ["doc_id", "score"]).collect())
    assert Q.score(cases.empty(spark), model, ["doc_id"]).count() == 0
    sample = Q.training_sample(cases.empty(spark), labels.filter("doc_id < 0"), "doc_id", "text", "quality")
    assert Q.fit(*sample).rules == []
