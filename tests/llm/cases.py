"""Awkward rows that every operator must take: nulls, blanks, long texts, ties, repeated rows, clashing names."""

import random

SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint, quality string, shard int, score double, spans string, key string"


def rows(seed=0, n=30):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(300)}é" if rng.random() < 0.1 else f"w{rng.randrange(300)}" for _ in range(400)]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    texts = [text(rng.randrange(1, 120)) for _ in range(n)]
    texts += [None, "", "   ", "\n\t\n", "word", "ünïcode ☃ 漢字 " * 30, texts[0], texts[1] + "\n" + texts[2], text(30000), "same line here\n" * 40]
    out = [(i, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"s{i % 2}", None if t is None else len(t), "q", 5, 0.5, "x", "k") for i, t in enumerate(texts)]
    return [*out, out[0], out[0], (None, texts[3], "en", "s0", 1, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]


def frame(spark, seed=0, partitions=3):
    return spark.createDataFrame(rows(seed), SHAPE).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SHAPE)
