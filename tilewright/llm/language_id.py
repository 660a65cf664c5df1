"""Operator 10, language identification by error-correcting output codes over hashed character n-grams.

Each language has a codeword; for each bit a logistic classifier over 1- to 3-gram frequencies predicts that bit.
Decoding is loss-weighted: the language whose codeword has the least logistic loss against the bits' margins, each
bit weighted by its training accuracy, wins; a near tie between the best two flags the prediction as ambiguous.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import fresh

BUCKETS = 4096
SAMPLE_PER_LANGUAGE, MOST_LANGUAGES = 400, 1000
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
_M = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed 1-, 2- and 3-grams of the lower-cased text."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    counts = np.zeros(BUCKETS, dtype=np.float32)
    for first in range(0, len(a), 1 << 20):  # long texts in pieces that overlap by two characters
        x = a[max(first - 2, 0) : first + (1 << 20)]
        skip = min(first, 2)
        one = x[skip:] * _M[0]
        two = x[1:] * _M[1] + x[:-1] * _M[0] if len(x) > 1 else x[:0]
        three = x[2:] * _M[2] + x[1:-1] * _M[1] + x[:-2] * _M[0] if len(x) > 2 else x[:0]
        for h in (one, two[1:] if skip else two, three):
            counts += np.bincount((h ^ (h >> np.uint32(15))) >> np.uint32(7) & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    total = counts.sum()
    return np.sqrt(counts / total) if total else counts


def codewords(n: int) -> np.ndarray:
    """n rows of +-1, far apart: every way to split few languages in two, else a fixed random code."""
    if n <= 1:
        return np.ones((n, 1), dtype=np.float32)
    if n <= 6:
        splits = [[1 if i == 0 or (k >> (i - 1)) & 1 else -1 for i in range(n)] for k in range(2 ** (n - 1) - 1)]
        return np.array(splits, dtype=np.float32).T
    rng = np.random.Generator(np.random.PCG64(7))
    length = 10 * int(np.ceil(np.log2(n)))
    draws = [np.where(rng.random((n, length)) < 0.5, 1.0, -1.0) for _ in range(200)]
    far = lambda c: (c @ c.T - 2 * length * np.eye(n)).max()
    return min(draws, key=far).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        margin = x @ self.weights + self.bias
        return np.logaddexp(0, -margin[:, None, :] * self.code[None]) @ self.trust

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        tags, scores, unsure = [], [], []
        known = [t is not None and bool(self.languages) and bool(_LETTER.search(t)) for t in texts]
        for first in range(0, len(texts), 256):
            part = [features(t) for t, k in zip(texts[first : first + 256], known[first : first + 256], strict=True) if k]
            rows = iter(self.losses(np.stack(part)) if part else ())
            for k in known[first : first + 256]:
                if not k:
                    tags.append(UNDETERMINED)
                    scores.append(0.0)
                    unsure.append(True)
                    continue
                loss = next(rows)
                share = np.exp(loss.min() - loss)
                share /= share.sum()
                best = int(loss.argmin())
                tags.append(self.languages[best])
                scores.append(float(share[best]))
                unsure.append(bool(len(share) > 1 and np.sort(share)[-2] > 0.8 * share[best]))
        return tags, scores, unsure


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 200, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """All bits' classifiers at once by accelerated gradient descent; rows of x have unit norm, so the step is safe."""
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    v, vb = w, b
    for k in range(steps):
        momentum = np.float32(k / (k + 3))
        aw, ab = w + momentum * (w - v), b + momentum * (b - vb)
        v, vb = w, b
        pull = -y / (1 + np.exp(np.clip(y * (x @ aw + ab), -30, 30)))
        w = aw - np.float32(2) * (x.T @ pull / len(y) + np.float32(ridge) * aw)
        b = ab - np.float32(2) * pull.mean(axis=0)
    return w, b


def fit(x: np.ndarray, tongues: list[str]) -> Model:
    """A model from the features of texts (one row each) and their languages."""
    languages = sorted(set(tongues))
    code = codewords(len(languages))
    if not languages:
        return Model([], code, np.zeros((BUCKETS, 1), np.float32), np.zeros(1, np.float32), np.ones(1, np.float32))
    place = {lang: k for k, lang in enumerate(languages)}
    y = code[[place[lang] for lang in tongues]]
    w, b = _logistic(x, y)
    trust = np.maximum(0.05, 2 * (np.sign(x @ w + b) == y).mean(axis=0) - 1)
    return Model(languages, code, w, b, (trust * 4 / trust.sum()).astype(np.float32))


def fit_texts(samples: list[tuple[str, str]]) -> Model:
    """A model from (text, language) pairs."""
    return fit(np.stack([features(t) for t, _ in samples]) if samples else np.zeros((0, BUCKETS), np.float32), [lang for _, lang in samples])


def training_sample(labelled: DataFrame, key: str, text: str, lang: str, per_language: int = SAMPLE_PER_LANGUAGE, most_languages: int = MOST_LANGUAGES) -> tuple[np.ndarray, list[str]]:
    """Features and languages of about ``per_language`` labelled rows of each language, picked by a hash of the key.

    Texts are read whole where they lie; the driver gets BUCKETS numbers a row, however long they are. With more
    than ``most_languages`` languages the most frequent are learned, of equally frequent ones the first by name.
    """
    labelled = labelled.select(F.col(key).cast("string").alias("_key"), F.col(text).alias("_text"), F.col(lang).cast("string").alias("_lang"))
    labelled = labelled.filter(F.col("_lang").isNotNull() & F.col("_text").isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy("_lang").count().orderBy(F.desc("count"), "_lang").limit(most_languages).collect()}
    if not counts:
        return np.zeros((0, BUCKETS), np.float32), []
    draw = F.pmod(F.xxhash64("_key", F.lit("lid")), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, per_language / n))])
    picked = labelled.filter(draw < F.element_at(share, F.col("_lang")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 100):
                part = batch.slice(first, 100)
                rows = pa.array([features(t.as_py()).tobytes() for t in part.column(1)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), rows], ["_key", "_lang", "x"])

    rows = sorted(((r[0] or "", r[1], bytes(r[2])) for r in picked.mapInArrow(run, "_key string, _lang string, x binary").collect()))
    return np.array([np.frombuffer(r[2], np.float32) for r in rows], np.float32).reshape(len(rows), BUCKETS), [r[1] for r in rows]


def identify(docs: DataFrame, model: Model, key: list[str], text: str = "text") -> DataFrame:
    """One row per document: key columns, lang_pred, score in 0..1, ambiguous.

    Null texts, and texts without a letter, are ``und`` with score 0, as is everything when nothing was learned.
    Of languages of equal loss the first by name wins, flagged as ambiguous. Repeated rows are judged alike, and an
    empty table gives an empty result. Result columns that clash with ``key`` get a trailing underscore.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights for each bit: 10 * log2(MOST_LANGUAGES) bits at most
    mine = docs.select(*[F.col(f"`{k}`") for k in key])
    names, body = [fresh(mine, n) for n in ("lang_pred", "score", "ambiguous")], fresh(mine, "_text")
    kinds = ("string", "double", "boolean")
    shape = ", ".join([*[f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in key], *[f"`{n}` {kind}" for n, kind in zip(names, kinds, strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags, scores, unsure = held.value.predict(batch.column(len(key)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(key)], pa.array(tags, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())], [*key, *names])

    return docs.select(*[F.col(f"`{k}`") for k in key], F.col(f"`{text}`").alias(body)).mapInArrow(run, shape)
