"""Operator 7, quality classifier: a sparse ensemble of rules over text statistics.

Boosted shallow trees are grown on a bounded labelled sample; every path from a root becomes a conjunctive rule. A
lasso logistic regression over the rules keeps few of them, and the result is compiled into a Spark column
expression over the statistics, so scoring all documents runs without Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import fresh, let
from .quality_rules import words

SAMPLE_PER_CLASS = 3000
TREES, DEPTH, CUTS = 40, 3, 24
PENALTY = 0.002

Condition = tuple[int, bool, float]  # statistic, "at most", threshold
Rule = tuple[Condition, ...]

#: Characters counted for each word.
PATTERNS = {"upper": r"\p{Lu}", "symbols": r"[#*$%&<>]", "bars": r"\|", "bangs": "!", "digits": "[0-9]", "stops": "[.,;:?]"}
STATISTICS = ("n_chars", "n_words", "word_length", *PATTERNS, "lines", "repeated_lines", "distinct_words")


def statistics(text: Column) -> Column:
    """Struct of the named statistics of a text as doubles; an empty or null text has zeros."""
    text = F.coalesce(text, F.lit(""))
    share = lambda a, n: (a / n).cast("double")
    of_words = lambda w: let(
        F.greatest(F.size(w), F.lit(1)),
        lambda n: F.struct(F.size(w).cast("double").alias("n"), share(F.length(F.array_join(w, "")), n).alias("length"), share(F.size(F.array_distinct(w)), n).alias("distinct")),
    )
    of_lines = lambda x: F.struct(F.size(x).alias("n"), share(F.size(x) - F.size(F.array_distinct(x)), F.size(x)).alias("again"))
    counts = {name: F.regexp_count(text, F.lit(p)) for name, p in PATTERNS.items()}
    held = F.struct(let(words(text), of_words).alias("w"), let(F.split(text, "\n"), of_lines).alias("l"))

    def named(x: Column) -> Column:
        n = F.greatest(x["w"]["n"], F.lit(1.0))
        values = (
            F.length(text).cast("double"), x["w"]["n"], x["w"]["length"], *[share(c, n) for c in counts.values()],
            share(x["l"]["n"], n), x["l"]["again"], x["w"]["distinct"],
        )
        return F.struct(*[v.alias(k) for k, v in zip(STATISTICS, values, strict=True)])

    return let(held, named)


@dataclass
class RuleModel:
    rules: list[Rule]
    weights: list[float]
    bias: float

    def margin(self, stats: list[Column]) -> Column:
        total = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for k, at_most, cut in rule:
                holds = holds & ((stats[k] <= F.lit(cut)) if at_most else (stats[k] > F.lit(cut)))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return total

    def describe(self) -> list[str]:
        say = lambda r: " and ".join(f"{STATISTICS[k]} {'<=' if m else '>'} {c:.4g}" for k, m, c in r)
        return [f"{w:+.3f} if {say(r)}" for r, w in sorted(zip(self.rules, self.weights, strict=True), key=lambda x: -abs(x[1]))]


def _holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    out = np.ones(len(x), bool)
    for k, at_most, cut in rule:
        out &= (x[:, k] <= cut) if at_most else (x[:, k] > cut)
    return out


def _grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, cuts: list[np.ndarray], rows: np.ndarray, path: Rule, depth: int, rules: list[Rule], value: np.ndarray) -> None:
    """A regression tree on the Newton step; its paths go to ``rules``, its leaf values to ``value``."""
    g, h = grad[rows].sum(), hess[rows].sum()
    best, split = 1e-6, None
    if depth and len(rows) >= 20:
        for k, thresholds in enumerate(cuts):
            if not len(thresholds):
                continue
            bin_of = np.searchsorted(thresholds, x[rows, k], side="left")
            gs = np.cumsum(np.bincount(bin_of, grad[rows], len(thresholds) + 1))[:-1]
            hs = np.cumsum(np.bincount(bin_of, hess[rows], len(thresholds) + 1))[:-1]
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            j = int(gain.argmax())
            if gain[j] > best:
                best, split = gain[j], (k, thresholds[j])
    if split is None:
        value[rows] = -g / (h + 1)
        return
    k, cut = split
    low = x[rows, k] <= cut
    for part, at_most in ((rows[low], True), (rows[~low], False)):
        rule = (*path, (k, at_most, float(cut)))
        rules.append(rule)
        _grow(x, grad, hess, cuts, part, rule, depth - 1, rules, value)


def _simplify(rule: Rule) -> Rule:
    """The tightest bound on each side of each statistic, in a fixed order."""
    tight: dict[tuple[int, bool], float] = {}
    for k, at_most, cut in rule:
        tight[k, at_most] = (min if at_most else max)(tight.get((k, at_most), cut), cut)
    return tuple((k, m, c) for (k, m), c in sorted(tight.items()))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> RuleModel:
    """Rules and weights from statistics x, labels y (0/1) and row weights; without both classes, a constant score."""
    if not len(y) or y.min() == y.max():
        return RuleModel([], [], 0.0 if not len(y) else 4.0 * (2 * float(y[0]) - 1))
    weight = weight / weight.mean()
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, CUTS + 2)[1:-1])) for c in x.T]
    margin, found = np.zeros(len(y)), {}
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        rng = np.random.Generator(np.random.PCG64(t))
        rows = np.flatnonzero(rng.random(len(y)) < 0.7)
        rules, value = [], np.zeros(len(y))
        use = [c if rng.random() < 0.7 else c[:0] for c in cuts]
        _grow(x, weight * (p - y), weight * p * (1 - p), use, rows, (), DEPTH, rules, value)
        margin += 0.3 * value
        for rule in map(_simplify, rules):
            found.setdefault(_holds(x, rule).tobytes(), rule)  # of rules that hold for the same rows, the first
    rules = list(found.values())
    z = np.stack([_holds(x, r) for r in rules], 1).astype(np.float64)
    w, b = _lasso(z, y, weight)
    keep = np.flatnonzero(np.abs(w) > 1e-6)
    return RuleModel([rules[k] for k in keep], [float(w[k]) for k in keep], float(b))


def _lasso(z: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 600) -> tuple[np.ndarray, float]:
    """Logistic loss with an L1 penalty by accelerated proximal gradient; the intercept is not penalised."""
    n, m = z.shape
    v = np.ones(m)
    for _ in range(30):
        v = z.T @ (z @ v)
        v /= np.linalg.norm(v)
    step = 4.0 * n / (float(v @ (z.T @ (z @ v))) * weight.max() + n)
    w, b, pw, pb = np.zeros(m), 0.0, np.zeros(m), 0.0
    for k in range(steps):
        aw, ab = w + k / (k + 3) * (w - pw), b + k / (k + 3) * (b - pb)
        pw, pb = w, b
        r = weight * (1 / (1 + np.exp(-np.clip(z @ aw + ab, -30, 30))) - y)
        w = aw - step * (z.T @ r) / n
        w = np.sign(w) * np.maximum(np.abs(w) - step * PENALTY, 0)
        b = ab - step * r.mean()
    return w, b


def training_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_class: int = SAMPLE_PER_CLASS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistics, labels and weights of about ``per_class`` labelled rows of each class, picked by a hash of the key."""
    labels = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key), F.col(label).cast("int").alias("_y"))
    counts = {r[0]: r[1] for r in labels.groupBy("_y").count().collect()}  # two rows
    draw = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("quality")), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("_y") == 1, min(1.0, per_class / counts.get(1, 1))).otherwise(min(1.0, per_class / counts.get(0, 1)))
    picked = F.broadcast(labels.filter(draw < share))  # about 2 * per_class rows of two numbers, at any size
    rows = docs.select(key, text).join(picked, key).select("_y", statistics(F.col(text)).alias("s")).select("_y", "s.*").collect()
    rows = sorted(tuple(r) for r in rows)
    x = np.array([r[1:] for r in rows], np.float64).reshape(len(rows), len(STATISTICS))
    y = np.array([r[0] for r in rows], np.float64)
    weight = np.array([counts[int(c)] / max(1, (y == c).sum()) for c in y], np.float64)
    return x, y, weight


def score(docs: DataFrame, model: RuleModel, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, score (0 to 1, higher: label 1 likelier) and predicted (1 if score >= 0.5, else 0).

    Null and empty texts are scored by their statistics, nearly all zero. Repeated rows are scored alike, and an empty table
    gives an empty result. With nothing learned the score is 0.5, which counts as 1. Added columns get a trailing underscore where ``keep`` has their name.
    """
    names = [fresh(docs.select(*keep), n) for n in ("score", "predicted")]
    # as a lambda's body the rules are interpreted: generated code with all of them takes the compiler over 1 GB
    margin = let(statistics(F.col(text)), lambda x: model.margin([x[n] for n in STATISTICS]))
    out = docs.select(*keep, (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).alias(names[0]))
    return out.withColumn(names[1], F.when(F.col(names[0]) >= 0.5, 1).otherwise(0).cast("int"))
