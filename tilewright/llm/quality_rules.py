"""Operator 3, quality rules: word and line statistics of each text, and line frequency across a host's documents.

Lines are normalised (surrounding space dropped, inner space runs made one, lower case) and hashed. For each host the
number of distinct texts that hold a line is counted; copies of one text count once. A line held by at least
``least_docs`` texts and at least ``share`` of the host's texts is above the limit and is removed; a document that
keeps less than ``remain`` of its words is depleted and rejected. Documents that fail the base rules are rejected too.

Only DataFrame functions are used. The counts are combined before they are shuffled, and the shuffle key holds the
text's hash, so neither a hot host nor a hot line meets in one task before it is summed. The lines above the limits
are broadcast only if there are BROADCAST_LINES of them at most; more are matched by a join on hashed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import fresh, let, materialize

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30
LEAST_DOCS = 20
SHARE = 0.05
REMAIN = 0.3
BROADCAST_LINES = 4096


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _starts(size: Column) -> Column:
    return F.when(size >= WINDOW, F.sequence(F.lit(1), size - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))


def _repeated(w: Column) -> Column:
    """Words inside windows found twice or more, by direct comparison of the windows' words."""
    cut = F.array_sort(F.transform(_starts(F.size(w)), lambda i: F.struct(F.array_join(F.slice(w, i, WINDOW), " ").alias("t"), i.alias("i"))))
    same = lambda s, x, j: F.coalesce(F.get(s, j)["t"] == x["t"], F.lit(False))
    twice = lambda s: F.array_sort(F.transform(F.filter(s, lambda x, j: same(s, x, j - 1) | same(s, x, j + 1)), lambda x: x["i"]))
    gap = lambda d: F.transform(d, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(d, j + 1) - x, F.lit(WINDOW))))
    return F.aggregate(let(let(cut, twice), gap), F.lit(0).cast("long"), lambda a, x: a + x)


def repeated_words(w: Column) -> Column:
    """As _repeated; windows are compared in full only in texts where two of their hashes are equal."""
    hashes = F.transform(_starts(F.size(w)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
    return let(hashes, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(_repeated(w)))


def lines(text: Column) -> Column:
    """The \\n-split lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def normalised(line: Column) -> Column:
    return F.lower(F.array_join(words(line), " "))


def line_hash(line: Column) -> Column:
    return F.xxhash64(normalised(line))


def statistics(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    of_words = lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).alias("n_repeat_words")
    )
    of_lines = let(lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    return let(
        F.struct(let(words(text), of_words).alias("w"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("s"), of_lines.alias("d")),
        lambda x: F.struct(
            x["w"]["n_words"].alias("n_words"), x["w"]["word_chars"].alias("word_chars"), x["s"].alias("n_symbols"), x["d"].alias("n_dup_lines"), x["w"]["n_repeat_words"].alias("n_repeat_words"),
            ((x["w"]["n_words"] < LEAST_WORDS) | (x["w"]["n_repeat_words"] * 100 > x["w"]["n_words"] * REPEAT_PERCENT)).alias("base_failed"),
        ),
    )


def _keyed(docs: DataFrame, text: str, host: str) -> DataFrame:
    """host (a null host is a host of its own), text hash, normalised line hashes of each document."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("null")).alias("host"),
        F.xxhash64(body).alias("text_hash"),
        F.transform(lines(body), line_hash).alias("hashes"),
    )


def _held(docs: DataFrame, text: str, host: str) -> DataFrame:
    """(host, line, text_hash) once each; line null stands for the document itself."""
    keyed = _keyed(docs, text, host)
    marks = F.concat(F.array_distinct("hashes"), F.array(F.lit(None).cast("long")))
    return keyed.select("host", "text_hash", F.explode(marks).alias("line")).distinct()


def frequent_lines(docs: DataFrame, text: str = "text", host: str = "source", least_docs: int = LEAST_DOCS, share: float = SHARE) -> DataFrame:
    """(host, line, n_docs, host_docs) of the lines above the limits; ``line`` is the normalised line's hash."""
    counts = _held(docs, text, host).groupBy("host", "line").agg(F.count("*").alias("n_docs"))
    hosts = counts.filter(F.col("line").isNull()).select("host", F.col("n_docs").alias("host_docs"))
    often = counts.filter(F.col("line").isNotNull() & (F.col("n_docs") >= least_docs))
    return often.join(hosts, "host").filter(F.col("n_docs") >= F.col("host_docs") * F.lit(share))


def _flagged(docs: DataFrame, text: str, host: str, often: DataFrame, out: str, broadcast_lines: int) -> DataFrame:
    """``docs`` with the array of line hashes to remove from each."""
    key, text_hash = fresh(docs, "_qr_host"), fresh(docs, "_qr_hash")
    body = F.coalesce(F.col(text), F.lit(""))
    docs = docs.withColumn(key, F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("null")))
    none = F.array().cast("array<bigint>")
    if often.limit(broadcast_lines + 1).count() <= broadcast_lines:
        by_host = often.groupBy(F.col("host").alias(key)).agg(F.collect_list("line").alias(out))
        return docs.join(F.broadcast(by_host), key, "left").withColumn(out, F.coalesce(out, none)).drop(key)
    salts = 16
    spread = often.select("host", "line", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    held = _held(docs, text, host).filter(F.col("line").isNotNull()).withColumn("salt", F.pmod("text_hash", F.lit(salts)).cast("int"))
    mine = held.join(spread, ["host", "line", "salt"], "left_semi").groupBy(F.col("host").alias(key), F.col("text_hash").alias(text_hash)).agg(F.collect_list("line").alias(out))
    return docs.withColumn(text_hash, F.xxhash64(body)).join(mine, [key, text_hash], "left").withColumn(out, F.coalesce(out, none)).drop(key, text_hash)


def judge(docs: DataFrame, text: str = "text", host: str = "source", least_docs: int = LEAST_DOCS, share: float = SHARE, remain: float = REMAIN, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """``docs`` with a struct column ``quality`` (a trailing underscore where the name is taken).

    Its fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words, kept,
    clean_text (the text without the removed lines; null for a null text). A null or empty text has no words and is
    rejected. Repeated rows are judged alike; copies of a text count once in a line's frequency. An empty table
    gives an empty result.
    """
    often = materialize(frequent_lines(docs, text, host, least_docs, share), "frequent-lines")
    flagged, out = fresh(docs, "_qr_flagged"), fresh(docs, "quality")
    body = F.coalesce(F.col(text), F.lit(""))
    docs = _flagged(docs, text, host, often, flagged, broadcast_lines)
    hit = lambda x, bad: F.array_contains(bad, line_hash(x))
    gone = lambda bad: F.aggregate(F.filter(lines(body), lambda x: hit(x, bad)), F.lit(0).cast("long"), lambda a, x: a + F.size(words(x)))
    left = lambda bad: F.array_join(F.filter(F.split(body, "\n"), lambda x: ~(x.rlike(r"[^\x20\x09-\x0D]") & hit(x, bad))), "\n")
    present = F.array_intersect(F.transform(lines(body), line_hash), F.col(flagged))
    removal = F.when(F.size(flagged) == 0, F.struct(F.lit(0).cast("long").alias("n"), F.col(text).alias("t"))).otherwise(
        let(present, lambda bad: F.when(F.size(bad) == 0, F.struct(F.lit(0).cast("long").alias("n"), F.col(text).alias("t"))).otherwise(F.struct(gone(bad).alias("n"), left(bad).alias("t"))))
    )
    verdict = lambda s, r: F.struct(
        *[s[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")],
        r["n"].alias("removed_words"), (~s["base_failed"] & (s["n_words"] - r["n"] >= s["n_words"] * F.lit(remain))).alias("kept"), r["t"].alias("clean_text"),
    )
    both = F.struct(statistics(F.col(text)).alias("s"), removal.alias("r"))
    # a generator's output: a filter on it is not turned into a second evaluation of the whole expression
    judged = F.explode(F.array(let(both, lambda x: verdict(x["s"], x["r"])))).alias(out)
    return docs.select("*", judged).drop(flagged)
