"""A corpus pipeline of five stages: quality rules, near duplicates, benchmark decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows as Parquet into the
shared folder and reads them back as the next stage's documents. All but the last return the columns of ``documents``.
A table without rows passes through every stage. Extra columns of documents pass through the first four. Nulls in columns other
than doc_id and text never matter, but for source: rows without one are a host of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import decontamination, jaccard_join, packing, quality_rules, secrets
from tilewright.llm._util import fresh, materialize, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines above their host's limits.

    A null or empty text has too few words and goes. A null doc_id is kept like any other; repeated rows are judged alike.
    """
    verdict = fresh(docs, "quality")
    judged = quality_rules.judge(docs)
    clean = F.col(f"{verdict}.clean_text")
    changed = F.col(f"{verdict}.removed_words") > 0
    out = judged.filter(F.col(f"{verdict}.kept")).withColumn("text", F.when(changed, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of least doc_id.

    Null doc_ids come last, and rows equal in doc_id and text are one. Null and empty texts are near nothing and stay.
    """
    return jaccard_join.keep_first(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark. Null and empty texts hold none; an empty benchmark takes nothing out."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by a mark. Null and empty texts stay as they are."""
    out = secrets.redact_documents(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's place in bins of several permitted sizes, counted in words. A text without words has no bin."""
    n_words = F.size(quality_rules.words(F.coalesce(F.col("text"), F.lit("")))).cast("long")
    return packing.pack(docs.select("doc_id", n_words.alias("n_words")), "n_words", ["doc_id", "n_words"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]

#: Signature trees, the decoding worklist and the bins have no SQL form; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
