"""The registered queries of the training-data operators: each applies its operator to whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, jaccard_join, language_id, packing, quality_model, quality_rules, secrets, sharding, suffix_dedup, token_counts
from ._util import table

LANG_HELD_OUT = 1


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == LANG_HELD_OUT


VOCABULARY = os.environ.get("TILEWRIGHT_VOCABULARY", "/opt/tokenizers/piece_bpe_32k.model")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.size(quality_rules.words(body)).cast("long").alias("n_words"))
    return packing.pack(docs, "n_words", ["doc_id", "n_words"])


def op2_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32")
    )
    content = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size").cast("string"), F.col("text_crc32").cast("string"))
    out = sharding.shard(docs, 8, seed=17, content=content)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op3_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")
    return quality_rules.judge(docs).select("doc_id", *[F.col(f"quality.{f}") for f in fields])


def op4_secret_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_documents(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_layers")


def op5_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), VOCABULARY, ["doc_id"])


def op7_rule_ensemble_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    learn = ~held_out(F.col("doc_id"))
    sample = quality_model.training_sample(docs, table(spark, sf_dir, "labels").filter(learn), "doc_id", "text", "quality")
    return quality_model.score(docs, quality_model.fit(*sample), ["doc_id", "held_out"])


def op8_deep_shallow_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.occurrences(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    n_hit = decontamination.covered_words("starts", "ends")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("starts") > 0).alias("contaminated"),
    )


def op10_ecoc_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    model = language_id.fit(*language_id.training_sample(docs.filter(~F.col("held_out")), "doc_id", "text", "lang"))
    return language_id.identify(docs, model, ["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_feistel_sharding": op2_feistel_sharding,
    "op3_line_frequency_rules": op3_line_frequency_rules,
    "op4_secret_worklist": op4_secret_worklist,
    "op5_signature_tree_join": op5_signature_tree_join,
    "op6_trie_token_counts": op6_trie_token_counts,
    "op7_rule_ensemble_quality": op7_rule_ensemble_quality,
    "op8_deep_shallow_repeats": op8_deep_shallow_repeats,
    "op9_wu_manber_decontamination": op9_wu_manber_decontamination,
    "op10_ecoc_language_id": op10_ecoc_language_id,
}
