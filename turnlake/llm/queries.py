"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlake.llm import bpe, html, lm, mixing, negatives, oracles, phrases, pii, quality, rules, simhash, urls, vectors, wordbpe
from turnlake.llm.common import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rules.quality_rules(table(spark, sf_dir, "documents")).select("doc_id", *names)


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents")).taken()
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = pii.find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    line = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return spans.select("doc_id", *counts, F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = wordbpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors, F.col("vec_id") % 50 == 0, label)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_quality_classifier, op2_html_text, op3_byte_bpe, op4_lm_scores, op5_quality_rules,
        op6_embedding_dedup, op7_url_filter, op8_source_mix, op9_simhash, op10_personal_data,
        op11_phrases, op12_word_bpe, op13_hard_negatives,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return oracles.ORACLES
