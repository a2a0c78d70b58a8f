"""A training corpus from the documents table: five stages, each of them one operator's decisions carried out.

Every stage takes what its predecessor kept, written as Parquet and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlake.llm import bpe, mixing, pii, rules, simhash
from turnlake.llm.common import discard, materialize, table, word_array

#: Not all stages can be put in SQL (trained span classifier, tokenizer); tests hold them against brute-force versions.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with their own columns. Null and empty texts have no words, and go; rows are judged one by one,
    so repeated ones stay or go together; an empty table stays empty."""
    return rules.keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the least id, null last. Rows are told apart by their place and not by their
    ids, so rows of one id, or of none, whose texts differ stay; equal rows, and all texts without words, are one group each."""
    return simhash.keep_one(docs)


def _with_length(docs: DataFrame, like: DataFrame) -> DataFrame:
    """The table with ``n_chars`` as its texts now are; a table without that column gets none."""
    if "n_chars" not in like.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts masked. Null texts stay null, and so do their lengths; repeated rows stay."""
    return _with_length(pii.redact(docs), docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once for each time their words are taken; a document cut by a source's end keeps the words taken.

    Rows are told apart by their place: each takes what the mix gives it, whatever others share its id or its text. Texts without words have
    nothing to take, and go. Null sources are one source, null ids are allowed, and an empty table stays empty.
    """
    whole = F.struct(*[docs[c] for c in docs.columns])
    rows = materialize(docs.select(whole.alias("row"), F.monotonically_increasing_id().alias("at")), "rows")
    plan = mixing.mix(rows.select("row.doc_id", "row.text", "row.source", "at"), carry=("at",))
    runs = plan.pieces.groupBy("src", "start", "epoch").agg(F.min("from").alias("begin"), F.max("to").alias("stop"))
    names = plan.placed.where("size > 0").select("src", "start", "size", F.col("carry_at").alias("at"))
    taken = runs.join(names, ["src", "start"]).select("at", "begin", "stop", "size")
    words = F.col("stop") - F.col("begin")
    part = F.array_join(F.slice(word_array("row.text"), (F.col("begin") + 1).cast("int"), words.cast("int")), " ")
    text = F.when(words == F.col("size"), F.col("row.text")).otherwise(part)
    out = rows.join(taken, "at").select(F.col("row").withField("text", text).alias("row")).select("row.*")
    return _with_length(out, docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, packed as in a token file. Null and empty texts have none; repeated rows and null ids stay."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_dedup),
    ("personal data", pii_redaction),
    ("source mixing", source_mixing),
    ("byte-level bpe", bpe_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name.replace(" ", "-"))
            if written is not None:
                discard(written)
            written = docs
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
