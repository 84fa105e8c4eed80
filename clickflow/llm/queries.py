"""The registered queries of the operators, each over its whole table, with oracle SQL.

Each query applies its operator with production parameters and derives the digest columns
of the result from the operator's own output."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from clickflow.llm import (
    chat, lexical, licenses, line_dedup, mixing, near_dup, pieces, quality, substrings, token_counts, topk, toxicity, whitening)
from clickflow.llm.common import table
from clickflow.llm.sql import SQL


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best rows of all embeddings for each row whose vec_id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed to the weights 3, 1, 2 with 150% of the words."""
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document, from the labelled sample."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, encoded and decoded with the 32k merge-type vocabulary."""
    return pieces.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents with the 50k byte-level vocabulary."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the JSON record -1, formatted and read back."""
    turns = chat.canonical(table(spark, sf_dir, "conversations"))
    said = "<|im_end|><|im_start|>assistant ok"
    messages = [{"role": r, "content": said} for r in ("user", "assistant")]
    record = spark.sql("SELECT * FROM VALUES (:record) AS t(json)", args={"record": json.dumps({"messages": messages})})
    extra = chat.record_layouts(record, "json").select(F.lit(-1).cast("long").alias("conv_id"), "layout", "turns")
    return chat.digests(chat.format_turns(turns.unionByName(extra)))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    judged = quality.quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality.MEASURES, "base_failed", "kept")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents (Jaccard 0.85 on five-word shingles)."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), 85, 100)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, filed as source/lang/doc_id by thousands."""
    docs = table(spark, sf_dir, "documents")
    part = lambda c: F.coalesce(c.cast("string"), F.lit("none"))
    path = F.concat_ws("/", part(F.col("source")), part(F.col("lang")), part(F.floor(F.col("doc_id") / 1000)),
                       F.concat(part(F.col("doc_id")), F.lit(".txt")))
    files = docs.select(F.col("doc_id").alias("key"), path.alias("path"), "text")
    return licenses.licences(files).withColumnRenamed("key", "doc_id")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that match an earlier one (Jaccard 0.8 on shingles)."""
    made = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), 80, 100)
    text = F.coalesce("_text", F.lit(""))
    return made.select(F.col("_row.doc_id").alias("doc_id"), F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"),
                       F.length(text).cast("long").alias("n_chars_left"), F.sha2(text, 256).alias("text_sha256"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of repeated windows of 35 words."""
    made = substrings.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return made.select(F.col("_row.doc_id").alias("doc_id"), "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all documents for every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the four strongest whitening directions of all embeddings."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), count=4)


QUERIES = {f.__name__: f for f in (
    op1_top_k, op2_mix_sources, op3_toxicity, op4_sentencepiece, op5_token_counts, op6_chat_format, op7_quality_rules,
    op8_near_duplicates, op9_licenses, op10_line_dedup, op11_substring_dedup, op12_lexical_search, op13_whitening)}
ORACLE_SQL = {k: SQL[k] for k in QUERIES if k in SQL}
