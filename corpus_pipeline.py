"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result
as Parquet in the shared folder and reads it as the next stage's ``docs``. All stages but
the last return the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clickflow.llm import line_dedup, mixing, near_dup, pieces, quality
from clickflow.llm.common import saved, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; short ones are judged by what they hold, not by
    their length, as most of them are clean."""
    return quality.keep_good(docs, judge_short=True)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that match an earlier line; complete copies go."""
    return line_dedup.without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (Jaccard 0.8 on five-word shingles)."""
    return near_dup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each as often as the mix takes it."""
    return mixing.mix_sources(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document of the mix, as digests."""
    return pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup_stage), ("near_duplicates", near_duplicates),
          ("mix_sources", mix_sources), ("sentencepiece", sentencepiece)]

#: SQL cannot express the encoder; ``tests/llm/test_pipeline.py`` holds the whole run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
