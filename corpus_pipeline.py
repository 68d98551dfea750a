"""From raw documents to token ids: five stages, each over all that the one before kept.

``run`` writes what a stage returns as Parquet to the folder that all executors share and
reads it again, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starfold.llm import decontam, jaccard_join, mixing, quality, token_blocks
from starfold.llm.common import stored, table

#: Words that a Python worker of the last stage may remember. Executors still hold what the
#: stages before it took, so it has less room than op5 alone.
REMEMBERED = 100_000


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects: junk, insults, and those without words."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least doc_id of each group of near copies."""
    return jaccard_join.keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold three quarters of the shingles of a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the schedule of target weights does."""
    return mixing.mix_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token ids as packed blocks; returns where each document lies in them."""
    return token_blocks.token_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), REMEMBERED)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: The trained scorer of the first stage has no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
