"""A training corpus from ``documents``, stage by stage; each stage is written as Parquet and read again.

Stages get ``(spark, docs, sf_dir)`` and work on all that their predecessor kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from hazardloom.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from hazardloom.llm.common import load, shared_dir
from hazardloom.llm.queries import fit_toxicity, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's threshold of toxicity; null and empty texts are scored like others."""
    return toxicity.reject_toxic(docs, fit_toxicity(spark, docs, sf_dir))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space the longest, then that of the smallest id; a repeated row once."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents that of the smallest id; documents without words or id stay."""
    return ngram_join.drop_similar(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget takes them whole; ties go by id and text. An empty table stays empty."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents' token ids in sequences; null texts are their end token alone."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("exact_dedup", deduplicate), ("ngram_join", drop_near_copies), ("mixing", mix), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the whole ``documents`` table."""
    docs, folder = load(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
