"""Corpus pipeline: documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and returns a DataFrame, which is written as Parquet below
``spark.checkpoint.dir`` and reread as the next stage's ``docs``.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import harmonic, importance, multimatch, trie_dedup
from tidemark.llm.common import rows_of, staged, table
from tidemark.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling rejects go: junk and toxic texts, by the labels it learns from."""
    return importance.select_documents(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to the case of A-Z, the document with the largest doc_id stays."""
    return rows_of(docs, trie_dedup.trie_dedup(docs).where("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by links of 0.75 or more on five-word shingles, the one with the smallest doc_id stays."""
    groups = multimatch.jaccard_components(docs)
    return rows_of(docs, groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return harmonic.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("packing", packing)]

#: the trained classifier of the first stage and the tokenizer of the last have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
