"""Corpus pipeline: language ID, line dedup, n-gram Jaccard join, best-fit packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the next stage's docs. All stages but the last return the
columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from offblock.llm.jaccard import keep_one_each
from offblock.llm.language_id import keep_identified
from offblock.llm.line_dedup import dedup_lines
from offblock.llm.packing import pack_documents
from offblock.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in which no language holds half of the words, go."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines within two edits of each other the first stays; documents without a line left go."""
    return dedup_lines(docs)


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.75 or more the one with the smallest id stays."""
    return keep_one_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document in the packed sequences."""
    return pack_documents(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("jaccard", jaccard), ("packing", packing)]

#: No SQL for a fitted model and edit distances; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what the one before has written to the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, f"corpus-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
