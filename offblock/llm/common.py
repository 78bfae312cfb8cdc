"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offblock.session import scratch_path

#: Blank characters of the contracts: U+0020 and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """df, written once to the shared checkpoint folder and read back.

    Cuts the lineage with a table that survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: str, folds: int) -> Column:
    """Whether crc32 of the id as text leaves remainder 2; a missing id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 2, F.lit(False))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_ids(df: DataFrame, name: str) -> DataFrame:
    """df with a key of its own for each row, repeated rows included."""
    return df.withColumn(name, F.monotonically_increasing_id())


#: A side of at most so many rows of a few numbers is broadcast, after it is counted.
BROADCAST_ROWS = 200_000


def semi(big: DataFrame, small: DataFrame, column: str) -> DataFrame:
    """Rows of big whose column is in small (null meets null), without a shuffle of big if small is small.

    small is counted; beyond BROADCAST_ROWS the join is left to Spark.
    """
    small = written(small.select(F.col(column).alias("_k")).distinct(), "ids")
    if small.count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    return big.join(small, big[column].eqNullSafe(small["_k"]), "left_semi")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand documents to Python in batches of at most so many rows, so that a task's memory stays small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def larger(batches, rows: int = 16_384):
    """The rows of batches in batches of about so many, for rows that are short, as documents are not."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most so many rows for the Python jobs that are run inside; the caller's setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)
