"""Row ids that depend on the rows alone, not on how they are partitioned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offblock.operators.schema import q

#: Copies of one row that are numbered at a time, so that no array grows with them.
BLOCK = 65_536


def numbered_copies(df: DataFrame, name: str) -> DataFrame:
    """df with the number (long, from 0) of each row among the rows equal to it.

    Equal rows are counted (with map-side combine), then written out again; which
    of them gets which number makes no difference.
    """
    counted = df.groupBy(*[q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    zero = F.lit(0).cast("long")
    blocks = counted.withColumn("__block", F.explode(F.sequence(zero, F.floor((F.col("__n") - 1) / BLOCK))))
    size = F.least(F.lit(BLOCK).cast("long"), F.col("__n") - F.col("__block") * BLOCK)
    rows = blocks.withColumn("__at", F.explode(F.sequence(zero, size - 1)))
    return rows.select(*[q(c) for c in df.columns], (F.col("__block") * BLOCK + F.col("__at")).alias(name))


def content_ids(df: DataFrame, name: str) -> DataFrame:
    """df with a 64-bit hash of the row and its number among its copies."""
    rows = numbered_copies(df, "__copy")
    return rows.select(*[q(c) for c in df.columns], F.xxhash64(F.to_json(F.struct(*[q(c) for c in rows.columns]))).alias(name))
