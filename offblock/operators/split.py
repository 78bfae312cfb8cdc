"""Time-ordered split (R35) without a global window.

``row_number().over(orderBy(t, id)) <= k`` puts every row in one task. Here the
k-th key in (t, id, ...) order is found exactly with ``kth_smallest`` (a few
bounded histogram aggregates), and the split is a plain filter on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offblock.constants import VALIDATION_SHARE
from offblock.operators.schema import q
from offblock.operators.select import kth_key

_LONG_MAX = (1 << 63) - 1


def _epoch():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def order_key(df: DataFrame, col: str) -> Column:
    """A long that orders like the column, missing last (as the reference's sort puts NaT last)."""
    dt = df.schema[col].dataType
    c = q(col)
    if isinstance(dt, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        c = F.timestamp_diff("MICROSECOND", _epoch(), c.cast("timestamp_ntz"))
    return F.coalesce(c.cast("long"), F.lit(_LONG_MAX))


def split_point(df: DataFrame, order_cols: list[str], share: float = VALIDATION_SHARE) -> tuple[int, int, list[int]]:
    """Return (n, k, key of the k-th row). The order columns must form a unique key."""
    n = df.count()
    k = int(n * (1 - share))
    if k <= 0:
        return n, k, []
    keys = [order_key(df, c) for c in order_cols]
    return n, k, kth_key(df, keys, k)


def _le(keys: list[Column], values: list[int]) -> Column:
    """Lexicographic ``keys <= values``."""
    cond = keys[-1] <= F.lit(values[-1])
    for key, v in zip(reversed(keys[:-1]), reversed(values[:-1]), strict=True):
        cond = (key < F.lit(v)) | ((key == F.lit(v)) & cond)
    return cond


def time_ordered_split(df: DataFrame, order_cols: list[str], share: float = VALIDATION_SHARE
                       ) -> tuple[DataFrame, DataFrame]:
    """The first ``int(n * (1 - share))`` rows in key order train; the rest validate."""
    _, k, values = split_point(df, order_cols, share)
    if k <= 0:
        return df.where(F.lit(False)), df
    keys = [order_key(df, c) for c in order_cols]
    cond = _le(keys, values)
    return df.where(cond), df.where(~cond)


def mark_split(df: DataFrame, order_cols: list[str], share: float = VALIDATION_SHARE, name: str = "is_train") -> DataFrame:
    """R35 as a column: ``is_train`` 1/0."""
    _, k, values = split_point(df, order_cols, share)
    if k <= 0:
        return df.withColumn(name, F.lit(0))
    keys = [order_key(df, c) for c in order_cols]
    return df.withColumn(name, _le(keys, values).cast("int"))
