"""Missing-value profile, exact medians and median fill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offblock.constants import HIGH_MISSING_COLUMNS
from offblock.operators.schema import drop_if_exists, q
from offblock.operators.select import exact_median

_NUMERIC = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.ShortType, T.ByteType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def missing_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row, ``<col>`` = number of missing values, for every column in one aggregate."""
    cols = cols or df.columns
    return df.agg(*[F.count_if(q(c).isNull()).alias(c) for c in cols])


def learn_medians(df: DataFrame, cols: list[str] | None = None, only_missing: bool = True) -> dict[str, float | None]:
    """Exact medians of numeric columns (those having missing values by default).

    Uses ``exact_median`` (histogram refinement), not ``percentile``/``median``,
    whose buffers hold every distinct value of a column in one task. The search
    reads its input a few times: pass a written table (or ``cut_lineage``), not
    a long lazy plan.
    """
    cols = cols if cols is not None else numeric_columns(df)
    if only_missing and cols:
        prof = missing_profile(df, cols).first()
        cols = [c for c in cols if prof[c] > 0]
    return exact_median(df, cols) if cols else {}


_INTEGRAL = (T.IntegerType, T.LongType, T.ShortType, T.ByteType)


def fill_with_median(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Fill numeric missing values from learned medians (a NULL median leaves the column as is).

    An integral column with missing values is a float column in the reference
    (missing forces float), so a non-integral median widens it to double
    instead of being truncated.
    """
    fills = {}
    for c, v in medians.items():
        if v is None or c not in df.columns:
            continue
        dt = df.schema[c].dataType
        if isinstance(dt, _INTEGRAL) and float(v) != int(v):
            fills[c] = F.coalesce(q(c).cast("double"), F.lit(float(v)))
        else:
            fills[c] = F.coalesce(q(c), F.lit(v).cast(dt))
    return df.withColumns(fills) if fills else df


def handle_missing(df: DataFrame, medians: dict[str, float | None] | None = None,
                   strict_train: bool = False, exclude: list[str] | None = None
                   ) -> tuple[DataFrame, dict[str, float | None]]:
    """Clean gold variant: drop the high-missing weather columns, then median-fill.

    Given ``medians`` (from training), columns with missing values use them; a
    column first seen missing here uses this set's own median, which is then
    stored — as the reference does (trap 13). ``strict_train=True`` instead
    leaves such a column unfilled.
    """
    df = drop_if_exists(df, HIGH_MISSING_COLUMNS)
    medians = dict(medians or {})
    skip = set(exclude or [])
    cols = [c for c in numeric_columns(df) if c not in skip]
    if not cols:
        return df, medians
    # one aggregate: missing count, valid count, min and max per column (the
    # median search starts from these, so it needs no stats pass of its own)
    # (NaN never occurs: missing is NULL throughout, see trap 9)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        x = q(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    prof = df.agg(*aggs).first()
    missing = [c for i, c in enumerate(cols) if prof[f"n{i}"] < prof["__rows"]]
    stats = {c: (prof[f"n{i}"], prof[f"lo{i}"], prof[f"hi{i}"]) for i, c in enumerate(cols)}
    new = [c for c in missing if c not in medians]
    if new and not (strict_train and medians):
        medians.update(exact_median(df, new, {c: stats[c] for c in new}))
    return fill_with_median(df, {c: medians.get(c) for c in missing}), medians
