"""Row filters and flag columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offblock.constants import (
    AIRCRAFT_MODEL, FLIGHT_NUMBER, HELICOPTER, PRIVATE_FLIGHT, TAXI_MAX_EXCLUSIVE, TAXI_MIN_EXCLUSIVE, TARGET,
)
from offblock.functions.text import flag_helicopter, flag_private
from offblock.operators.schema import q


def taxi_in_range(col: str = TARGET) -> Column:
    c = q(col)
    return (c > F.lit(TAXI_MIN_EXCLUSIVE)) & (c < F.lit(TAXI_MAX_EXCLUSIVE))


def filter_taxi_range(df: DataFrame, col: str = TARGET) -> DataFrame:
    """Keep 0 < taxi < 7200 (NULL drops). Catalyst pushes it below the left joins."""
    return df.where(taxi_in_range(col))


def filter_audit(df: DataFrame, col: str = TARGET) -> DataFrame:
    """Rows before and after the taxi filter, in one aggregate (one row)."""
    return df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(taxi_in_range(col)).alias("rows_after"))


def add_private_flag(df: DataFrame, col: str = FLIGHT_NUMBER, drop: bool = True) -> DataFrame:
    """``private_flight`` from the flight-number prefix, then drop the flight number."""
    out = df.withColumn(PRIVATE_FLIGHT, flag_private(q(col)))
    return out.drop(col) if drop else out


def add_helicopter_flag(df: DataFrame, col: str = AIRCRAFT_MODEL) -> DataFrame:
    """``helicopter`` from the aircraft model."""
    return df.withColumn(HELICOPTER, flag_helicopter(q(col)))
