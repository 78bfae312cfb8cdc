"""Numeric display expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(c: Column, digits: int = 1) -> Column:
    """banker's rounding (``F.round`` is half-up)."""
    return F.bround(c, digits)


def seconds_to_minutes(c: Column, digits: int = 1) -> Column:
    """Seconds / 60, rounded half-even."""
    return F.bround(c.cast("double") / F.lit(60.0), digits)


def impact_direction(c: Column) -> Column:
    """``up`` when the impact is positive, else ``down``."""
    return F.when(c > 0, F.lit("up")).otherwise(F.lit("down"))


def impact_tone(c: Column) -> Column:
    """``good`` when the impact shortens taxi time (negative), else ``bad``."""
    return F.when(c < 0, F.lit("good")).otherwise(F.lit("bad"))
