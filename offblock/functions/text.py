"""Text expressions: ids, flags, text casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offblock.constants import HELICOPTER_MODELS, PRIVATE_CODES, PRIVATE_PREFIX_PATTERN

_ID_PATTERN = r"^([A-Za-z]+)_([0-9]+)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_nan(c: Column | str) -> Column:
    """Value as text, missing -> the literal ``'nan'``."""
    return F.coalesce(_col(c).cast("string"), F.lit("nan"))


def bump_id(c: Column | str) -> Column:
    """``Runway_0`` -> ``RUNWAY_1``.

    Leading ``letters_digits`` (anchored at the start, any tail dropped), letters
    upper-cased, number + 1 without leading zeros; no match -> unchanged.
    """
    c = _col(c)
    letters = F.regexp_extract(c, _ID_PATTERN, 1)
    number = F.regexp_extract(c, _ID_PATTERN, 2).try_cast("decimal(38,0)") + F.lit(1)
    bumped = F.concat(F.upper(letters), F.lit("_"), number.cast("string"))
    return F.when(c.rlike(_ID_PATTERN) & number.isNotNull(), bumped).otherwise(c)


def digits_to_int(c: Column | str, strict: bool = True) -> Column:
    """First run of digits as int (``STAND_62`` -> 62).

    ``strict`` raises at run time on a value without digits (the reference's
    int cast fails there); otherwise such values become NULL.
    """
    c = _col(c)
    value = F.nullif(F.regexp_extract(c, r"([0-9]+)", 1), F.lit("")).try_cast("int")
    if not strict:
        return value
    return F.when(value.isNull(), F.raise_error(F.concat(F.lit("no digits in id: "), text_or_nan(c)))).otherwise(value)


def compose_id(prefix: str, c: Column | str) -> Column:
    """``STAND_`` + integer part."""
    return F.concat(F.lit(prefix), _col(c).cast("int").cast("string"))


def flag_private(c: Column | str) -> Column:
    """1 when the 2-3 capital-letter prefix is a private operator code."""
    prefix = F.regexp_extract(_col(c), PRIVATE_PREFIX_PATTERN, 1)
    return F.coalesce(prefix.isin(PRIVATE_CODES), F.lit(False)).cast("int")


def flag_helicopter(c: Column | str) -> Column:
    """1 when the aircraft model is one of the helicopter names."""
    return F.coalesce(_col(c).isin(HELICOPTER_MODELS), F.lit(False)).cast("int")


def trim_text(c: Column | str) -> Column:
    """Strip surrounding spaces."""
    return F.trim(_col(c))
