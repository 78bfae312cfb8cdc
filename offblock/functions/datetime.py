"""Datetime expressions. Everything is TIMESTAMP_NTZ: no session zone, no DST shifts."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_MDY_HM = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4}) ([0-9]{1,2}):([0-9]{1,2})$"


def _epoch():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_mdy_hm(c: Column | str) -> Column:
    """Strict ``%m/%d/%Y %H:%M`` (unpadded fields accepted); bad -> NULL.

    The text is checked by pattern, rebuilt as ISO and cast with ``try_cast``,
    which rejects impossible dates and hours (Feb 30, month 13, hour 24).
    """
    c = _col(c)

    def part(i: int, width: int) -> Column:
        return F.lpad(F.regexp_extract(c, _MDY_HM, i), width, "0")

    iso = F.concat(part(3, 4), F.lit("-"), part(1, 2), F.lit("-"), part(2, 2), F.lit(" "),
                   part(4, 2), F.lit(":"), part(5, 2), F.lit(":00"))
    return F.when(c.rlike(_MDY_HM), iso.try_cast("timestamp_ntz"))


def parse_iso_datetime(c: Column | str) -> Column:
    """ISO ``YYYY-MM-DD HH:MM[:SS]`` text -> TIMESTAMP_NTZ; bad -> NULL."""
    return _col(c).try_cast("timestamp_ntz")


def _year4(t: Column) -> Column:
    y = F.year(t).cast("string")
    return F.when(F.length(y) < 4, F.lpad(y, 4, "0")).otherwise(y)


def format_mdy_hm(ts: Column | str) -> Column:
    """``M/D/YYYY H:MM`` text (no leading zeros on month, day, hour).

    Built from the TIMESTAMP_NTZ fields: ``date_format`` goes through the
    session zone and would print a DST-gap time an hour later.
    """
    t = _col(ts)
    return F.concat(F.month(t).cast("string"), F.lit("/"), F.dayofmonth(t).cast("string"), F.lit("/"), _year4(t),
                    F.lit(" "), F.hour(t).cast("string"), F.lit(":"), F.lpad(F.minute(t).cast("string"), 2, "0"))


#: English month names; their first three letters decide.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_NAME = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
#: Time of day, if any: H or H:MM, seconds and their fraction, AM or PM, zone or offset (read, not applied).
_TIME = r"(?:(?:t| +|, +)(\d{1,2})(?::(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?)? *([ap]m)?(?: *(?:z|utc|gmt|[+-]\d{2}:?\d{2}))?)?$"
#: Orders of a date: pattern with its three parts, and which of them are year, month and day.
_DATES = [
    (rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}}){_TIME}", "ymd"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}}){_TIME}", "ymd"),
    (rf"^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}}|\d{{2}}){_TIME}", "mdy"),
    (rf"^(\d{{1,2}})(?:st|nd|rd|th)?[- ]({_NAME})[-, ]+(\d{{4}}|\d{{2}}){_TIME}", "dmy"),
    (rf"^({_NAME})\.? +(\d{{1,2}})(?:st|nd|rd|th)?,? +(\d{{4}}){_TIME}", "mdy"),
    (rf"^(\d{{4}})[- ]({_NAME})[- ](\d{{1,2}}){_TIME}", "ymd"),
]
_WEEKDAY = r"^(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?,? +"


def parse_lenient(c: Column | str) -> Column:
    """Text in one of many forms -> TIMESTAMP_NTZ; what fits none, or is no real time, -> NULL.

    Numbers come as year first, or month first; where the first cannot be a
    month, day first. Two-digit years are 1969 to 2068. Names of months and
    weekdays are English, in any case. A zone or offset is read over: the time
    stays what the text says. Without a time of day it is midnight. Patterns and
    casts only, so it runs inside the scan's stage.
    """
    t = F.regexp_replace(F.lower(F.trim(_col(c))), _WEEKDAY, "")
    for pattern, order in _DATES:  # one order of fields for all: no pattern fits what another has rewritten
        group = {k: i + 1 for i, k in enumerate(order)}
        t = F.regexp_replace(t, pattern, f"={order},${group['y']},${group['m']},${group['d']},$4,$5,$6,$7,$8")
    return _once(t, lambda x: F.when(x.startswith("="), _once(F.split(x, ","), _assembled)))


def _once(value: Column, f) -> Column:
    """f(value) with value computed once a row, however often f uses it, and out of the generated method."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _assembled(fields: Column) -> Column:
    """The time of [=order, year, month, day, hour, minute, second, fraction, am/pm] as text; NULL if it is none."""
    order, year, month, day, hour, minute, second, fraction, half = (F.get(fields, F.lit(i)) for i in range(9))
    number = lambda x: x.try_cast("int")
    names = F.create_map(*[x for i, m in enumerate(MONTHS) for x in (F.lit(m), F.lit(i + 1))])
    month_no, day_no = F.coalesce(number(month), F.try_element_at(names, F.substring(month, 1, 3))), number(day)
    swap = (order == "=mdy") & (month_no > 12)
    year_no = number(year) + F.when(F.length(year) > 2, 0).when(number(year) < 69, 2000).otherwise(1900)
    hour_no = (F.when(hour == "", F.lit(0)).when(half == "", number(hour))
               .when(number(hour).between(1, 12), number(hour) % 12 + F.when(half == "pm", 12).otherwise(0)))
    text = F.format_string("%04d-%02d-%02d %02d:%s:%s.%s", year_no, F.when(swap, day_no).otherwise(month_no), F.when(swap, month_no).otherwise(day_no), hour_no,
                           F.lpad(minute, 2, "0"), F.lpad(second, 2, "0"), F.rpad(F.substring(fraction, 1, 6), 6, "0"))
    known = year_no.isNotNull() & month_no.isNotNull() & day_no.isNotNull() & hour_no.isNotNull()
    return F.when(known, text.try_cast("timestamp_ntz"))


def standardize_datetime_text(c: Column | str) -> Column:
    """Lenient parse (M/D/YYYY H:MM, ISO, then ``parse_lenient``), then ``M/D/YYYY H:MM``; bad -> NULL."""
    c = _col(c)
    return _once(c, lambda x: _once(F.coalesce(parse_mdy_hm(x), F.trim(x).try_cast("timestamp_ntz"), parse_lenient(x)), format_mdy_hm))


def truncate_to_second(ts: Column | str) -> Column:
    """Drop fractional seconds of a TIMESTAMP_NTZ without passing through the session zone
    (``date_trunc`` returns a zoned TIMESTAMP, which moves times inside a DST gap)."""
    t = _col(ts)
    frac_us = F.pmod(F.timestamp_diff("MICROSECOND", _epoch(), t), F.lit(1_000_000))
    return t - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (frac_us / F.lit(1_000_000)).cast("decimal(18,6)"))


def format_hh_mm(ts: Column | str) -> Column:
    """Departure time as ``HH:MM`` (from the NTZ fields, zone-free)."""
    t = _col(ts)
    return F.concat(F.lpad(F.hour(t).cast("string"), 2, "0"), F.lit(":"), F.lpad(F.minute(t).cast("string"), 2, "0"))


def delay_seconds(aobt: Column | str, scheduled: Column | str) -> Column:
    """Off-block minus scheduled, seconds as double (exact to the microsecond)."""
    return F.timestamp_diff("MICROSECOND", _col(scheduled), _col(aobt)).cast("double") / F.lit(1e6)


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 (zone independent)."""
    return F.timestamp_diff("SECOND", _epoch(), _col(ts))


def cyclical_pair(x: Column, period: int) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*x/period."""
    angle = F.lit(2 * math.pi) * x / F.lit(float(period))
    return F.sin(angle), F.cos(angle)
