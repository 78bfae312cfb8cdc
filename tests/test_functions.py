"""Edge tables of FIXTURES.md §4 for the column functions."""

import math

import pytest
from pyspark.sql import functions as F

from offblock.functions import (
    bump_id, digits_to_int, flag_helicopter, flag_private, format_mdy_hm, log_distance, parse_mdy_hm,
    round_half_even, seconds_to_minutes, standardize_datetime_text, text_or_nan,
)


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")


def run(spark, values, expr, typ="string"):
    rows = one_col(spark, values, typ).select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in rows]


def test_parse_mdy_hm_accepts_and_rejects(spark):
    good = ["1/1/2015 6:05", "01/01/2015 06:05", "1/1/2015 6:5", "3/29/2015 2:30"]
    bad = ["13/1/2015 6:05", "2/30/2015 6:05", "1/1/2015 6:05:30", "1/1/15 6:05", " 1/1/2015 6:05", "nan", None]
    out = run(spark, good + bad, parse_mdy_hm)
    assert [str(x) for x in out[:4]] == ["2015-01-01 06:05:00", "2015-01-01 06:05:00", "2015-01-01 06:05:00",
                                         "2015-03-29 02:30:00"]
    assert out[4:] == [None] * len(bad)


def test_parse_is_zone_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
        assert str(run(spark, ["3/29/2015 2:30"], parse_mdy_hm)[0]) == "2015-03-29 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_ntz_helpers_are_zone_independent(spark):
    from offblock.functions import format_hh_mm, format_mdy_hm, truncate_to_second

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([("2024-03-10 02:30:15.5",), ("1969-12-31 23:59:59.25",)], "s string")
        out = df.select(truncate_to_second(F.col("s").cast("timestamp_ntz")).alias("t")).select(
            F.col("t").cast("string").alias("t"), format_mdy_hm("t").alias("f"), format_hh_mm("t").alias("h")).collect()
        assert [(r["t"], r["f"], r["h"]) for r in out] == [("2024-03-10 02:30:15", "3/10/2024 2:30", "02:30"),
                                                          ("1969-12-31 23:59:59", "12/31/1969 23:59", "23:59")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_standardize_datetime_text(spark):
    out = run(spark, ["2019-12-31 20:30:59", "bad", "1/2/2019 3:04"], standardize_datetime_text)
    assert out == ["12/31/2019 20:30", None, "1/2/2019 3:04"]
    assert run(spark, [None], lambda c: text_or_nan(standardize_datetime_text(c))) == ["nan"]


def test_format_mdy_hm(spark):
    df = spark.createDataFrame([("2019-01-05 07:08:09",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
    assert df.select(format_mdy_hm("t")).first()[0] == "1/5/2019 7:08"


def test_bump_id(spark):
    out = run(spark, ["Runway_0", "Stand_007x", "nan", "A_B_0", "stand_19"], bump_id)
    assert out == ["RUNWAY_1", "STAND_8", "nan", "A_B_0", "STAND_20"]


def test_flag_private(spark):
    out = run(spark, ["NJE1", "njE", "SIGX", "SI9", "PVT", None, "BAW12", "VJT"], flag_private)
    assert out == [1, 0, 1, 0, 1, 0, 0, 1]


def test_flag_helicopter(spark):
    out = run(spark, ["A109", "a109", "AS 350 ECUREUIL (SQUIRREL)", None, "A320"], flag_helicopter)
    assert out == [1, 0, 1, 0, 0]


def test_digits_to_int(spark):
    assert run(spark, ["STAND_62", "RUNWAY_3", "x12y7"], lambda c: digits_to_int(c, strict=False)) == [62, 3, 12]
    assert run(spark, ["nan"], lambda c: digits_to_int(c, strict=False)) == [None]
    with pytest.raises(Exception):
        run(spark, ["nan"], lambda c: digits_to_int(c, strict=True))


def test_log_distance_zero_is_minus_inf(spark):
    out = run(spark, [0.0, math.e], log_distance, "double")
    assert out[0] == float("-inf") and abs(out[1] - 1.0) < 1e-12


def test_round_half_even(spark):
    assert run(spark, [0.25, 2.5, -0.25], lambda c: round_half_even(c, 1), "double") == [0.2, 2.5, -0.2]
    assert run(spark, [90.0, 125.0], seconds_to_minutes, "double") == [1.5, 2.1]
