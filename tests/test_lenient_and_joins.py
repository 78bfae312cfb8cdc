"""Lenient datetimes, salted weather join, traffic without times, CSV splits, silver tables."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from offblock.functions.datetime import parse_lenient, standardize_datetime_text
from offblock.operators import joins
from offblock.operators.traffic import planes_in_window
from offblock.plans.silver import SILVER_TABLES, build_silver
from offblock.sources.files import has_quoted_breaks, scan_csv

FORMS = {
    "2024-03-04 05:06:07": "2024-03-04 05:06:07", "2024/3/4": "2024-03-04 00:00:00", "20240304T0506": None, "20240304 05:06": "2024-03-04 05:06:00",
    "2024-03-04T05:06:07.123456Z": "2024-03-04 05:06:07.123456", "2024-03-04T05:06:07+02:00": "2024-03-04 05:06:07", "3/4/2024 5:06 PM": "2024-03-04 17:06:00",
    "25/4/2024 5:06": "2024-04-25 05:06:00", "3/4/69": "1969-03-04 00:00:00", "3/4/68 12:00 am": "2068-03-04 00:00:00", "4 Mar 2024": "2024-03-04 00:00:00",
    "4th March 2024, 5:06": "2024-03-04 05:06:00", "Monday, March 4, 2024 12:06 PM": "2024-03-04 12:06:00", "MAR 4 2024 5 am": "2024-03-04 05:00:00",
    "04-Mar-24 05:06:07,5": "2024-03-04 05:06:07.5", " 2024-Mar-04 ": "2024-03-04 00:00:00", "sept 9 2024": "2024-09-09 00:00:00",
    "29 Feb 2023": None, "2024-13-01": None, "31/31/2024": None, "3/4/2024 13:00 PM": None, "3/4/2024 0:30 am": None, "4 Smarch 2024": None, "tomorrow": None, "": None, "nan": None,
}


def test_lenient_forms(spark):
    df = spark.createDataFrame([(k,) for k in FORMS] + [(None,)], "s string")
    got = {r["s"]: r["t"] for r in df.select("s", parse_lenient("s").cast("string").alias("t")).collect()}
    assert {k: v for k, v in got.items() if k is not None} == FORMS and got[None] is None
    plan = df.select(standardize_datetime_text("s"))._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_weather_join_salts_heavy_keys(spark):
    r = random.Random(2)
    left = [(i, *(("nan",) * 2 if i % 2 else (str(r.randrange(40)), str(r.randrange(3))))) for i in range(2000)]
    right = [("nan", "nan", "hot1"), ("nan", "nan", "hot2"), (None, "nan", "null joins nan")] + [(str(i), str(i % 3), f"w{i}") for i in range(40)]
    a, b = spark.createDataFrame(left, "id long, x string, y string"), spark.createDataFrame(right, "x string, y string, w string")
    assert joins.heavy_keys(joins.cast_keys_to_text(a, ["x", "y"]), ["x", "y"], 100) == [("3:nan3:nan", 1000)]
    plain = joins.join_weather(a, b, ["x", "y"])
    salted = joins.join_weather(a, b, ["x", "y"], heavy_rows=100)
    assert "__salt" in salted._jdf.queryExecution().toString() and "__salt" not in plain._jdf.queryExecution().toString()
    assert Counter(map(tuple, salted.collect())) == Counter(map(tuple, plain.select(salted.columns).collect()))
    assert sum(1 for r in salted.collect() if r["x"] == "nan") == 3000


def test_rows_without_a_time_go_round_the_traffic_join(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:05:00"), (3, None), (4, None)], "id long, s string")
    got = planes_in_window(df.withColumn("t", F.col("s").cast("timestamp_ntz")), "t")
    assert {r["id"]: (r["planes_30min"], r["planes_10min"]) for r in got.collect()} == {1: (1.0, 1.0), 2: (1.0, 1.0), 3: (None, None), 4: (None, None)}


def test_csv_is_split_unless_quotes_hold_breaks(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('a,b\n1,"x, y"\n2,z\n')
    (tmp_path / "broken.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    assert not has_quoted_breaks(spark, str(tmp_path / "plain.csv")) and has_quoted_breaks(spark, str(tmp_path / "broken.csv"))
    assert [tuple(r) for r in scan_csv(spark, str(tmp_path / "plain.csv")).collect()] == [(1, "x, y"), (2, "z")]
    assert [tuple(r) for r in scan_csv(spark, str(tmp_path / "broken.csv")).collect()] == [(1, "x\ny"), (2, "z")]
    big = tmp_path / "big.csv"
    big.write_text("a,b\n" + "".join(f"{i},v{i}\n" for i in range(60_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = scan_csv(spark, str(big))
        assert df.rdd.getNumPartitions() > 3 and df.count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_every_silver_table_has_a_step(spark, tmp_path):
    geo = spark.createDataFrame([("Runway_0", None)], "runway string, stand string")
    paths = build_silver({"test_geography": geo, "glossary": spark.createDataFrame([(None, 1)], "t string, n int")}, str(tmp_path))
    assert tuple(spark.read.parquet(paths["test_geography"]).first()) == ("RUNWAY_1", "nan")
    assert tuple(spark.read.parquet(paths["glossary"]).first()) == ("nan", 1)
    with pytest.raises(ValueError):
        build_silver({"test_geograpy": geo}, str(tmp_path))
    assert len(SILVER_TABLES) == 8
