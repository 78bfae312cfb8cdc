"""Medians, splits, CSV text and search names on inputs that the fixtures do not hold."""

import datetime
import random
import statistics

from pyspark.sql import functions as F

from offblock.ml import models
from offblock.operators import select
from offblock.operators.split import time_ordered_split
from offblock.sources.files import scan_csv, sink_csv


def test_median_with_infinities_and_full_range(spark, monkeypatch):
    monkeypatch.setattr(select, "FETCH_LIMIT", 50)
    r = random.Random(1)
    cols = {"a": [float("-inf")] + [r.gauss(0, 1) for _ in range(2000)], "b": [-1e308, 1e308] + [r.random() for _ in range(1999)],
            "c": [float("-inf"), float("inf"), *[10.0 ** r.randint(-300, 300) for _ in range(1999)]]}
    df = spark.createDataFrame(list(zip(*cols.values(), strict=True)), "a double, b double, c double")
    got = select.exact_median(df, list(cols))
    assert got == {c: statistics.median(v) for c, v in cols.items()}


def test_split_with_many_missing_times_and_long_ids(spark):
    t = datetime.datetime(2020, 1, 1)
    rows = [(None if i % 5 < 2 else t + datetime.timedelta(seconds=i), 2**60 + i) for i in range(500)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, id long")
    first, rest = time_ordered_split(df, ["t", "id"])
    want = sorted(rows, key=lambda x: (x[0] is None, x[0] or t, x[1]))
    assert sorted(x.id for x in first.collect()) == sorted(i for _, i in want[:400]) and rest.count() == 100


def test_csv_round_trip_of_quotes_commas_newlines_and_blanks(spark, tmp_path):
    rows = [(1, 'say "hi", ok', True), (2, "two\nlines", False), (3, "  blanks  ", True)]
    path = str(tmp_path / "x")
    sink_csv(spark.createDataFrame(rows, "id long, s string, b boolean").coalesce(1), path)
    got = scan_csv(spark, path)
    assert [tuple(x) for x in got.orderBy("id").collect()] == rows and dict(got.dtypes)["b"] == "boolean"


def test_search_names_without_a_setting_are_not_passed_on():
    for family in ("random_forest", "xgboost", "lightgbm", "catboost"):
        models.make_estimator(family, "y", {"maxDepth": 3, "reg_alpha": 0.1, "reg_lambda": 1.0, "l2_leaf_reg": 3, "min_samples_split": 2,
                                            "bagging_temperature": 0.5, "random_strength": 1.0})


def test_extreme_medians_reach_the_driver_in_bounded_rounds(spark):
    df = spark.range(30_000).select(F.when(F.col("id") == 0, F.lit(float("-inf"))).otherwise(F.col("id") % 100).cast("double").alias("x"))
    assert select.exact_median(df, ["x"])["x"] == 49.0 or select.exact_median(df, ["x"])["x"] == 49.5


def test_ranks_of_one_column_share_its_buckets(spark, monkeypatch):
    asked, bucket = [], select._bucket
    monkeypatch.setattr(select, "_bucket", lambda t: asked.append(t.tid) or bucket(t))
    df = spark.createDataFrame([(float(i), float(-i) if i % 3 else None) for i in range(100)], "x double, y double")
    assert select.exact_median(df, ["x", "y"]) == {"x": 49.5, "y": -49.5}
    assert len(asked) == 2
