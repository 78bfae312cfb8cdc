
import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from offblock.operators import encode, filters, groups, impute, joins, report, runs, schema, select, split
from offblock.operators.traffic import planes_in_window


def ts(sec):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=sec)


def test_planes_in_window_edge(spark):
    secs = [0, 0, 600, 601, 1800, 1801, None]
    df = spark.createDataFrame([(i, None if s is None else ts(s)) for i, s in enumerate(secs)], "id int, t timestamp_ntz")
    out = planes_in_window(df, "t", (10, 30), ("w600", "w1800")).orderBy("id").collect()
    assert [r["w600"] for r in out] == [2, 2, 3, 1, 1, 1, None]
    assert [r["w1800"] for r in out] == [4, 4, 5, 5, 5, 3, None]


def test_planes_in_window_matches_brute_force_and_partitioning(spark):
    rng = np.random.default_rng(7)
    secs = rng.integers(0, 20000, 600).tolist() + [5000] * 50  # a hot second
    df = spark.createDataFrame([(i, ts(int(s))) for i, s in enumerate(secs)], "id int, t timestamp_ntz")
    arr = np.array(secs)
    expect = {i: int(np.sum(np.abs(arr - s) <= 1800) - 1) for i, s in enumerate(secs)}
    for parts in (1, 7):
        got = planes_in_window(df.repartition(parts), "t").select("id", "planes_30min").collect()
        assert {r["id"]: int(r["planes_30min"]) for r in got} == expect


def test_traffic_plan_has_no_single_partition_window(spark):
    df = spark.createDataFrame([(1, ts(1))], "id int, t timestamp_ntz")
    plan = planes_in_window(df, "t")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan


def test_filter_taxi_range(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 7200.0, None, -1.0, 1.0, 7199.0]], "t double")
    assert sorted(r[0] for r in filters.filter_taxi_range(df, "t").collect()) == [1.0, 7199.0]
    audit = filters.filter_audit(df, "t").first()
    assert (audit["rows_before"], audit["rows_after"]) == (6, 2)


def test_one_hot_nan_and_null(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["b", "nan", None, "a", "B"])], "i int, c string")
    cats = encode.learn_categories(df, "c")
    assert cats == ["B", "a", "b", "nan"]
    out = encode.one_hot(df, "c", cats).orderBy("i").collect()
    assert [out[2][f"c_{v}"] for v in cats] == [0, 0, 0, 0]
    assert all(sum(r[f"c_{v}"] for v in cats) == (0 if r["i"] == 2 else 1) for r in out)


def test_exact_median_and_kth(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert impute.learn_medians(df, ["x"], only_missing=False) == {"x": 2.0}
    allnull = spark.createDataFrame([(None,), (None,)], "x double")
    assert impute.learn_medians(allnull, ["x"], only_missing=False) == {"x": None}
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=3001), np.full(2000, 0.125)])
    big = spark.createDataFrame([(float(v),) for v in vals], "x double")
    assert impute.learn_medians(big, ["x"], only_missing=False)["x"] == float(np.median(vals))
    ks = [1, 17, 2500, 5001]
    got = select.kth_smallest(big, [(F.col("x"), k) for k in ks])
    srt = np.sort(vals)
    assert got == [float(srt[k - 1]) for k in ks]


def test_fill_with_median(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "x double, y double")
    filled, med = impute.handle_missing(df)
    assert med == {"x": 2.0, "y": None}
    assert [r["x"] for r in filled.collect()] == [1.0, 2.0, 3.0]


def test_fill_integral_column_with_fractional_median(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "n long")
    filled, med = impute.handle_missing(df)
    assert med == {"n": 1.5}
    assert sorted(r["n"] for r in filled.collect()) == [1.0, 1.5, 2.0]
    df2 = spark.createDataFrame([(1,), (None,), (3,)], "n long")
    out = impute.handle_missing(df2)[0]
    assert dict(out.dtypes)["n"] == "bigint" and sorted(r["n"] for r in out.collect()) == [1, 2, 3]


def test_time_ordered_split_sizes_and_order(spark):
    rng = np.random.default_rng(11)
    rows = [(i, ts(int(s))) for i, s in enumerate(rng.integers(0, 500, 1003))]
    df = spark.createDataFrame(rows, "id long, t timestamp_ntz")
    tr, va = split.time_ordered_split(df, ["t", "id"])
    a, b = tr.collect(), va.collect()
    assert len(a) == int(1003 * 0.8) and len(a) + len(b) == 1003
    assert max((r["t"], r["id"]) for r in a) < min((r["t"], r["id"]) for r in b)
    plan = split.mark_split(df, ["t", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_conform_to_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, extra int, c int")
    out = schema.conform_to_columns(df, ["c", "b", "a"])
    assert out.columns == ["c", "b", "a"] and out.first()["b"] == 0


def test_cast_keys_null_matches_null(spark):
    left = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "id int, k string")
    right = spark.createDataFrame([(None, "n"), ("x", "y")], "k string, v string")
    out = {r["id"]: r["v"] for r in joins.join_weather(left, right, ["k"]).collect()}
    assert out == {1: "n", 2: "y", 3: "n"}


def test_lookup_default(spark):
    df = spark.createDataFrame([("RUNWAY_1",), ("RUNWAY_9",), (None,)], "Runway string")
    assert [r["base_minutes"] for r in joins.lookup_default(df).collect()] == [14, 18, 18]


def test_rename_ci_and_stringify(spark):
    df = spark.createDataFrame([(None, "a", 1)], "RUNWAY string, Stand string, n int")
    out = schema.stringify_text(schema.rename_ci(df))
    assert out.columns == ["runway", "stand", "n"] and out.first()["runway"] == "nan"


def test_best_run_ties_to_latest(spark):
    rows = [("a", "x", dt.datetime(2024, 1, 1), 5.0), ("b", "x", dt.datetime(2024, 1, 2), None),
            ("c", "y", dt.datetime(2024, 1, 3), 5.0), ("d", "x", dt.datetime(2024, 1, 4), 7.0)]
    df = spark.createDataFrame(rows, "run_id string, model_type string, started_at timestamp_ntz, mae double")
    assert runs.best_run(df).first()["run_id"] == "c"
    assert runs.best_run(df, "x").first()["run_id"] == "a"


def test_category_impacts_unknown_adds_zero_and_double_membership(spark):
    feats = ["temperature", "AOBT_hour_sin", "AOBT_day_of_month_cos", "distance", "private_flight"]
    g = groups.feature_groups(feats)
    assert "AOBT_day_of_month_cos" in g["Traffic"] and "private_flight" not in sum(g.values(), [])
    df = spark.createDataFrame([(1.0, 2.0, 4.0, 8.0, 100.0)], ", ".join(f"`{f}` double" for f in feats))
    out = groups.category_impacts(df, {f: f for f in feats}, g).first()
    assert (out["Weather"], out["Traffic"], out["Distance"], out["Aircraft"]) == (1.0, 6.0, 8.0, 0.0)


def test_rank_drivers_ties_keep_category_order(spark):
    df = spark.createDataFrame([(1, 2.0, -2.0, 0.5, -3.0)], "id int, Weather double, Traffic double, Distance double, Aircraft double")
    out = report.rank_drivers(df, ["id"]).orderBy("rank").collect()
    assert [r["category"] for r in out] == ["Aircraft", "Weather", "Traffic", "Distance"]
    assert [r["ordinal"] for r in out] == ["1st", "2nd", "3rd", "4th"]
    assert [r["direction"] for r in out] == ["down", "up", "down", "up"]
    assert [r["tone"] for r in out] == ["good", "bad", "good", "bad"]


def test_cyclical_identity(spark):
    df = spark.createDataFrame([("1/5/2019 7:08",), ("12/31/2019 23:59",)], "AOBT string")
    out = encode.datetime_features(df, "AOBT").collect()
    for r in out:
        for p in ("hour", "day_of_week", "month", "day_of_month"):
            assert math.isclose(r[f"AOBT_{p}_sin"] ** 2 + r[f"AOBT_{p}_cos"] ** 2, 1.0)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pruning(spark, sf):
    from offblock.plans.catalog import r16_filter_taxi_range

    plan = _plan(r16_filter_taxi_range(spark, sf))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_distance_join_broadcasts_points(spark, sf):
    from offblock.plans.catalog import r21_join_distance

    plan = r21_join_distance(spark, sf)._jdf.queryExecution().sparkPlan().toString()
    left_bhj = [ln for ln in plan.splitlines() if "BroadcastHashJoin" in ln and "LeftOuter" in ln]
    assert len(left_bhj) == 2 and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_split_and_sample_are_not_single_partition(spark, sf):
    from offblock.plans.catalog import r35_time_ordered_split, r39_sample_n_seeded

    assert "SinglePartition" not in _plan(r35_time_ordered_split(spark, sf))
    assert "TakeOrderedAndProject" in _plan(r39_sample_n_seeded(spark, sf))


def test_kth_key_hot_first_key(spark, monkeypatch):
    monkeypatch.setattr(select, "FETCH_LIMIT", 5)
    monkeypatch.setattr(select, "BUCKETS", 4)
    rows = [(7, i) for i in range(40)] + [(i % 5, 100 + i) for i in range(30)]
    df = spark.createDataFrame(rows, "a long, b long")
    srt = sorted(rows)
    for k in (1, 12, 30, 31, 55, 70):
        assert select.kth_key(df, [F.col("a"), F.col("b")], k) == list(srt[k - 1])
    assert select.kth_key(df, [F.col("a"), F.col("b")], 71) is None


def test_distance_join_falls_back_beyond_the_size_limit(spark, sf):
    from offblock.plans.catalog import _fl, _silver_geo

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fl = _fl(spark, sf).select("flight_id", "runway", "stand")
        small = joins.join_distance(fl, _silver_geo(spark, sf), max_rows=1000)
        big = joins.join_distance(fl, _silver_geo(spark, sf), max_rows=1)
        p_small = small._jdf.queryExecution().sparkPlan().toString()
        p_big = big._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in p_small
        assert "SortMergeJoin" in p_big and not any(
            "BroadcastHashJoin" in ln and "LeftOuter" in ln for ln in p_big.splitlines())
        assert sorted(small.collect()) == sorted(big.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
