"""End to end on sf0.001: silver -> gold -> fit -> score -> explain; leak checks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from offblock.ml.explain import attribution_column, explain
from offblock.ml.models import batch_score, load_model, sample_param_maps
from offblock.plans.gold import build_gold
from offblock.plans.predict import create_predictions
from offblock.plans.silver import bronze_from_driver, build_silver
from offblock.plans.train import load_run_model, prepared_sets, train_all
from offblock.session import scratch_path


@pytest.fixture(scope="module")
def stages(spark, sf):
    out = scratch_path(spark, "pipeline-test")
    silver = build_silver(bronze_from_driver(spark, sf), out)
    gold, state = build_gold(spark, silver, out)
    return out, silver, gold, state


def test_gold_contract(spark, stages):
    _, _, gold, state = stages
    tr, te = spark.read.parquet(gold["train_default"]), spark.read.parquet(gold["test_default"])
    assert tr.columns == te.columns and tr.count() > 0 and te.count() > 0
    assert tr.columns[3:] == state.encoding.column_order
    clean = spark.read.parquet(gold["train_clean"])
    assert not {"pressure", "cloudCover"} & set(clean.columns)
    feats = [c for c in clean.columns if c not in ("flight_id", "aobt_ts", "wx_row_id")]
    nulls = clean.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in feats]).first().asDict()
    assert all(v == 0 for v in nulls.values())


def test_taxi_filter_pushed_below_joins_to_the_scan(spark, stages):
    from offblock.plans.gold import joined_and_filtered

    _, silver, _, _ = stages
    read = spark.read.parquet
    df = joined_and_filtered(read(silver["airport_train"]), read(silver["geography"]), read(silver["weather"]))
    lines = df._jdf.queryExecution().sparkPlan().toString().splitlines()
    scan = next(i for i, ln in enumerate(lines) if "FileScan" in ln and "actual_taxi_out_sec" in ln)
    assert "DataFilters: [isnotnull(actual_taxi_out_sec" in lines[scan]
    assert "Filter" in lines[scan - 1] and "actual_taxi_out_sec" in lines[scan - 1] and "7200.0" in lines[scan - 1]
    wx_scan = next(ln for ln in lines if "FileScan" in ln and "summary" in ln)
    assert "Hour" not in wx_scan and "dewPoint" not in wx_scan


def test_learned_state_comes_from_train_only(spark, stages):
    _, silver, gold, state = stages
    tr = spark.read.parquet(gold["train_default"])
    # categories: exactly the training values of the joined weather
    assert state.encoding.categories["summary"] == ["Clear", "Rain", "nan"]
    # medians: equal to the training set's exact medians
    for col, med in state.medians.items():
        if col in tr.columns and med is not None:
            vals = np.array([r[0] for r in tr.select(f"`{col}`").collect() if r[0] is not None], dtype=float)
            assert med == pytest.approx(float(np.median(vals)))


def test_train_score_explain(spark, stages):
    out, _, gold, _ = stages
    runs_path, models = out + "/runs", out + "/models"
    res = train_all(spark, ["linear_regression", "random_forest", "xgboost"], gold, runs_path, models,
                    spaces={"random_forest": {"numTrees": [8], "maxDepth": [4]},
                            "xgboost": {"maxIter": [6], "maxDepth": [3], "stepSize": [0.2]}},
                    n_trials={"random_forest": 1, "xgboost": 1})
    assert len(res) == 3 and spark.read.parquet(runs_path).count() == 3
    for r in res:
        model, spec = load_run_model(spark, r.model_path, r.model_type)
        _, _, test = prepared_sets(spark, gold, r.model_type)
        ex = explain(spark, model, r.model_type, batch_score(model, test), spec, ["flight_id", "prediction"]).toPandas()
        total = ex[[attribution_column(f) for f in spec.features]].sum(axis=1) + ex["base_value"]
        assert np.allclose(total, ex["prediction"], atol=1e-6)
    dash = create_predictions(spark, gold, runs_path, "random_forest", run_id=res[1].run_id, n_samples=10)
    rows = dash.collect()
    assert len(rows) == 10 and all(r["Stand"].startswith("STAND_") for r in rows)
    with pytest.raises(ValueError):
        load_model(res[0].model_path + "/model", "svm")


def test_search_space_grid_and_sampling():
    assert sample_param_maps("linear_regression") == [{"fitIntercept": True}, {"fitIntercept": False}]
    maps = sample_param_maps("xgboost", n_trials=5)
    assert len(maps) == 5 and all(3 <= m["maxDepth"] <= 10 and 0.01 <= m["stepSize"] <= 0.3 for m in maps)
    assert maps == sample_param_maps("xgboost", n_trials=5)
    with pytest.raises(ValueError):
        sample_param_maps("svm")


def test_linear_fit_matches_numpy_least_squares(spark, stages):
    from offblock.ml.features import FeatureSpec, assemble
    from offblock.ml.models import make_estimator

    _, _, gold, _ = stages
    cols = ["distance", "delay_seconds", "planes_30min", "temperature", "No. Engines"]
    df = spark.read.parquet(gold["train_clean"])
    spec = FeatureSpec(label="actual_taxi_out_sec", features=cols, inputs=cols, source=cols)
    data = assemble(df, spec, keep=["flight_id", "actual_taxi_out_sec"])
    for intercept in (True, False):
        model = make_estimator("linear_regression", "actual_taxi_out_sec", {"fitIntercept": intercept}).fit(data)
        pdf = df.select(*[F.col(f"`{c}`") for c in cols], "actual_taxi_out_sec").toPandas()
        X = pdf[cols].to_numpy(dtype=float)
        if intercept:
            X = np.column_stack([X, np.ones(len(X))])
        beta, *_ = np.linalg.lstsq(X, pdf["actual_taxi_out_sec"].to_numpy(dtype=float), rcond=None)
        got = list(model.coefficients.toArray()) + ([model.intercept] if intercept else [])
        assert np.allclose(got, beta, rtol=1e-6, atol=1e-6)
        pred = model.transform(data).select("prediction").toPandas()["prediction"].to_numpy()
        assert np.allclose(np.sort(pred), np.sort(X @ beta), rtol=1e-8, atol=1e-6)


def test_linear_fit_on_collinear_gold_equals_least_squares(spark, stages):
    from offblock.ml.models import make_estimator
    from offblock.plans.train import prepared_sets

    _, _, gold, _ = stages
    _, train, _ = prepared_sets(spark, gold, "linear_regression")
    for intercept in (True, False):
        m = make_estimator("linear_regression", "actual_taxi_out_sec", {"fitIntercept": intercept}).fit(train)
        pdf = m.transform(train).select("features", "actual_taxi_out_sec", "prediction").toPandas()
        X = np.stack([v.toArray() for v in pdf["features"]])
        if intercept:
            X = np.column_stack([X, np.ones(len(X))])
        assert np.linalg.matrix_rank(X) < X.shape[1]  # the dummies make it singular
        beta, *_ = np.linalg.lstsq(X, pdf["actual_taxi_out_sec"].to_numpy(), rcond=None)
        assert np.max(np.abs(pdf["prediction"].to_numpy() - X @ beta)) < 1e-3


def test_command_line_all_stages(spark, sf):
    from offblock.__main__ import run
    from offblock.session import scratch_path

    out = scratch_path(spark, "cli")
    done = run(["all", "--out", out, "--from-driver", sf, "--models", "linear_regression", "--trials", "1",
                "--n-samples", "5"], spark=spark)
    assert set(done) == {"silver", "gold", "train", "predict"} and done["predict"] == 5
    assert spark.read.option("header", True).csv(out + "/predictions/dashboard_csv").count() == 5


def test_command_line_from_csv_bronze(spark, sf):
    from offblock.__main__ import run
    from offblock.plans.silver import bronze_from_driver
    from offblock.session import scratch_path

    src = scratch_path(spark, "cli-bronze")
    paths = {}
    for name, df in bronze_from_driver(spark, sf).items():
        paths[name] = f"{src}/{name}.csv"
        df.write.mode("overwrite").option("header", True).csv(paths[name])
    out = scratch_path(spark, "cli-csv")
    done = run(["silver", "--out", out, "--airport-train", paths["airport_train"], "--airport-test",
                paths["airport_test"], "--geography", paths["geography"], "--weather", paths["weather"],
                "--table", f"glossary={paths['geography']}"], spark=spark)
    assert set(done["silver"]) == {"airport_train", "airport_test", "geography", "weather"}
    run(["gold", "--out", out], spark=spark)
    tr = spark.read.parquet(out + "/gold/train_default")
    assert tr.count() > 0 and "planes_30min" in tr.columns
    assert spark.read.parquet(out + "/silver/glossary").count() == 25


def test_best_run_of_type_for_prediction(spark, stages):
    out, _, gold, _ = stages
    from offblock.plans.predict import choose_run, create_predictions

    runs_path = out + "/runs"
    assert spark.read.parquet(runs_path).select("model_type").distinct().count() >= 2
    best_rf = choose_run(spark, runs_path, "random_forest")
    assert best_rf["model_type"] == "random_forest"
    dash = create_predictions(spark, gold, runs_path, "random_forest", n_samples=3, best_of_type=True)
    assert dash.count() == 3


def test_gold_traffic_counts_are_per_set_brute_force(spark, stages):
    _, _, gold, _ = stages
    for part in ("train", "test"):
        pdf = spark.read.parquet(gold[f"{part}_default"]).select("aobt_ts", "planes_30min", "planes_10min").toPandas()
        t = pdf["aobt_ts"].astype("int64").to_numpy() // 10**9 if str(pdf["aobt_ts"].dtype).startswith("datetime64[ns") \
            else pdf["aobt_ts"].astype("datetime64[s]").astype("int64").to_numpy()
        for col, w in (("planes_30min", 1800), ("planes_10min", 600)):
            want = np.array([np.sum(np.abs(t - x) <= w) - 1 for x in t], dtype=float)
            assert np.array_equal(pdf[col].to_numpy(), want), (part, col)


def test_silver_queries_do_not_build_gold(spark, sf, monkeypatch):
    from offblock.plans import catalog, gold

    monkeypatch.setattr(catalog, "_SILVER", {})
    monkeypatch.setattr(catalog, "_BUILT", {})
    monkeypatch.setattr(gold, "build_gold", lambda *_: pytest.fail("gold built"))
    for name in ("r77_build_silver", "r77b_silver_airport_test", "r77c_silver_geographies", "r77d_silver_weather", "r77e_silver_plain_tables"):
        assert not catalog.queries()[name](spark, sf).isEmpty()
