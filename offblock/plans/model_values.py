"""Model queries whose results SQL can give exactly.

They train on all departures with a taxi time, before and after the adapter's
cut, on 0/1 inputs. There a tree as deep as it has inputs gives group means, a
boosted ensemble's later trees add nothing, and least squares has a closed form.
The paths are those of the library: gold tables, search on the time-ordered
holdout, refit, run table, saved model, scores, attributions, dashboard rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offblock.constants import AIRCRAFT_LENGTH, NO_ENGINES, ORDER_TS, ROW_ID, RUNWAY, STAND, TARGET
from offblock.functions import flag_private
from offblock.ml.explain import attribution_column, explain
from offblock.ml.features import assemble, feature_spec
from offblock.ml.models import batch_score, load_model, make_estimator, save_model
from offblock.operators.sampling import sample_n
from offblock.plans.predict import create_predictions
from offblock.plans.train import ROW_KEYS, TREE_FAMILIES, TrainResult, load_run_model, prepared_sets, train_all, train_model
from offblock.session import scratch_path
from offblock.sources import driver_tables as dt

FAMILIES = ["linear_regression", *TREE_FAMILIES]


def _scratch(spark: SparkSession, tag: str) -> str:
    return scratch_path(spark, f"{tag}-{uuid.uuid4().hex}")


def _private():
    return flag_private("flight_no").cast("double")


def _two_inputs() -> dict:
    return {"private": _private(), "four": (F.col("engines") == 4).cast("double")}


def _one_input() -> dict:
    """The columns that the dashboard shows; only the runway differs between departures."""
    return {RUNWAY: (_private() + 1).cast("int"), STAND: F.lit(1), AIRCRAFT_LENGTH: F.lit(40.0), NO_ENGINES: F.lit(2)}


def _gold(spark: SparkSession, sf: str, inputs: dict) -> dict[str, str]:
    """Written training and test tables of the departures; both variants are the same, as nothing is missing."""
    fl = dt.flights(spark, sf).where(F.col("taxi").isNotNull())
    rows = fl.select(F.col("flight_id").alias(ROW_ID), F.col("aobt").alias(ORDER_TS), F.lit(0).cast("long").alias("wx_row_id"),
                     F.col("taxi").alias(TARGET), *[c.alias(n) for n, c in inputs.items()])
    early = F.col(ORDER_TS) < F.lit(dt.TRAIN_CUTOFF).cast("timestamp_ntz")
    root, paths = _scratch(spark, "values"), {"root": ""}
    for part, cond in (("train", early), ("test", ~early)):
        rows.where(cond).write.parquet(f"{root}/{part}")
        paths |= {f"{part}_default": f"{root}/{part}", f"{part}_clean": f"{root}/{part}"}
    return paths | {"root": root}


def _space(family: str, depths: list[int], intercepts: list[bool]) -> dict:
    if family == "linear_regression":
        return {"fitIntercept": intercepts}
    trees = {"numTrees": [3], "bootstrap": [False]} if family == "random_forest" else {"maxIter": [2], "stepSize": [1.0]}
    return {**trees, "maxDepth": depths, "featureSubsetStrategy": ["all"]}


def _train(spark: SparkSession, gold: dict[str, str], family: str, depths: list[int], intercepts: list[bool]) -> TrainResult:
    return train_model(spark, family, gold, gold["root"] + "/runs", gold["root"] + "/models",
                       space=_space(family, depths, intercepts), n_trials=2)


def _predicted(spark: SparkSession, sf: str, family: str) -> DataFrame:
    gold = _gold(spark, sf, _two_inputs())
    res = _train(spark, gold, family, [2], [True])
    model, _ = load_run_model(spark, res.model_path, family)
    _, _, test = prepared_sets(spark, gold, family)
    return batch_score(model, test).select(ROW_ID, F.round("prediction", 3).alias("prediction"))


def r40b_sample_n(spark, sf):
    fl = dt.flights(spark, sf).select("flight_id", "taxi")
    got = sample_n(fl, 10, "flight_id")
    member = got.join(fl.select("flight_id").distinct(), "flight_id", "left_semi")
    return member.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("flight_id").alias("n_distinct"))


def r61b_fit_linear(spark, sf):
    return _predicted(spark, sf, "linear_regression")


def r62b_fit_forest(spark, sf):
    return _predicted(spark, sf, "random_forest")


def r63b_fit_boost_depthwise(spark, sf):
    return _predicted(spark, sf, "xgboost")


def r64b_fit_boost_leafwise(spark, sf):
    return _predicted(spark, sf, "lightgbm")


def r65b_fit_boost_symmetric(spark, sf):
    return _predicted(spark, sf, "catboost")


def r68b_search_holdout(spark, sf):
    """Every candidate of every family with its error on the late part."""
    gold, rows = _gold(spark, sf, _two_inputs()), []
    for family in FAMILIES:
        for params, error in _train(spark, gold, family, [0, 2], [False, True]).trials:
            plain = params.get("maxDepth") == 0 or params.get("fitIntercept") is False
            rows.append((family, "plain" if plain else "full", round(error, 3)))
    return spark.createDataFrame(rows, "model_type string, candidate string, validation_rmse double")


def _runs(spark, sf, families):
    gold = _gold(spark, sf, _two_inputs())
    train_all(spark, families, gold, gold["root"] + "/runs", gold["root"] + "/models",
              spaces={f: _space(f, [0, 2], [False, True]) for f in families}, n_trials=dict.fromkeys(families, 2))
    return spark.read.parquet(gold["root"] + "/runs")


def r69b_refit_and_score(spark, sf):
    return _runs(spark, sf, ["random_forest"]).select(*[F.round(c, 3).alias(c) for c in ("rmse", "mape", "mae", "std")])


def r70b_train_all(spark, sf):
    return _runs(spark, sf, FAMILIES).select("model_type", *[F.round(c, 3).alias(c) for c in ("rmse", "mape", "mae", "std")])


def r71b_record_run(spark, sf):
    """The run rows without their id, time and path."""
    full = F.coalesce(F.element_at("params", "maxDepth") == "2", F.element_at("params", "fitIntercept") == "True")
    return _runs(spark, sf, ["linear_regression", "catboost"]).select(
        "model_type", F.when(full, "full").otherwise("plain").alias("candidate"), F.array_join("features", ",").alias("features"),
        F.round("mae", 3).alias("mae"))


def r72b_save_load_model(spark, sf):
    """Predictions of each tree family's model before it is saved and after it is loaded."""
    gold, out = _gold(spark, sf, _two_inputs()), None
    for family in TREE_FAMILIES:
        _, train, test = prepared_sets(spark, gold, family)
        params = {k: v[0] for k, v in _space(family, [2], [True]).items()}
        model, path = make_estimator(family, TARGET, params).fit(train), f"{gold['root']}/{family}"
        save_model(model, path)
        loaded = batch_score(load_model(path, family), test).select(ROW_ID, F.round("prediction", 3).alias("loaded"))
        both = batch_score(model, test).select(ROW_ID, F.round("prediction", 3).alias("fitted")).join(loaded, ROW_ID)
        both = both.select(F.lit(family).alias("model_type"), ROW_ID, "fitted", "loaded")
        out = both if out is None else out.unionByName(both)
    return out


def r73b_batch_score(spark, sf):
    """Linear scores of all departures; those without a model name lack an input."""
    gold = _gold(spark, sf, _two_inputs())
    spec, train, _ = prepared_sets(spark, gold, "linear_regression")
    model = make_estimator("linear_regression", TARGET).fit(train)
    rows = dt.flights(spark, sf).select(ROW_ID, F.when(F.col("model").isNotNull(), _private()).alias("private"),
                                        (F.col("engines") == 4).cast("double").alias("four"))
    return batch_score(model, assemble(rows, spec, keep=[ROW_ID])).select(ROW_ID, F.round("prediction", 3).alias("prediction"))


def r75b_explain_trees(spark, sf):
    """Attributions of the one input of each tree family's model, and their base value."""
    gold, out = _gold(spark, sf, {"private": _private()}), None
    for family in TREE_FAMILIES:
        train = spark.read.parquet(gold["train_default"])
        spec = feature_spec(train, TARGET, ROW_KEYS, for_trees=True, native=True)
        params = {k: v[0] for k, v in _space(family, [1], [True]).items()}
        model = make_estimator(family, TARGET, params).fit(assemble(train, spec, keep=ROW_KEYS + [TARGET]))
        test = assemble(spark.read.parquet(gold["test_default"]), spec, keep=[ROW_ID])
        got = explain(spark, model, family, batch_score(model, test), spec, keep=[ROW_ID])
        got = got.select(F.lit(family).alias("model_type"), ROW_ID, F.round(attribution_column("private"), 3).alias("attribution"),
                         F.round("base_value", 3).alias("base_value"))
        out = got if out is None else out.unionByName(got)
    return out


def r76b_score_and_explain(spark, sf):
    """Dashboard rows of every test departure, by each tree family."""
    gold, out = _gold(spark, sf, _one_input()), None
    for family in TREE_FAMILIES:
        run = _train(spark, gold, family, [1], [True])
        got = create_predictions(spark, gold, gold["root"] + "/runs", family, run_id=run.run_id, n_samples=None,
                                 out_dir=f"{gold['root']}/{family}")
        got = got.withColumn("model_type", F.lit(family))
        out = got if out is None else out.unionByName(got)
    return out


# --- the first two levels of a tree of each rule, split by split ---------------------

SPLIT_INPUTS = ["hour", "lag_min", "length"]


def _split_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Departures with a taxi time: hour, minutes of lag, and the length of aircraft whose model is known."""
    fl = dt.flights(spark, sf).where(F.col("taxi").isNotNull())
    return fl.select(ROW_ID, F.col("taxi").alias("y"), F.hour("aobt").cast("double").alias("hour"), F.floor(F.col("lag_s") / 60).cast("double").alias("lag_min"),
                     F.when(F.col("model").isNotNull(), F.col("ac_length")).alias("length"))


def _first_levels(spark: SparkSession, sf: str, rules: dict) -> DataFrame:
    """The nodes of the first tree of each rule: path (L, R), split and value."""
    from offblock.ml.histogram import fit_many

    spec = feature_spec(_split_rows(spark, sf), "y", [ROW_ID], for_trees=True, native=True)
    data = assemble(_split_rows(spark, sf), spec, keep=[ROW_ID, "y"]).select(ROW_ID, "y", "features")
    rows = []
    for name, m in zip(rules, fit_many(data, "y", list(rules.values())), strict=True):
        t, path = m.trees[0], {0: ""}
        for v in range(len(t["col"])):
            for side, child in (("L", int(t["left"][v])), ("R", int(t["right"][v]))):
                if child >= 0:
                    path[child] = path[v] + side
        for v, p in path.items():
            inner = t["left"][v] >= 0
            at = float(t["threshold"][v]) if inner else None
            rows.append((name, p, spec.inputs[t["col"][v]] if inner else None, None if at in (None, float("inf")) else at,
                         int(t["missing_left"][v]) if inner else None, round(float(t["gain"][v]), 1) if inner else None,
                         None if inner else round(float(t["value"][v]), 3), int(t["cover"][v])))
    return spark.createDataFrame(rows, "rule string, path string, input string, threshold double, missing_left int, gain double, value double, n_rows long")


def r62c_forest_splits(spark, sf):
    """Forest trees of two levels on all rows, without and with least sizes."""
    from offblock.ml.histogram import TreeParams

    return _first_levels(spark, sf, {"plain": TreeParams(forest=True, rounds=1, depth=2),
                                     "sizes": TreeParams(forest=True, rounds=1, depth=2, split_rows=3000, child_rows=400)})


def r63c_depthwise_splits(spark, sf):
    """Depth-wise trees of two levels, without and with penalties."""
    from offblock.ml.histogram import TreeParams

    return _first_levels(spark, sf, {"plain": TreeParams(rounds=1, depth=2, rate=1.0),
                                     "penalties": TreeParams(rounds=1, depth=2, rate=1.0, alpha=5000.0, lam=300.0, gamma=1000.0, child_weight=200)})


def r64c_leafwise_splits(spark, sf):
    """Leaf-wise trees of three leaves: the better child splits."""
    from offblock.ml.histogram import TreeParams

    return _first_levels(spark, sf, {"plain": TreeParams(growth="leaf", leaves=3, rounds=1, depth=2, rate=1.0),
                                     "penalties": TreeParams(growth="leaf", leaves=3, rounds=1, depth=2, rate=1.0, alpha=2000.0, lam=100.0, child_rows=300)})


def r65c_symmetric_splits(spark, sf):
    """Symmetric trees of two levels: one split a level."""
    from offblock.ml.histogram import TreeParams

    return _first_levels(spark, sf, {"plain": TreeParams(growth="symmetric", rounds=1, depth=2, rate=1.0),
                                     "penalties": TreeParams(growth="symmetric", rounds=1, depth=2, rate=1.0, lam=2000.0)})


def queries() -> dict:
    return {n: f for n, f in globals().items() if n[:1] == "r" and n[1:3].isdigit() and callable(f)}
