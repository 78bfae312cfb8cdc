"""R68-R71 train: per model family, route the gold variant, search on a
time-ordered holdout, refit on all training rows, score the test set, record
the run and save the model.

The training vectors are written once under the checkpoint folder; the holdout
parts are key filters over them, and trials and refit read them.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from offblock.constants import MODEL_DATASET, ORDER_TS, ROW_ID, TARGET
from offblock.ml.features import FeatureSpec, assemble, feature_spec
from offblock.ml.models import (
    TREE_FAMILIES, batch_score, load_model, make_estimator, sample_param_maps, save_model, search_holdout,
)
from offblock.operators.metrics import metrics_dict
from offblock.operators.runs import new_run_id, record_run
from offblock.operators.split import time_ordered_split
from offblock.session import cut_lineage

ROW_KEYS = [ROW_ID, ORDER_TS, "wx_row_id"]


@dataclass
class TrainResult:
    run_id: str
    model_type: str
    params: dict
    metrics: dict
    model_path: str
    trials: list


def dataset_paths(gold: dict[str, str], model_type: str, strict: bool = False) -> tuple[str, str]:
    """(train, test) paths of the gold variant the model family uses."""
    if model_type not in MODEL_DATASET:
        if strict:
            raise ValueError(f"no gold variant is set for {model_type!r}; families: {', '.join(MODEL_DATASET)}")
        kind = "default"
    else:
        kind = MODEL_DATASET[model_type]
    return gold[f"train_{kind}"], gold[f"test_{kind}"]


def prepared_sets(spark: SparkSession, gold: dict[str, str], model_type: str
                  ) -> tuple[FeatureSpec, DataFrame, DataFrame]:
    train_p, test_p = dataset_paths(gold, model_type)
    train, test = spark.read.parquet(train_p), spark.read.parquet(test_p)
    trees = model_type in TREE_FAMILIES
    spec = feature_spec(train, TARGET, ROW_KEYS, for_trees=trees, native=trees)
    keep = ROW_KEYS + [TARGET]
    return spec, assemble(train, spec, keep=keep), assemble(test, spec, keep=keep)


def feature_types(spark: SparkSession, gold: dict[str, str], model_type: str, spec: FeatureSpec) -> list[str]:
    """The types of the training table's feature columns, as recorded with a run."""
    types = dict(spark.read.parquet(dataset_paths(gold, model_type)[0]).dtypes)
    return [types[c] for c in spec.features]


def save_spec(spark: SparkSession, spec: FeatureSpec, path: str) -> None:
    spark.createDataFrame([(spec.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_spec(spark: SparkSession, path: str) -> FeatureSpec:
    return FeatureSpec.from_json(spark.read.text(path).first()["value"])


def train_model(spark: SparkSession, model_type: str, gold: dict[str, str], runs_path: str, models_dir: str,
                space: dict | None = None, n_trials: int | None = None, seed: int = 42) -> TrainResult:
    """R68 + R69 + R71 + R72 for one model family."""
    make_estimator(model_type, TARGET)  # unknown family raises before any work
    started = _dt.datetime.now().replace(microsecond=0)
    spec, train, test = prepared_sets(spark, gold, model_type)
    # every trial and the refit read the vectors as they were written once
    train = cut_lineage(train, "train-vectors")
    fit_part, val_part = time_ordered_split(train, [ORDER_TS, ROW_ID, "wx_row_id"])
    maps = sample_param_maps(model_type, space, n_trials, seed)
    best, trials = search_holdout(model_type, TARGET, fit_part, val_part, maps)
    model = make_estimator(model_type, TARGET, best).fit(train)
    metrics = metrics_dict(batch_score(model, test), TARGET)
    run_id = new_run_id()
    model_path = f"{models_dir.rstrip('/')}/{run_id}"
    save_model(model, f"{model_path}/model")
    save_spec(spark, spec, f"{model_path}/spec")
    record_run(spark, runs_path, run_id=run_id, model_type=model_type, started_at=started, params=best,
               metrics=metrics, model_path=model_path, features=spec.features, feature_types=feature_types(spark, gold, model_type, spec))
    return TrainResult(run_id, model_type, best, metrics, model_path, trials)


def train_all(spark: SparkSession, model_types: list[str], gold: dict[str, str], runs_path: str, models_dir: str,
              spaces: dict | None = None, n_trials: dict | None = None) -> list[TrainResult]:
    """Train each named family in turn (an unknown name raises)."""
    out = []
    for mt in model_types:
        out.append(train_model(spark, mt, gold, runs_path, models_dir, (spaces or {}).get(mt),
                               (n_trials or {}).get(mt)))
    return out


def load_run_model(spark: SparkSession, model_path: str, model_type: str):
    """(model, feature spec) of a recorded run."""
    return load_model(f"{model_path}/model", model_type), load_spec(spark, f"{model_path}/spec")
