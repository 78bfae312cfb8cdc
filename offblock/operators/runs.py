"""Run records (R71) and best-run choice (R30) as a Parquet table."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS_SCHEMA = (
    "run_id string, model_type string, started_at timestamp_ntz, params map<string,string>, "
    "rmse double, mape double, mae double, std double, model_path string, features array<string>, "
    "feature_types array<string>"
)


def new_run_id() -> str:
    return uuid.uuid4().hex


def record_run(spark: SparkSession, runs_path: str, *, run_id: str, model_type: str, started_at: _dt.datetime,
               params: dict, metrics: dict, model_path: str, features: list[str], feature_types: list[str] | None = None) -> DataFrame:
    """Append one run row (params, 4 metrics, model path, signature: feature names and types) to the runs table."""
    row = (run_id, model_type, started_at, {k: str(v) for k, v in params.items()},
           *(None if metrics.get(m) is None else float(metrics[m]) for m in ("rmse", "mape", "mae", "std")),
           model_path, list(features), feature_types)
    df = spark.createDataFrame([row], RUNS_SCHEMA)
    df.write.mode("append").parquet(runs_path)
    return df


def best_run(runs: DataFrame, model_type: str | None = None) -> DataFrame:
    """The run with the smallest MAE (missing skipped), ties to the latest start, then the run id.

    The reference ignores the model type; pass ``model_type`` to filter.
    """
    if model_type is not None:
        runs = runs.where(F.col("model_type") == F.lit(model_type))
    return runs.where(F.col("mae").isNotNull()).orderBy(F.col("mae").asc(), F.col("started_at").desc(), F.col("run_id").asc()).limit(1)
