"""Command line: the four stages of the reference pipeline as Spark jobs.

  python -m offblock silver  --out ROOT --airport-train A --airport-test B --geography G --weather W [--table NAME=PATH ...]
  python -m offblock gold    --out ROOT
  python -m offblock train   --out ROOT [--models linear_regression,xgboost,...] [--trials N] [--quick]
  python -m offblock predict --out ROOT --model-type xgboost [--run-id ID] [--n-samples 10] [--seed 42]
  python -m offblock all     --out ROOT --from-driver SF_DIR [train/predict options]

Bronze inputs are CSV or Parquet (``scan_by_suffix``); ROOT holds silver/, gold/,
runs/, models/ and predictions/. On a cluster run it with spark-submit; the
session is taken as configured (``--local`` starts a local one).
"""

from __future__ import annotations

import argparse
import sys

from offblock.ml.models import MODEL_TYPES


def _session(local: bool):
    from pyspark.sql import SparkSession

    from offblock.session import ensure_checkpoint_dir, local_session

    if local:
        return local_session()
    spark = SparkSession.builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _paths(root: str) -> dict[str, str]:
    root = root.rstrip("/")
    silver = {n: f"{root}/silver/{n}" for n in ("airport_train", "airport_test", "geography", "weather")}
    gold = {f"{p}_{v}": f"{root}/gold/{p}_{v}" for p in ("train", "test") for v in ("default", "clean")}
    return {"silver": silver, "gold": gold, "runs": f"{root}/runs", "models": f"{root}/models",
            "predictions": f"{root}/predictions"}


#: Boosting rounds and forest trees of --quick.
QUICK_ROUNDS = 4


def _quick_space(model_type: str) -> dict:
    """The library's search space of a family with QUICK_ROUNDS rounds."""
    from offblock.constants import SEARCH_SPACES

    return {k: [QUICK_ROUNDS] if k in ("n_estimators", "iterations") else v for k, v in SEARCH_SPACES[model_type].items()}


def run(argv: list[str] | None = None, spark=None) -> dict:
    ap = argparse.ArgumentParser(prog="python -m offblock")
    ap.add_argument("stage", choices=["silver", "gold", "train", "predict", "all"])
    ap.add_argument("--out", required=True)
    ap.add_argument("--local", action="store_true")
    ap.add_argument("--airport-train")
    ap.add_argument("--airport-test")
    ap.add_argument("--geography")
    ap.add_argument("--weather")
    ap.add_argument("--table", action="append", default=[], help="extra bronze table NAME=PATH (text cast only)")
    ap.add_argument("--from-driver", help="build bronze from the driver tables in this folder")
    ap.add_argument("--models", default=",".join(MODEL_TYPES))
    ap.add_argument("--trials", type=int)
    ap.add_argument("--quick", action="store_true", help="small search spaces (checks, demos)")
    ap.add_argument("--model-type", default="xgboost")
    ap.add_argument("--run-id")
    ap.add_argument("--n-samples", type=int, default=10)
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--best-over-all-types", action="store_true",
                    help="choose the best run ignoring the model type (the reference's rule)")
    a = ap.parse_args(argv)
    spark = spark or _session(a.local)
    p = _paths(a.out)
    done: dict = {}

    if a.stage in ("silver", "all"):
        from offblock.operators.schema import stringify_text
        from offblock.plans.silver import bronze_from_driver, build_silver
        from offblock.sources.files import scan_by_suffix, sink_parquet

        if a.from_driver:
            bronze = bronze_from_driver(spark, a.from_driver)
        else:
            need = {"airport_train": a.airport_train, "airport_test": a.airport_test,
                    "geography": a.geography, "weather": a.weather}
            missing = [k for k, v in need.items() if not v]
            if missing:
                ap.error(f"silver needs --{', --'.join(m.replace('_', '-') for m in missing)}")
            bronze = {k: scan_by_suffix(spark, v) for k, v in need.items()}
        done["silver"] = build_silver(bronze, a.out)
        for item in a.table:
            name, path = item.split("=", 1)
            sink_parquet(stringify_text(scan_by_suffix(spark, path)), f"{a.out.rstrip('/')}/silver/{name}")
    if a.stage in ("gold", "all"):
        from offblock.plans.gold import build_gold

        done["gold"], _ = build_gold(spark, p["silver"], a.out)
    if a.stage in ("train", "all"):
        from offblock.plans.train import train_all

        models = [m for m in a.models.split(",") if m]
        spaces = {m: _quick_space(m) for m in models} if a.quick else None
        trials = {m: a.trials for m in models} if a.trials else None
        done["train"] = [(r.model_type, r.run_id, r.metrics) for r in
                         train_all(spark, models, p["gold"], p["runs"], p["models"], spaces, trials)]
    if a.stage in ("predict", "all"):
        from offblock.plans.predict import create_predictions

        mt = a.model_type if a.stage == "predict" else (a.models.split(",")[0] or a.model_type)
        dash = create_predictions(spark, p["gold"], p["runs"], mt, a.run_id, a.n_samples, a.seed, p["predictions"],
                                  best_of_type=not a.best_over_all_types)
        done["predict"] = dash.count()
    return done


if __name__ == "__main__":
    print(run(sys.argv[1:]))
