"""Model families, search spaces, holdout search, refit, persistence.

  linear_regression -> least squares of smallest norm by a tree of QR factors
  random_forest     -> bootstrapped trees, inputs drawn at each node
  xgboost           -> boosting, trees grown level by level
  lightgbm          -> boosting, trees grown by their best leaf
  catboost          -> boosting, symmetric trees on weighted rows
The tree families are those of ``ml.histogram``; every parameter of their search
spaces changes the fit. The rounds' draws differ from other libraries', so
accuracy is compared by metrics, not values.
"""

from __future__ import annotations

import itertools
import math
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offblock.constants import SEARCH_SPACES
from offblock.ml.features import VECTOR
from offblock.ml.histogram import BINS, HistogramModel, TreeParams, fit_many, holdout_errors
from offblock.ml.linear import LeastSquares, LeastSquaresModel

MODEL_TYPES = ("linear_regression", "xgboost", "lightgbm", "catboost", "random_forest")
DEFAULT_TRIALS = {"linear_regression": 2, "random_forest": 15, "xgboost": 30, "lightgbm": 30, "catboost": 30}
SEED = 42
TREE_FAMILIES = ("random_forest", "xgboost", "lightgbm", "catboost")
#: Depth where none is given and the family sets no other bound.
MAX_DEPTH = 64

# reference parameter names accepted in user spaces
ALIASES = {
    "fit_intercept": "fitIntercept", "n_estimators": None, "max_depth": "maxDepth", "learning_rate": "stepSize",
    "subsample": "subsamplingRate", "colsample_bytree": "featureSubsetStrategy", "min_child_weight": "minInstancesPerNode",
    "min_samples_leaf": "minInstancesPerNode", "max_features": "featureSubsetStrategy", "gamma": "minInfoGain",
    "num_leaves": "numLeaves", "min_child_samples": "minInstancesPerNode", "iterations": "maxIter", "depth": "maxDepth",
    "border_count": "maxBins",
}


def canonical(model_type: str, name: str) -> str:
    """The one name of a parameter that a space may call by another."""
    if name == "n_estimators":
        return "numTrees" if model_type == "random_forest" else "maxIter"
    return ALIASES.get(name) or name


def sample_param_maps(model_type: str, space: dict | None = None, n_trials: int | None = None,
                      seed: int = SEED) -> list[dict]:
    """Candidate parameter maps. All-list spaces within the budget are enumerated."""
    if model_type not in SEARCH_SPACES:
        raise ValueError(f"no model family named {model_type!r}")
    space = {canonical(model_type, k): v for k, v in (space or SEARCH_SPACES[model_type]).items()}
    n_trials = n_trials or DEFAULT_TRIALS[model_type]
    if all(isinstance(v, list) for v in space.values()):
        grid = [dict(zip(space, combo, strict=True)) for combo in itertools.product(*space.values())]
        if len(grid) <= n_trials:
            return grid
    rng = np.random.default_rng(seed)
    maps = []
    for _ in range(n_trials):
        m = {}
        for k, spec in space.items():
            if isinstance(spec, list):
                m[k] = spec[int(rng.integers(len(spec)))]
            elif isinstance(spec, dict):
                lo, hi, log = spec["low"], spec["high"], spec.get("log", False)
                if log:
                    v = math.exp(rng.uniform(math.log(lo), math.log(hi)))
                else:
                    v = rng.uniform(lo, hi)
                m[k] = int(round(v)) if spec.get("type") == "int" else float(v)
            else:
                m[k] = spec
        maps.append(m)
    return maps


def tree_params(model_type: str, params: dict) -> TreeParams:
    """The learner's settings for a family, by the names of a search space; what is not given has no effect."""
    p = {canonical(model_type, k): v for k, v in params.items()}
    share = p.get("featureSubsetStrategy")
    depth = int(p.get("maxDepth", -1 if model_type in ("lightgbm", "random_forest") else 6))
    common = {"depth": depth if depth >= 0 else MAX_DEPTH, "seed": SEED, "bins": min(BINS, int(p.get("maxBins", BINS)))}
    if model_type == "random_forest":
        return TreeParams(forest=True, bootstrap=p.get("bootstrap", True), rounds=int(p.get("numTrees", 100)), split_rows=int(p.get("min_samples_split", 2)),
                          child_rows=int(p.get("minInstancesPerNode", 1)), node_columns=share or "all", **common)
    common |= {"rounds": int(p.get("maxIter", 100)), "rate": float(p.get("stepSize", 0.1)), "rows": float(p.get("subsamplingRate", 1.0)),
               "columns": 1.0 if share in (None, "all") else float(share)}
    if model_type == "catboost":
        return TreeParams(growth="symmetric", lam=float(p.get("l2_leaf_reg", 0.0)), temperature=float(p.get("bagging_temperature", 0.0)),
                          strength=float(p.get("random_strength", 0.0)), **common)
    common |= {"alpha": float(p.get("reg_alpha", 0.0)), "lam": float(p.get("reg_lambda", 0.0)), "gamma": float(p.get("minInfoGain", 0.0))}
    least = p.get("minInstancesPerNode", 1)
    if model_type == "lightgbm":
        return TreeParams(growth="leaf", leaves=int(p.get("numLeaves", 31)), child_rows=int(least), **common)
    return TreeParams(growth="depth", child_weight=float(least), **common)


class TreeEstimator:
    """A tree family with its parameters; ``fit`` learns from the rows that have a label."""

    def __init__(self, model_type: str, label: str, params: dict):
        self.label, self.params = label, tree_params(model_type, params)

    def fit(self, df: DataFrame) -> HistogramModel:
        return fit_many(df, self.label, [self.params])[0]


def make_estimator(model_type: str, label: str, params: dict | None = None):
    """A regressor for a model family with the given (space or Spark) parameters."""
    if model_type == "linear_regression":
        named = {canonical(model_type, k): v for k, v in (params or {}).items()}
        return LeastSquares(label, fit_intercept=named.get("fitIntercept", True))
    if model_type in TREE_FAMILIES:
        return TreeEstimator(model_type, label, params or {})
    raise ValueError(f"no model family named {model_type!r}")


def rmse(model, df: DataFrame, label: str) -> float:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse").evaluate(model.transform(df))


def search_holdout(model_type: str, label: str, fit_part: DataFrame, val_part: DataFrame,
                   maps: list[dict], parallelism: int = 4) -> tuple[dict, list[tuple[dict, float]]]:
    """Fit each candidate on the early part, RMSE on the late part, keep the lowest; ties keep the earlier one.

    Candidates of a tree family are fitted each in tasks of their own if the rows are
    few, else together: the rows are read once a level for all of them. Linear ones are concurrent Spark jobs, ``parallelism`` at a time.
    """
    if model_type in TREE_FAMILIES:
        results = list(zip(maps, holdout_errors(fit_part, val_part, label, [tree_params(model_type, m) for m in maps]), strict=True))
    else:
        def trial(m: dict) -> tuple[dict, float]:
            model = make_estimator(model_type, label, m).fit(fit_part)
            return m, rmse(model, val_part, label)

        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(maps)))) as pool:
            results = list(pool.map(trial, maps))
    best = min(results, key=lambda r: (math.isnan(r[1]), r[1]))[0]
    return best, results


def batch_score(model, df: DataFrame) -> DataFrame:
    """Predictions for every row (NaN from missing linear inputs -> NULL)."""
    out = model.transform(df)
    return out.withColumn("prediction", F.nanvl(F.col("prediction"), F.lit(None).cast("double")))


def save_model(model, path: str) -> None:
    """Persist (overwrite)."""
    model.save(SparkSession.active(), path)


def load_model(path: str, model_type: str):
    """Load by type; an unknown type raises."""
    if model_type in TREE_FAMILIES:
        return HistogramModel.load(SparkSession.active(), path)
    if model_type == "linear_regression":
        return LeastSquaresModel.load(SparkSession.active(), path)
    raise ValueError(f"no model family named {model_type!r}; there are {', '.join(MODEL_TYPES)}")
