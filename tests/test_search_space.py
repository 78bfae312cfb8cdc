"""The registered model queries search the library's whole spaces."""

import types

from offblock.constants import SEARCH_SPACES
from offblock.ml.models import DEFAULT_TRIALS, MODEL_TYPES, sample_param_maps
from offblock.plans import catalog


def test_queries_search_the_whole_spaces(monkeypatch):
    asked = {}

    def train_model(spark, family, gold, runs_path, models_dir, space=None, n_trials=None):
        asked[family] = sample_param_maps(family, space, n_trials)

    monkeypatch.setattr("offblock.plans.train.train_model", train_model)
    monkeypatch.setattr(catalog, "built_gold", lambda spark, sf: {"root": "/nowhere"})
    monkeypatch.setattr(catalog, "_TRAINED", {})
    session = types.SimpleNamespace(sparkContext=types.SimpleNamespace(applicationId="none"))
    for family in MODEL_TYPES:
        catalog._train(session, "/nowhere", family)
        assert asked[family] == sample_param_maps(family, SEARCH_SPACES[family]) and len(asked[family]) == DEFAULT_TRIALS[family]
        rounds = [m.get("numTrees") or m.get("maxIter") for m in asked[family]]
        assert family == "linear_regression" or (min(rounds) >= 100 and max(rounds) > min(rounds))
