"""Models of few rows are fitted within tasks: they are those that Spark jobs a level give."""

import numpy as np
import pytest
from test_histogram import RULES, P, data, frame  # noqa: F401

from offblock.ml import explain as E
from offblock.ml import histogram as H
from offblock.ml.features import FeatureSpec

PARAMS = [RULES["penalties"], P(rounds=3, depth=3, rows=0.7, columns=0.6, bins=5), P(growth="symmetric", rounds=3, depth=3, temperature=0.7, strength=1.0),
          P(growth="leaf", rounds=2, depth=9, leaves=9), P(forest=True, bootstrap=True, rounds=12, depth=5, node_columns="sqrt"),
          P(forest=True, rounds=2, depth=3, columns=0.5, node_columns="log2")]


def test_same_trees_and_errors_as_by_levels(spark, data, monkeypatch):  # noqa: F811
    x, y = data
    df, late = frame(spark, x, y), frame(spark, x[::3] + 0.25, y[::3])
    passes, run = [], H._pass
    monkeypatch.setattr(H, "_pass", lambda *a: (passes.append(1), run(*a)))
    here, errors = H.fit_many(df, "y", PARAMS), H.holdout_errors(df, late, "y", PARAMS)
    assert not passes  # no job a level, so hundreds of rounds are no hundreds of jobs
    monkeypatch.setattr(H, "LOCAL_BYTES", 0)
    monkeypatch.setattr(H, "FOREST_ROWS", 4000)  # several goes
    monkeypatch.setattr(H, "MARGIN_ROUNDS", 2)
    together = H.fit_many(df, "y", PARAMS)
    assert passes
    for a, b in zip(here, together, strict=True):
        assert a.base == b.base and len(a.trees) == len(b.trees)
        for s, t in zip(a.trees, b.trees, strict=True):
            assert all(np.array_equal(s[k], t[k], equal_nan=True) for k in s)
    assert errors == pytest.approx(H.squared_errors(together, late, "y"), rel=1e-12)
    assert H.holdout_errors(df, late, "y", [PARAMS[3], PARAMS[5]]) == pytest.approx([errors[3], errors[5]], rel=1e-12)
    none = H.holdout_errors(df, late.where("id < 0"), "y", PARAMS[:1])
    assert np.isnan(none[0])


def test_large_models_stay_in_a_table(spark, data, tmp_path, monkeypatch):  # noqa: F811
    x, y = data
    df = frame(spark, x, y)
    params = [P(forest=True, bootstrap=True, rounds=12, depth=6, node_columns="sqrt"), P(rounds=3)]
    plain = H.fit_many(df, "y", params)[0]
    by_id = lambda d: d.orderBy("id").toPandas()
    want = by_id(plain.transform(df))["prediction"]
    monkeypatch.setattr(H, "BLOCK_NODES", 200)
    monkeypatch.setattr(E, "BLOCK_LEAVES", 200)
    large = H.fit_many(df, "y", params)[0]
    large.save(spark, str(tmp_path / "m"))
    again = H.HistogramModel.load(spark, str(tmp_path / "m"))
    spec = FeatureSpec("y", list("abcd"), list("abcd"), list("abcd"), for_trees=True, native=True)
    for m in (large, again):
        assert not m.trees and len(m.tree_sizes()) == 12
        assert np.allclose(by_id(m.transform(df))["prediction"], want, atol=1e-12)
    monkeypatch.setattr(H, "LOCAL_BYTES", 0)
    monkeypatch.setattr(H, "FOREST_ROWS", 5 * len(y))
    together = H.fit_many(df, "y", params[:1])[0]
    assert not together.trees and together.tree_sizes() == large.tree_sizes()
    assert np.allclose(by_id(together.transform(df))["prediction"], want, atol=1e-12)
    parts = by_id(E.explain_trees(spark, again, again.transform(df), spec, ["id", "prediction"]))
    assert np.allclose(parts[[E.attribution_column(c) for c in "abcd"]].sum(axis=1) + parts["base_value"], want, atol=1e-9)
