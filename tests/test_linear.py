"""Least squares of smallest norm against a dense solver."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from offblock.ml import linear as L


def frame(spark, x, y, parts=5):
    rows = [(a.tolist(), None if b is None else float(b)) for a, b in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, "x array<double>, y double").repartition(parts).select(array_to_vector("x").alias("features"), "y")


def dense(x, y, intercept):
    if not intercept:
        return np.linalg.lstsq(x, y, rcond=None)[0], 0.0
    w = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=None)[0]
    return w, y.mean() - x.mean(0) @ w


@pytest.fixture(scope="module")
def collinear():
    r = np.random.default_rng(8)
    kind, other = r.integers(0, 5, 400), r.integers(0, 3, 400)
    x = np.column_stack([np.eye(5)[kind], np.eye(3)[other], r.normal(size=400) * 1e4, np.ones(400), r.normal(size=(400, 4)) * 1e-3])
    x = np.column_stack([x, x[:, 8] * 2 + 1])
    return x, x @ r.normal(size=x.shape[1]) + r.normal(size=400)


@pytest.mark.parametrize("intercept", [True, False])
def test_collinear_inputs(spark, collinear, monkeypatch, intercept):
    x, y = collinear
    w, b = dense(x, y, intercept)
    for merge in (L.MERGE_BYTES, 1):  # all factors at once, and two at a time
        monkeypatch.setattr(L, "MERGE_BYTES", merge)
        m = L.fit_least_squares(frame(spark, x, y), "y", intercept)
        assert np.allclose(m.coefficients.toArray(), w, rtol=1e-6, atol=1e-8) and m.intercept == pytest.approx(b, rel=1e-6, abs=1e-6)


def test_more_inputs_than_rows_and_wide(spark):
    r = np.random.default_rng(2)
    x, y = r.normal(size=(150, 400)), r.normal(size=150)
    m = L.fit_least_squares(frame(spark, x, y), "y")
    w, b = dense(x, y, True)
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-8) and m.intercept == pytest.approx(b)


def test_rows_without_label_missing_inputs_and_empty(spark, tmp_path):
    x = np.array([[1.0], [2.0], [3.0], [9.0]])
    m = L.fit_least_squares(frame(spark, x, [1.0, 2.0, 3.0, None]), "y")
    m.save(spark, str(tmp_path / "m"))
    again = L.LeastSquaresModel.load(spark, str(tmp_path / "m"))
    got = again.transform(frame(spark, np.array([[7.0], [np.nan]]), [0.0, 0.0], 1)).toPandas()["prediction"]
    assert got[0] == pytest.approx(7.0) and np.isnan(got[1])
    with pytest.raises(ValueError):
        L.fit_least_squares(frame(spark, x, [None] * 4), "y")
    with pytest.raises(ValueError):
        L.fit_least_squares(frame(spark, np.array([[1.0], [np.nan]]), [1.0, 2.0]), "y")
