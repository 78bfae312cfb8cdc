"""Minimum-norm least squares (R61) by a tree of QR factors.

Each task folds its rows [1, x, y] into one triangular factor; factors are merged
in groups until one is left. Its part below the constant column is the factor of
the centred rows, with the singular values of the whole table: the solution of
smallest norm comes from its singular value decomposition, as a dense solver's
would. Collinear inputs (one-hot groups) need no ridge. A task holds two factors,
16 * (inputs + 2) ** 2 bytes, whatever the number of rows.
"""

from __future__ import annotations

import json
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offblock.ml.features import VECTOR
from offblock.operators.schema import q
from offblock.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of the factors that one task merges, two at least.
MERGE_BYTES = 64 << 20
FACTOR = "part int, n long, r binary"


class LeastSquaresModel:
    """prediction = intercept + x . coefficients; missing inputs give NaN."""

    def __init__(self, coefficients: list[float], intercept: float):
        self.coefficients, self.intercept = DenseVector(coefficients), float(intercept)

    def transform(self, df: DataFrame) -> DataFrame:
        w, b = self.coefficients.toArray(), self.intercept

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            return pd.Series(np.stack(x.to_numpy()).astype(float) @ w + b if len(x) else [], dtype=float)

        return df.withColumn("prediction", score(vector_to_array(F.col(VECTOR))))

    def save(self, spark: SparkSession, path: str) -> None:
        about = json.dumps({"coefficients": self.coefficients.toArray().tolist(), "intercept": self.intercept})
        spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LeastSquaresModel:
        return LeastSquaresModel(**json.loads(spark.read.text(path).first()["value"]))


def triangle(rows: np.ndarray) -> np.ndarray:
    """The triangular factor of some rows, square (with empty rows below if there are few)."""
    r = np.linalg.qr(rows, mode="r")
    out = np.zeros((rows.shape[1], rows.shape[1]))
    out[: len(r)] = r
    return out


def factor(df: DataFrame, label: str) -> tuple[int, np.ndarray]:
    """(rows, triangular factor of [1, x, y]) of the rows that have a label."""
    d = df.where(q(label).isNotNull()).select(vector_to_array(F.col(VECTOR)).alias("x"), q(label).cast("double").alias("y"))

    def fold(batches):
        n, r, part = 0, None, TaskContext.get().partitionId()
        for batch in batches:
            k = batch.num_rows
            if not k:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(k, -1)
            a = np.column_stack([np.ones(k), x, batch.column("y").to_numpy()])
            r = triangle(a if r is None else np.vstack([r, a]))
            n += k
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["part", "n", "r"])

    def merge(t: pa.Table) -> pa.Table:
        parts = [np.frombuffer(b) for b in t.sort_by("part").column("r").to_pylist()]
        size = round(len(parts[0]) ** 0.5)
        r = triangle(np.vstack([x.reshape(size, size) for x in parts]))
        return pa.table({"part": pa.array([t.column("group")[0].as_py()], pa.int32()), "n": [sum(t.column("n").to_pylist())], "r": pa.array([r.tobytes()], pa.binary())})

    factors = cut_lineage(d.mapInArrow(fold, FACTOR), "factors")
    while True:
        left = factors.agg(F.count(F.lit(1)).alias("k"), F.max(F.length("r")).alias("size"), F.max("part").alias("top")).first()
        if left["k"] <= 1:
            break
        fan = max(2, MERGE_BYTES // left["size"])
        grouped = factors.withColumn("group", F.floor(F.col("part") / fan).cast("int"))
        factors = cut_lineage(grouped.groupBy("group").applyInArrow(merge, FACTOR), "factors")
    only = factors.first()
    if only is None:
        raise ValueError("no rows with a label to learn from")
    flat = np.frombuffer(only["r"])
    size = round(len(flat) ** 0.5)
    return only["n"], flat.reshape(size, size)


def fit_least_squares(df: DataFrame, label: str, fit_intercept: bool = True) -> LeastSquaresModel:
    """Least squares of smallest norm; of the centred inputs, with an intercept."""
    n, r = factor(df, label)
    if not np.isfinite(r).all():
        raise ValueError("inputs of a linear fit must not be missing or infinite")
    p = len(r) - 2
    # the constant column comes first: what lies below its row belongs to the centred columns
    a, b = (r[1:, 1 : 1 + p], r[1:, 1 + p]) if fit_intercept else (r[:, 1 : 1 + p], r[:, 1 + p])
    u, s, vt = np.linalg.svd(a, full_matrices=False)
    keep = s > np.finfo(float).eps * max(n, p) * (s[0] if len(s) else 0.0)
    w = vt[keep].T @ ((u[:, keep].T @ b) / s[keep]) if keep.any() else np.zeros(p)
    intercept = (r[0, 1 + p] - r[0, 1 : 1 + p] @ w) / r[0, 0] if fit_intercept else 0.0
    return LeastSquaresModel(w.tolist(), intercept)


class LeastSquares:
    """The linear family's estimator."""

    def __init__(self, label: str, fit_intercept: bool = True):
        self.label, self.fit_intercept = label, fit_intercept

    def fit(self, df: DataFrame) -> LeastSquaresModel:
        return fit_least_squares(df, self.label, self.fit_intercept)
