"""Regression metrics (R29) and row counts (R33), each one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offblock.operators.schema import q

EPS = 2.220446049250313e-16  # float64 machine epsilon, the MAPE floor


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row with rmse, mape, mae and population std of the residual."""
    y, p = q(label).cast("double"), q(prediction).cast("double")
    e = y - p
    return df.agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(EPS))).alias("mape"),
        F.avg(F.abs(e)).alias("mae"),
        F.stddev_pop(e).alias("std"),
    )


def metrics_dict(df: DataFrame, label: str, prediction: str = "prediction") -> dict[str, float]:
    return regression_metrics(df, label, prediction).first().asDict()


def row_counts(named: dict[str, DataFrame]) -> dict[str, int]:
    """Sizes of several sets."""
    return {k: v.count() for k, v in named.items()}
