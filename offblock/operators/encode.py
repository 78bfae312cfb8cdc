"""Encoding (R32, R41, R44/R45, R51, R12 in the gold contract)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offblock.constants import AIRCRAFT_MODEL, ATOT, RUNWAY, STAND
from offblock.functions.datetime import cyclical_pair, parse_mdy_hm
from offblock.functions.text import digits_to_int
from offblock.operators.schema import conform_to_columns, drop_if_exists, q


def learn_categories(df: DataFrame, col: str) -> list[str]:
    """Sorted distinct non-missing values (binary order), distinct computed on the cluster.

    The list becomes column names, so the driver holds what the schema will hold;
    there is no limit on it.
    """
    rows = df.select(q(col).cast("string").alias("v")).where(F.col("v").isNotNull()).distinct().collect()
    return sorted(r["v"] for r in rows)


def learn_categories_many(df: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    """R32 for several columns with ONE distinct job."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), q(c).cast("string").alias("v"))
                                 for i, c in enumerate(cols)]))
    rows = df.select(pairs.alias("p")).select("p.k", "p.v").where(F.col("v").isNotNull()).distinct().collect()
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        out[cols[r["k"]]].append(r["v"])
    for vals in out.values():
        vals.sort()
    return out


def one_hot(df: DataFrame, col: str, categories: list[str], drop_source: bool = True) -> DataFrame:
    """``<col>_<value>`` 0/1 columns; NULL -> all 0; literal ``'nan'`` is its own value."""
    c = q(col)
    dummies = [F.coalesce(c == F.lit(v), F.lit(False)).cast("int").alias(f"{col}_{v}") for v in categories]
    base = [q(x) for x in df.columns if not (drop_source and x == col)]
    return df.select(*base, *dummies)


DATETIME_PARTS = (("hour", 24), ("day_of_week", 7), ("month", 12), ("day_of_month", 31))


def datetime_features(df: DataFrame, col: str, drop_source: bool = True, parsed: str | None = None) -> DataFrame:
    """hour/24, weekday(Mon=0)/7, month/12, day/31 each as sin/cos (R44); missing -> NULL.

    The text is parsed once into a column (``parsed`` names one already holding
    the parsed time); the eight outputs read that column instead of each
    repeating the parse.
    """
    tmp = parsed or "__parsed_ts"
    out = df if parsed else df.withColumn(tmp, parse_mdy_hm(q(col)))
    ts = F.col(tmp)
    parts = {"hour": F.hour(ts), "day_of_week": F.weekday(ts), "month": F.month(ts), "day_of_month": F.dayofmonth(ts)}
    new = {}
    for name, period in DATETIME_PARTS:
        s, c = cyclical_pair(parts[name], period)
        new[f"{col}_{name}_sin"] = s
        new[f"{col}_{name}_cos"] = c
    out = out.withColumns(new)
    if not parsed:
        out = out.drop(tmp)
    return out.drop(col) if drop_source else out


@dataclass
class EncodingState:
    """Learned on the training set, applied to the test set."""
    categories: dict[str, list[str]] = field(default_factory=dict)
    column_order: list[str] = field(default_factory=list)


def encode_features(df: DataFrame, datetime_cols: list[str], categorical_cols: list[str],
                    state: EncodingState | None = None, keep: list[str] | None = None,
                    strict_ids: bool = True, categories: dict[str, list[str]] | None = None,
                    parsed: dict[str, str] | None = None) -> tuple[DataFrame, EncodingState]:
    """Cyclical datetimes, one-hot categories, integer stand/runway, frozen column order.

    With ``state=None`` categories and column order are learned (training);
    otherwise they are applied (test): absent dummies/columns become 0, extras
    are dropped and columns are put in the training order (R12). ``keep`` names
    non-feature columns carried in front (row keys) and never conformed away.
    ``categories`` supplies training categories learned elsewhere (e.g. from a
    checkpoint upstream of columns that do not affect them).
    """
    learn = state is None
    state = state or EncodingState()
    if learn:
        state.categories = categories if categories is not None else learn_categories_many(df, categorical_cols)
    for col in datetime_cols:
        if col in df.columns:
            df = datetime_features(df, col, parsed=(parsed or {}).get(col))
    for col in categorical_cols:
        if col in df.columns:
            df = one_hot(df, col, state.categories.get(col, []))
    df = drop_if_exists(df, [ATOT, AIRCRAFT_MODEL])
    ids = {c: digits_to_int(q(c), strict=strict_ids) for c in (STAND, RUNWAY) if c in df.columns}
    if ids:
        df = df.withColumns(ids)
    keep = [c for c in (keep or []) if c in df.columns]
    if learn:
        state.column_order = [c for c in df.columns if c not in keep]
    return conform_to_columns(df, state.column_order, keep=keep), state
