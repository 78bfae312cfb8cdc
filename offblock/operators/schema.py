"""Schema operators (R07-R14): text casts, renames, drops, conforming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offblock.constants import MODEL_DATASET
from offblock.functions.text import text_or_nan


def q(name: str):
    """Column reference that survives spaces, dots and slashes in names."""
    return F.col(f"`{name}`")


def stringify_text(df: DataFrame) -> DataFrame:
    """Every text column: missing -> ``'nan'``."""
    casts = {f.name: text_or_nan(q(f.name)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns(casts) if casts else df


def rename_ci(df: DataFrame, targets: tuple[str, ...] = ("runway", "stand")) -> DataFrame:
    """Case-insensitive rename of the given headers to their lower-case names."""
    mapping = {c: t for c in df.columns for t in targets if c.lower() == t and c != t}
    return df.withColumnsRenamed(mapping) if mapping else df


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Plain renames (unknown names are ignored)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_if_exists(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df


def cast_keys_to_text(df: DataFrame, keys: list[str]) -> DataFrame:
    """Join keys as text, missing as ``'nan'`` so missing keys meet each other."""
    return df.withColumns({k: text_or_nan(q(k)) for k in keys if k in df.columns})


def conform_to_columns(df: DataFrame, order: list[str], keep: list[str] | None = None) -> DataFrame:
    """Add absent columns as 0, drop extras, order as ``order`` (``keep`` columns go first)."""
    keep = [c for c in (keep or []) if c in df.columns and c not in order]
    cols = [q(c) for c in keep]
    cols += [q(c) if c in df.columns else F.lit(0).alias(c) for c in order]
    return df.select(*cols)


def split_features_label(df: DataFrame, label: str, non_features: list[str] | None = None) -> list[str]:
    """Feature names = every column except the label and non-feature keys."""
    skip = {label, *(non_features or [])}
    return [c for c in df.columns if c not in skip]


def route_dataset(model_type: str, default_df: DataFrame, clean_df: DataFrame, strict: bool = False) -> DataFrame:
    """Gold variant per model; unknown model -> ``default`` (or raise when ``strict``)."""
    if model_type not in MODEL_DATASET:
        if strict:
            raise ValueError(f"no gold variant is set for {model_type!r}; families: {', '.join(MODEL_DATASET)}")
        return default_df
    return clean_df if MODEL_DATASET[model_type] == "clean" else default_df
