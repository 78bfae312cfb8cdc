"""File scans and sinks.

CSV is read as text, the reader's NA tokens become NULL, and column types are
then inferred in ONE aggregate pass (a count of values that survive a cast per
column), so a stray ``NA`` in a numeric column does not turn it into text.
"""

from __future__ import annotations

from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text read as missing by the reference's CSV reader (its defaults).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _null_tokens(c: str):
    col = F.col(f"`{c}`")
    return F.when(col.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(col).alias(c)


def has_quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Whether some line of the files ends inside quotes: it holds an odd number of them."""
    line = spark.read.text(path).select((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("n"))
    return not line.where(F.col("n") % 2 == 1).isEmpty()


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool | None = None) -> DataFrame:
    """Headered CSV; NA tokens -> NULL; types inferred (or taken from ``schema``).

    multi_line: whether values hold line breaks, which makes each file one task;
    None: a split pass over the lines finds out. Without, files are read in splits.
    """
    if multi_line is None:
        multi_line = has_quoted_breaks(spark, path)
    raw = spark.read.options(header=True, inferSchema=False, quote='"', escape='"', multiLine=multi_line).csv(path)
    cleaned = raw.select(*[_null_tokens(c) for c in raw.columns])
    if schema is not None:
        return cleaned.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    # one pass: per column, how many non-null values cast to long / double
    probes = []
    for i, c in enumerate(raw.columns):
        col = F.col(f"`{c}`")
        probes += [
            F.count(col).alias(f"n{i}"),
            F.count(col.try_cast("bigint")).alias(f"l{i}"),
            F.count(col.try_cast("double")).alias(f"d{i}"),
            F.count_if(col.isin("True", "False", "TRUE", "FALSE", "true", "false")).alias(f"b{i}"),
        ]
    stats = cleaned.agg(*probes).first()
    out = []
    for i, c in enumerate(raw.columns):
        n, nl, nd = stats[f"n{i}"], stats[f"l{i}"], stats[f"d{i}"]
        col = F.col(f"`{c}`")
        if n > 0 and stats[f"b{i}"] == n:
            out.append(col.cast("boolean").alias(c))
        elif n > 0 and nl == n:
            out.append(col.cast("bigint").alias(c))
        elif n > 0 and nd == n:
            out.append(col.cast("double").alias(c))
        elif n == 0:
            out.append(col.cast("double").alias(c))  # an all-missing column reads as float
        else:
            out.append(col.alias(c))
    return cleaned.select(*out)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Columnar scan (Catalyst prunes columns and pushes filters into it)."""
    return spark.read.parquet(path)


def scan_by_suffix(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Pick the reader by lower-cased suffix; unknown suffix raises ``ValueError``."""
    suffix = PurePath(path).suffix.lower()
    if suffix == ".csv":
        return scan_csv(spark, path, schema)
    if suffix == ".parquet":
        return scan_parquet(spark, path)
    if suffix in (".xlsx", ".xls"):
        raise NotImplementedError("workbooks are not read; export them to CSV or Parquet first")
    raise ValueError(f"no reader for files that end in {suffix!r}")


def sink_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a Parquet directory (parents are created by the writer)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def sink_csv(df: DataFrame, path: str) -> None:
    """Overwrite a headered CSV directory."""
    df.write.mode("overwrite").options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="").csv(path)
