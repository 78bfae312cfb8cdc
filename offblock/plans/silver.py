"""R77 build_silver: bronze tables -> typed, standardised silver Parquet.

airport:   (test only: R47 datetime text) -> R07 text 'nan' -> R08 header case
geography, test_geography: R07 -> R50 id bump
weather:   R07, plus a row id (``wx_row_id``, a hash of the row and its number
           among equal rows) that makes fan-out rows distinguishable downstream
test_weather, ac_characteristics, glossary: R07
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from offblock.constants import AOBT, ATOT, FLIGHT_DATETIME
from offblock.functions.datetime import standardize_datetime_text
from offblock.functions.text import bump_id
from offblock.operators.identity import content_ids
from offblock.operators.schema import q, rename_ci, stringify_text
from offblock.sources import driver_tables as dt
from offblock.sources.files import sink_parquet

SILVER_TABLES = ("airport_train", "airport_test", "geography", "test_geography", "weather", "test_weather", "ac_characteristics", "glossary")


def standardize_datetime_columns(df: DataFrame, cols: tuple[str, ...] = (FLIGHT_DATETIME, AOBT, ATOT)) -> DataFrame:
    """R47 over the datetime columns present."""
    return df.withColumns({c: standardize_datetime_text(q(c)) for c in cols if c in df.columns})


def silver_airport(df: DataFrame, normalise_datetimes: bool) -> DataFrame:
    if normalise_datetimes:
        df = standardize_datetime_columns(df)
    return rename_ci(stringify_text(df))


def silver_geography(df: DataFrame) -> DataFrame:
    df = stringify_text(df)
    return df.withColumns({c: bump_id(q(c)) for c in ("runway", "stand") if c in df.columns})


def silver_weather(df: DataFrame) -> DataFrame:
    return content_ids(stringify_text(df), "wx_row_id")


def bronze_from_driver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The adapter's bronze-shaped tables."""
    return {
        "airport_train": dt.airport_train(spark, sf_dir),
        "airport_test": dt.airport_test(spark, sf_dir),
        "geography": dt.geography(spark, sf_dir),
        "weather": dt.weather_bronze(spark, sf_dir),
        "test_geography": dt.test_geography(spark, sf_dir),
        "test_weather": dt.test_weather(spark, sf_dir),
        "ac_characteristics": dt.ac_characteristics(spark, sf_dir),
        "glossary": dt.glossary(spark, sf_dir),
    }


def build_silver(bronze: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Write every silver table given, of SILVER_TABLES; return name -> path."""
    steps = {
        "airport_train": lambda d: silver_airport(d, normalise_datetimes=False),
        "airport_test": lambda d: silver_airport(d, normalise_datetimes=True),
        "geography": silver_geography,
        "test_geography": silver_geography,
        "weather": silver_weather,
        "test_weather": stringify_text,
        "ac_characteristics": stringify_text,
        "glossary": stringify_text,
    }
    unknown = sorted(set(bronze) - set(steps))
    if unknown:
        raise ValueError(f"no silver step for {', '.join(unknown)}; tables: {', '.join(SILVER_TABLES)}")
    paths = {name: f"{out_dir.rstrip('/')}/silver/{name}" for name in bronze}
    # the tables are independent: submit their writes as concurrent Spark jobs
    with ThreadPoolExecutor(max_workers=max(1, len(bronze))) as pool:
        futures = [pool.submit(sink_parquet, steps[name](df), paths[name])
                   for name, df in bronze.items()]
        for f in futures:
            f.result()
    return paths
