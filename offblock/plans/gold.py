"""R78 build_gold: silver -> two gold variants (default with missing values, clean).

Per set (train, then test with train's learned state):
  R21 distance join -> R10 weather prune -> R22 weather join (test uses the
  TRAINING weather, as the reference does) -> R18/R19 flags -> R16 filter ->
  R46/R48 delay -> R34 traffic (per set, after the filter) -> encode (R45,
  R41, R51, R12) -> write default -> R27/R52 medians (train) -> write clean.
R37's off-block order is not imposed on the files (no global sort shuffle);
every consumer orders or splits by the carried keys.

Spark plan notes: the distance side is broadcast (size-checked); the weather
join is a shuffle join on the four text keys; the filter is pushed below both
joins by Catalyst; the traffic count is the bucketed window of ``traffic``.
The joined, filtered frame is written once per set (a Parquet checkpoint, before
the traffic count), so the traffic count, category learning and the encoded
write read it instead of re-running the joins; the written default table then
feeds the medians. Train and test joins, and the test write alongside the
training medians, run as concurrent jobs.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offblock.constants import (
    AOBT, CATEGORICAL_COLUMNS, DELAY_SECONDS, FLIGHT_DATETIME, ORDER_TS, ROW_ID, TARGET, WEATHER_DROP_COLUMNS,
)
from offblock.functions.datetime import delay_seconds, parse_mdy_hm
from offblock.operators.encode import EncodingState, encode_features, learn_categories_many
from offblock.operators.filters import add_helicopter_flag, add_private_flag, filter_taxi_range
from offblock.operators.impute import handle_missing
from offblock.operators.joins import join_distance, join_weather
from offblock.operators.schema import drop_if_exists, q
from offblock.operators.traffic import planes_in_window
from offblock.session import cut_lineage
from offblock.sources.files import sink_parquet

WEATHER_KEYS = [FLIGHT_DATETIME, "Aircraft Model", AOBT, "ATOT"]
ROW_KEYS = [ROW_ID, ORDER_TS, "wx_row_id"]


@dataclass
class GoldState:
    encoding: EncodingState = field(default_factory=EncodingState)
    medians: dict[str, float | None] = field(default_factory=dict)


def joined_and_filtered(airport: DataFrame, geography: DataFrame, weather: DataFrame) -> DataFrame:
    """Steps 2-7: distance and weather joins, flags, taxi filter, delay (lazy)."""
    df = join_distance(airport, geography)
    wx = drop_if_exists(weather, WEATHER_DROP_COLUMNS)
    df = join_weather(df, wx, [k for k in WEATHER_KEYS if k in wx.columns])
    df = add_helicopter_flag(add_private_flag(df))
    df = filter_taxi_range(df, TARGET)
    aobt = parse_mdy_hm(q(AOBT))
    df = df.withColumns({DELAY_SECONDS: delay_seconds(aobt, parse_mdy_hm(q(FLIGHT_DATETIME))), ORDER_TS: aobt})
    return df.drop(FLIGHT_DATETIME)


def add_traffic(df: DataFrame) -> DataFrame:
    """Step 8: traffic counts over this set (after the filter, as the reference)."""
    return planes_in_window(df, ORDER_TS)


def features_before_encoding(airport: DataFrame, geography: DataFrame, weather: DataFrame) -> DataFrame:
    """Steps 2-8 of the reference's gold stage, lazily."""
    return add_traffic(joined_and_filtered(airport, geography, weather))


def encode(df: DataFrame, state: EncodingState | None, categories: dict[str, list[str]] | None = None
           ) -> tuple[DataFrame, EncodingState]:
    parsed = {AOBT: ORDER_TS} if ORDER_TS in df.columns else None
    return encode_features(df, [AOBT], CATEGORICAL_COLUMNS, state, keep=ROW_KEYS, categories=categories, parsed=parsed)


def build_gold(spark: SparkSession, silver: dict[str, str], out_dir: str) -> tuple[dict[str, str], GoldState]:
    """Write gold default/clean for train and test; return paths and the learned state.

    Independent jobs run concurrently (train and test joins; the test encoding
    and the training medians); everything the test set uses is learned on the
    training set first.
    """
    read = spark.read.parquet
    geo, wx = read(silver["geography"]), read(silver["weather"])
    state = GoldState()
    base = out_dir.rstrip("/") + "/gold"
    paths = {f"{p}_{v}": f"{base}/{p}_{v}" for p in ("train", "test") for v in ("default", "clean")}

    def joined(part: str) -> DataFrame:
        # one written checkpoint after the joins: the traffic count and the
        # encoded write both read it instead of re-running the joins
        return cut_lineage(joined_and_filtered(read(silver[f"airport_{part}"]), geo, wx), f"gold-{part}")

    def write_default(part: str, df: DataFrame) -> None:
        # no global sort: consumers use the carried keys, not file order; a sort
        # within each task keeps row-group min/max on aobt_ts tight for pruning
        sink_parquet(df.sortWithinPartitions(F.asc_nulls_last(ORDER_TS), ROW_ID, "wx_row_id"), paths[f"{part}_default"])

    def clean(part: str) -> dict[str, float | None]:
        df, meds = handle_missing(read(paths[f"{part}_default"]), state.medians if part == "test" else None,
                                  exclude=ROW_KEYS)
        sink_parquet(df, paths[f"{part}_clean"])
        return meds

    with ThreadPoolExecutor(max_workers=2) as pool:
        j_train, j_test = pool.submit(joined, "train"), pool.submit(joined, "test")
        train_j, test_j = j_train.result(), j_test.result()
        cats = learn_categories_many(train_j, CATEGORICAL_COLUMNS)
        enc_train, state.encoding = encode(add_traffic(train_j), None, cats)
        write_default("train", enc_train)
        enc_test, _ = encode(add_traffic(test_j), state.encoding)
        test_write = pool.submit(write_default, "test", enc_test)
        state.medians = clean("train")
        test_write.result()
    # test-only missing columns keep the test median, as the reference stores it
    state.medians = clean("test")
    return paths, state
