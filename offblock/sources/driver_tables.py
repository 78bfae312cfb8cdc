"""Adapter: the driver's tables as flight-shaped inputs.

No driver table is a flight table, so these views derive departures, weather
and airport geometry from ``events``, ``region`` and ``nation`` (see
FIXTURES.md §3). Each is a plain lazy projection of a Parquet scan: Catalyst
prunes it to the columns a query uses and nothing is collected.

Deviation from FIXTURES.md §3: ``stand`` is ``STAND_<user_id % 26>`` so that
it can meet the geography's ``STAND_1``..``STAND_25`` after R50
(``STAND_0`` is a deliberate join miss).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offblock.functions.datetime import format_mdy_hm, truncate_to_second

TRAIN_CUTOFF = "2024-01-25 00:00:00"


def _case(key: Column, mapping: list[tuple[int, object]], default: object, modulus: int) -> Column:
    expr = None
    for k, v in mapping:
        cond = (key % modulus) == k
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(default))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed departures: one row per event."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    fid = F.col("event_id")
    prefix = _case(fid, [(0, "NJE"), (1, "VJT"), (2, "PVT"), (3, "SIG"), (4, "BAW")], "af", 6)
    model = (F.when(fid % 5 == 0, F.lit("A109")).when(fid % 5 == 1, F.lit("407"))
             .when(fid % 5 == 2, F.lit(None).cast("string")).otherwise(F.lit("A320")))
    return ev.select(
        fid.alias("flight_id"),
        truncate_to_second(F.col("ts").cast("timestamp_ntz")).alias("aobt"),
        (fid * 37 % 1800).alias("lag_s"),
        F.when(fid % 101 == 0, F.lit(None).cast("double")).otherwise((F.col("value") * 100).cast("double")).alias("taxi"),
        F.concat(F.lit("STAND_"), (F.col("user_id") % 26).cast("string")).alias("stand"),
        F.concat(F.lit("RUNWAY_"), (fid % 4 + 1).cast("string")).alias("runway"),
        F.concat(prefix, fid.cast("string")).alias("flight_no"),
        model.alias("model"),
        (fid % 3 + 2).alias("engines"),
        ((fid % 40).cast("double") + F.lit(20.0)).alias("ac_length"),
    )


def weather(spark: SparkSession, sf_dir: str, fl: DataFrame | None = None) -> DataFrame:
    """Weather rows keyed by flight: misses ``flight_id % 10 = 3``, a duplicate for ``% 50 = 0``."""
    fl = fl if fl is not None else flights(spark, sf_dir)
    fid = F.col("flight_id")
    copies = F.when(fid % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    summary = (F.when(fid % 11 == 0, F.lit("nan")).when(fid % 13 == 0, F.lit(None).cast("string"))
               .when(fid % 2 == 0, F.lit("Clear")).otherwise(F.lit("Rain")))
    temperature = F.when(fid % 7 == 0, F.lit(None).cast("double")).otherwise((fid * 17 % 41).cast("double") / 2 - 5)
    return fl.where(fid % 10 != 3).select(
        "flight_id", "model", "aobt", "lag_s", "taxi",
        summary.alias("summary"),
        temperature.alias("temperature"),
        F.explode(copies).alias("copy_no"),
    )


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze geography: one row per (runway, stand) pair, 0-based names as in the source files."""
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey, "inner")
    return joined.select(
        F.concat(F.lit("Runway_"), F.col("r_regionkey").cast("string")).alias("runway"),
        F.concat(F.lit("Stand_"), F.col("n_nationkey").cast("string")).alias("stand"),
        (F.col("r_regionkey") * F.lit(7.5) - F.lit(10.0)).cast("double").alias("Lat_runway"),
        (F.col("r_regionkey") * F.lit(11.0) - F.lit(20.0)).cast("double").alias("Lng_runway"),
        (F.col("n_nationkey") * F.lit(1.3) - F.lit(15.0)).cast("double").alias("Lat_stand"),
        (F.col("n_nationkey") * F.lit(2.1) - F.lit(25.0)).cast("double").alias("Lng_stand"),
    )


# ---------------------------------------------------------------------------
# bronze-shaped tables with the reference's column names (for the stage chains)
# ---------------------------------------------------------------------------

def _airport_columns(fl: DataFrame, iso_text: bool) -> DataFrame:
    sched = F.col("aobt") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("lag_s").cast("decimal(18,6)"))
    atot = F.col("aobt") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("taxi").cast("decimal(18,6)"))
    fmt = (lambda c: truncate_to_second(c).cast("string")) if iso_text else format_mdy_hm
    return fl.select(
        "flight_id",
        fmt(sched).alias("Flight Datetime"),
        fmt(F.col("aobt")).alias("AOBT"),
        fmt(atot).alias("ATOT"),
        F.col("flight_no").alias("Flight Number"),
        F.col("model").alias("Aircraft Model"),
        F.col("runway").alias("Runway"),
        F.col("stand").alias("Stand"),
        F.col("ac_length").alias("Aircraft Length"),
        F.col("engines").alias("No. Engines"),
        F.col("taxi").alias("actual_taxi_out_sec"),
    )


def test_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze geography of the test season: the same points, stands named by customers' nations."""
    geo = geography(spark, sf_dir)
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.concat(F.lit("Stand_"), F.col("c_nationkey").cast("string")).alias("stand")).distinct()
    return geo.join(c, "stand", "left_semi").select(*geo.columns)


def test_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze weather of the test departures."""
    late = airport_test(spark, sf_dir).select(format_mdy_hm(F.col("AOBT").try_cast("timestamp_ntz")).alias("AOBT")).distinct()
    wx = weather_bronze(spark, sf_dir)
    return wx.join(late, "AOBT", "left_semi").select("Flight Datetime", "Aircraft Model", "AOBT", "summary", "temperature")


def ac_characteristics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze aircraft characteristics: the distinct models (one missing), engines and lengths."""
    fl = flights(spark, sf_dir)
    return fl.select(F.col("model").alias("Model"), F.col("engines").alias("Num_Engines"), F.col("ac_length").alias("Length_m")).distinct()


def glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze glossary: terms and their explanations (missing for some)."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    return p.select(F.col("p_name").alias("Term"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")).alias("Definition")).distinct()


def airport_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze training departures (datetimes already ``M/D/YYYY H:MM`` text)."""
    fl = flights(spark, sf_dir).where(F.col("aobt") < F.lit(TRAIN_CUTOFF).cast("timestamp_ntz"))
    return _airport_columns(fl, iso_text=False)


def airport_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze test departures (datetimes as ISO text, normalised by R47 in silver)."""
    fl = flights(spark, sf_dir).where(~(F.col("aobt") < F.lit(TRAIN_CUTOFF).cast("timestamp_ntz")))
    return _airport_columns(fl, iso_text=True)


def weather_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze weather: joined to departures on the four text keys, plus columns to drop."""
    fl = flights(spark, sf_dir)
    base = _airport_columns(fl, iso_text=False).select(
        "flight_id", "Flight Datetime", "Aircraft Model", "AOBT", "ATOT")
    fid = F.col("flight_id")
    copies = F.when(fid % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    summary = (F.when(fid % 11 == 0, F.lit(None).cast("string")).when(fid % 2 == 0, F.lit("Clear"))
               .otherwise(F.lit("Rain")))
    icon = _case(fid, [(0, "clear-day"), (1, "rain")], "cloudy", 3)
    precip = F.when(fid % 4 == 0, F.lit("rain")).when(fid % 4 == 1, F.lit("snow")).otherwise(F.lit(None).cast("string"))

    def num(expr: Column, null_mod: int) -> Column:
        return F.when(fid % null_mod == 0, F.lit(None).cast("double")).otherwise(expr.cast("double"))

    return base.where(fid % 10 != 3).select(
        "Flight Datetime", "Aircraft Model", "AOBT", "ATOT",
        summary.alias("summary"),
        icon.alias("icon"),
        precip.alias("precipType"),
        num((fid * 17 % 41) / 2 - 5, 7).alias("temperature"),
        num((fid % 100) / 100, 17).alias("humidity"),
        num(fid * 7 % 23, 19).alias("windSpeed"),
        num(fid % 10, 23).alias("visibility"),
        num(F.lit(1000) + fid % 30, 2).alias("pressure"),
        num((fid % 9) / 10, 3).alias("cloudCover"),
        num(fid % 5, 29).alias("dewPoint"),
        (fid % 24).alias("Hour"),
        (fid % 13).alias("N_dep_dep"),
        F.explode(copies).alias("copy_no"),
    ).drop("copy_no")
