"""The ten demo flights of the dashboard, as an in-code table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEMO_SCHEMA = (
    "`Departure Time` string, `Flight Number` string, Stand string, Runway string, "
    "`Predicted Taxi Time (s)` double, Weather double, Traffic double, Distance double, Aircraft double"
)

# The demo rows shown by the reference's dashboard.
DEMO_ROWS = [
    ("2019-12-31 20:30", "EJU8071", "STAND_97", "RUNWAY_2", 1044.1, -34.9, -55.9, -0.5, 11.7),
    ("2019-12-31 20:30", "W63310", "STAND_34", "RUNWAY_3", 1108.2, -53.4, 41.8, -1.3, -2.5),
    ("2019-12-31 20:50", "DY1319", "STAND_80", "RUNWAY_2", 1319.1, 8.3, 166.7, -0.8, 21.2),
    ("2019-12-31 20:55", "DY1337", "STAND_21", "RUNWAY_2", 855.1, 8.7, -217.2, -0.3, -59.8),
    ("2019-12-31 20:50", "TP1335", "STAND_166", "RUNWAY_4", 1280.1, 69.0, -57.5, 38.5, 106.5),
    ("2019-12-31 21:05", "W61620", "STAND_93", "RUNWAY_4", 1125.1, 21.2, -34.9, 2.2, 12.9),
    ("2019-12-31 21:25", "EI249", "STAND_26", "RUNWAY_4", 1328.1, 45.6, 105.7, 0.0, 53.1),
    ("2019-12-31 21:30", "DI7505", "STAND_77", "RUNWAY_3", 1114.2, -32.5, 36.4, 9.8, -23.1),
    ("2019-12-31 21:40", "VY7829", "STAND_127", "RUNWAY_2", 1088.9, -31.3, 3.7, 0.7, -7.8),
    ("2019-12-31 21:55", " W63032", "STAND_152", "RUNWAY_1", 953.0, -11.9, -179.4, 1.7, 19.0),
]


def demo_flights(spark: SparkSession) -> DataFrame:
    """Literal source (raw, before the dashboard's renames and parsing)."""
    return spark.createDataFrame(DEMO_ROWS, DEMO_SCHEMA)
