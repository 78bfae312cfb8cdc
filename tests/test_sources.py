import uuid

import pytest

from offblock.session import scratch_path
from offblock.sources.files import scan_by_suffix, scan_csv, sink_csv
from offblock.sources.literal import demo_flights


def test_scan_csv_na_tokens_and_types(spark):
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}") + ".csv"
    df = spark.createDataFrame([("1", "2.5", "a"), ("NA", "nan", "None"), ("3", "", "b")], "x string, y string, z string")
    df.coalesce(1).write.option("header", True).csv(path)
    out = scan_csv(spark, path)
    assert dict(out.dtypes) == {"x": "bigint", "y": "double", "z": "string"}
    rows = sorted(out.collect(), key=lambda r: (r["x"] is None, r["x"] or 0))
    assert rows[-1]["x"] is None and rows[-1]["y"] is None and rows[-1]["z"] is None


def test_scan_by_suffix_dispatch(spark):
    with pytest.raises(ValueError):
        scan_by_suffix(spark, "/x/file.json")
    with pytest.raises(NotImplementedError):
        scan_by_suffix(spark, "/x/file.XLSX")


def test_sink_csv_roundtrip(spark):
    path = scratch_path(spark, f"csvout-{uuid.uuid4().hex}")
    sink_csv(spark.createDataFrame([(1, 2.0)], "a long, b double"), path)
    assert scan_csv(spark, path).collect()[0].asDict() == {"a": 1, "b": 2.0}


def test_demo_literal(spark):
    df = demo_flights(spark)
    assert df.count() == 10 and df.where("`Flight Number` = ' W63032'").count() == 1


def test_dashboard_cards_from_demo(spark):
    from offblock.plans.dashboard import dashboard_cards

    cards, drivers = dashboard_cards(demo_flights(spark), 10)
    rows = {r["Flight"]: r for r in cards.collect()}
    assert len(rows) == 10 and "W63032" in rows  # the leading space is trimmed
    assert rows["DY1319"]["Departure"] == "20:50" and rows["DY1319"]["Predicted taxi time (min)"] == 22.0
    assert rows["EJU8071"]["Runway base (min)"] == 17
    first = {r["Flight"]: r["category"] for r in drivers.where("rank = 1").collect()}
    assert first["DY1337"] == "Traffic" and first["TP1335"] == "Aircraft"
    assert drivers.count() == 40
