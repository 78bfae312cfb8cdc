"""Row ids that stay the same on any partitioning."""

from offblock.operators import identity
from offblock.plans.silver import silver_weather

ROWS = [("a", 1.0, None), ("a", 1.0, None), ("a", None, 1.0), (None, None, None), (None, None, None), (None, None, None), ("b", 2.0, 3.0)]


def test_ids_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(ROWS, "`No. x` string, y double, z double")
    got = [sorted(map(str, identity.content_ids(df.repartition(n), "id").collect())) for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2]
    ids = [r["id"] for r in identity.content_ids(df, "id").collect()]
    assert len(ids) == len(ROWS) and len(set(ids)) == len(ROWS)
    assert identity.content_ids(df.where("false"), "id").count() == 0
    wx = [sorted(map(str, silver_weather(df.repartition(n)).collect())) for n in (2, 5)]
    assert wx[0] == wx[1]


def test_copies_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(identity, "BLOCK", 3)
    df = spark.createDataFrame([("a",)] * 7 + [("b",)] * 3 + [("c",)], "k string")
    got = sorted(map(tuple, identity.numbered_copies(df, "copy").collect()))
    assert got == [("a", i) for i in range(7)] + [("b", i) for i in range(3)] + [("c", 0)]
