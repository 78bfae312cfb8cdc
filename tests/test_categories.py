"""Category tables and sparse one-hot vectors, up to a million values."""

import pytest
from pyspark.sql import functions as F

from offblock.operators.categories import category_table, one_hot_vectors


def test_against_plain_python(spark):
    rows = [(i, v, w) for i, (v, w) in enumerate([("b", "x"), ("a", None), (None, "y"), ("B", "nan"), ("é", "x"), ("", "y"), ("b", "x")])]
    df = spark.createDataFrame(rows, "id long, v string, w string").repartition(3)
    table = category_table(df, ["v", "w"])
    want = {("v", x): i for i, x in enumerate(["", "B", "a", "b", "é"])} | {("w", x): i for i, x in enumerate(["nan", "x", "y"])}
    assert {(r.feature, r.value): r.position for r in table.collect()} == want
    other = spark.createDataFrame([(9, "unseen", "x")], df.schema)
    got = {r.id: r.one_hot for r in one_hot_vectors(df.unionByName(other), table, ["v", "w"]).collect()}
    for i, v, w in [*rows, (9, "unseen", "x")]:
        on = [want["v", v]] if ("v", v) in want else []
        on += [5 + want["w", w]] if ("w", w) in want else []
        assert got[i].size == 8 and [int(k) for k in got[i].toArray().nonzero()[0]] == on


def test_a_million_values(spark):
    df = spark.range(1_200_000).select("id", F.format_string("%07d", F.col("id") % 1_000_000).alias("v"))
    table = category_table(df, ["v"])
    bad = table.where(F.col("value").cast("long") != F.col("position")).count()
    assert bad == 0 and table.count() == 1_000_000
    slots = one_hot_vectors(df, table, ["v"]).select(F.explode(F.unwrap_udt("one_hot")["indices"]).alias("slot"))
    r = slots.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("slot").alias("d")).first()
    assert (r["n"], r["d"]) == (1_200_000, 1_000_000)


def test_empty(spark):
    empty = spark.createDataFrame([], "v string")
    assert category_table(empty, ["v"]).count() == 0
    with pytest.raises(ValueError):
        one_hot_vectors(empty, category_table(empty, ["v"]), ["v"])


def test_vectors_list_no_slots_in_metadata(spark):
    df = spark.range(30_000).select("id", F.format_string("%07d", F.col("id")).alias("v"), F.when(F.col("id") % 3 > 0, F.lit("x")).alias("w"))
    out = one_hot_vectors(df, category_table(df, ["v", "w"]), ["v", "w"])
    assert len(out.schema.json()) < 2_000
    got = {r.id: r.one_hot for r in out.where("id in (0, 1, 29999)").collect()}
    assert {i: (v.size, list(v.indices), list(v.values)) for i, v in got.items()} == {
        0: (30_001, [0], [1.0]), 1: (30_001, [1, 30_000], [1.0, 1.0]), 29_999: (30_001, [29_999, 30_000], [1.0, 1.0])}
