"""Category dictionaries as tables, and one-hot vectors by joining them (R32, R41 at any number of values).

``encode.learn_categories`` and ``one_hot`` turn values into named columns, as the
dashboard contract asks. Here the values stay a table with their sorted
positions, however many there are, and rows get sparse vectors.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offblock.operators.schema import q
from offblock.session import cut_lineage

#: Values of a column that are broadcast to the rows; more are joined by a shuffle.
BROADCAST_VALUES = 10_000


def category_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, position): the distinct non-missing values of each column, numbered from 0 in binary order.

    Values are sorted by range; a row's number within its partition is part of
    its id, and the partitions' sizes, one number each, shift it. No list of
    values is collected.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), q(c).cast("string").alias("value")) for c in columns]))
    values = df.select(pairs.alias("p")).select("p.feature", "p.value").where(F.col("value").isNotNull()).distinct()
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = values.repartitionByRange(n, "feature", "value").sortWithinPartitions("feature", "value")
    d = cut_lineage(ranged.withColumn("id", F.monotonically_increasing_id()), "categories")
    part = F.shiftright("id", 33)
    sizes = {r["part"]: r["count"] for r in d.groupBy(part.alias("part")).count().collect()}
    if not sizes:
        return d.select("feature", "value", F.col("id").alias("position"))
    before, total = [], 0
    for p in sorted(sizes):
        before += [F.lit(p), F.lit(total).cast("long")]
        total += sizes[p]
    rank = F.element_at(F.create_map(*before), part) + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    d = d.select("feature", "value", rank.alias("rank"))
    first = {r["feature"]: r["least"] for r in d.groupBy("feature").agg(F.min("rank").alias("least")).collect()}  # a row a column
    start = F.create_map(*[x for c, k in first.items() for x in (F.lit(c), F.lit(k).cast("long"))])
    return d.select("feature", "value", (F.col("rank") - F.element_at(start, F.col("feature"))).alias("position"))


def one_hot_vectors(df: DataFrame, table: DataFrame, columns: list[str], out: str = "one_hot") -> DataFrame:
    """df with one sparse vector: a slot for each value of each column in turn; missing and unknown values set none.

    Each column is a join with its part of the table, broadcast up to BROADCAST_VALUES
    values. Vectors are made from their four fields inside the row: Spark ML's encoder
    and assembler would list every slot in the column's metadata, on the driver. Slots
    of a column follow those of the columns before it.
    """
    sizes = {r["feature"]: r["n"] for r in table.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    known = [c for c in columns if sizes.get(c)]
    if not known:
        raise ValueError("no column has a value")
    d, slots, start = df, [], 0
    for i, c in enumerate(known):
        side = table.where(F.col("feature") == c).select(F.col("value").alias(f"__v{i}"), F.col("position").alias(f"__p{i}"))
        side = F.broadcast(side) if sizes[c] <= BROADCAST_VALUES else side.hint("merge")
        d = d.join(side, q(c).cast("string") == F.col(f"__v{i}"), "left").drop(f"__v{i}")
        slots.append((F.col(f"__p{i}") + F.lit(start)).cast("int"))
        start += sizes[c]
    on = F.array_compact(F.array(*slots))
    fields = F.struct(F.lit(0).alias("type"), F.lit(start).alias("size"), on.alias("indices"), F.transform(on, lambda _: F.lit(1.0)).alias("values"))
    # a struct cannot be cast to a vector, but read as one
    vector = F.from_json(F.to_json(F.struct(fields.alias("v"))), T.StructType([T.StructField("v", VectorUDT())]))["v"]
    return d.withColumn(out, vector).drop(*[f"__p{i}" for i in range(len(known))])
