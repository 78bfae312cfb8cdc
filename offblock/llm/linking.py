"""Links between rows that share a key, without all pairs of a group.

``link`` takes entries (key, node, n, pos): a node is a candidate partner of
every node that shares one of its keys. It returns the components of the graph
of true links, exactly, and verifies each pair at most once:

1. each node meets the first node and the node before it under each key; keys
   with very many nodes are salted into groups of at most HOT_NODES;
2. in rounds, one node of each component found so far under a key (another one
   for each key and round) meets one of the largest component there. A round is
   linear in the entries; rounds go on while they shrink what is left;
3. keys that still hold many nodes of different components are refined again and
   again (`refine`), by further keys that every true pair under the key shares,
   until few nodes meet under a key or nothing is left to tell them apart; step 2
   is repeated on the latter;
4. the pairs that are left, those under one key and in different components, are
   all verified, each taken from the first key that its nodes share.

Keys with the same nodes stand for the same pairs: one of them is kept, before each
round and each refinement, if pairs pass whatever the place of the key.

Pairs in one component need no check, since the components are the result.
Tables written on the way are deleted as soon as no later step reads them. The
steps after the first work on what is left, often little: they are written, and
handed to Python, in tasks of about TASK_ROWS rows, so that a round over few rows
does not pay for as many tasks and files as the shuffle has partitions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offblock.llm.common import larger, partitions, written
from offblock.session import drop_scratch

#: Nodes under one key that are paired in one group; more are salted.
HOT_NODES = 20_000
#: Step 2 goes on while a round leaves at most this share of the entries.
PROBE_SHRINK = 0.9
#: Keys with more nodes are refined in step 3.
REFINED_NODES = 32
#: Keys of a node before the one at hand that step 4 looks at to see whether a pair has met.
BEFORE = 64
#: New keys of an entry that is refined, about; it sizes tasks only.
REFINED_KEYS = 8
#: So many edges are joined to components in one task (16 bytes each), more in distributed rounds first.
FEW_EDGES = 200_000
#: Rows of a task that writes a step's table, and the fewest tasks; steps of more rows than that have more tasks.
TASK_ROWS = 10_000
FEWEST_TASKS = 24

Verify = Callable[[DataFrame, int], DataFrame]


def in_tasks(df: DataFrame, rows: int) -> DataFrame:
    """df, of about `rows` rows, in tasks of about TASK_ROWS; never in more than it has."""
    return df.coalesce(max(FEWEST_TASKS, -(-rows // TASK_ROWS)))


def forest(batches):
    """(node, component) of all nodes of the edges (u, v), by union-find."""
    root = {}

    def find(x):
        while (y := root.setdefault(x, x)) != x:
            root[x] = root[y]
            x = root[x]
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            u, v = find(u), find(v)
            if u != v:
                root[max(u, v)] = min(u, v)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(map(find, nodes), pa.int64())], names=["node", "component"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node each node of edges (a, b) can reach; a written table.

    Large-star and small-star steps in turn until nothing changes, or until at most
    FEW_EDGES edges are left, which one task joins (at once, if there are no more). Minima are aggregated before they
    are joined, so a node with very many links is never gathered in one task; each
    round is written, so lineage stays short.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    if edges.count() <= FEW_EDGES:
        return written(e.coalesce(1).mapInArrow(forest, "node long, component long"), "labels")
    e = written(e.distinct(), "edges")
    last = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] <= FEW_EDGES:
            out = e.coalesce(1).mapInArrow(forest, "node long, component long")
            break
        if now == last:
            roots = e.select(F.col("v").alias("node")).distinct()
            out = e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
            break
        last = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large-star: higher neighbours move to the lowest
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small-star: the lower neighbours and the node itself move to the lowest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, e = e, written(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        drop_scratch(before)
    out = written(out, "labels")
    drop_scratch(e)
    return out


def shared_entries(entries: DataFrame, rows: int | None = None) -> DataFrame:
    """The entries (key, node, ...) whose key has several nodes, each (key, node) once.

    The rows of a key are streamed in order of node; only the last row is held. rows:
    about how many entries there are, if they may be few.
    """
    import numpy as np

    def run(batches):
        held, paired = None, False  # the last row so far, and whether it has its key in common with the row before
        for batch in larger(batches):
            t = pa.Table.from_batches([batch] if held is None else [held, batch])
            key, node = (t.column(c).to_numpy() for c in ("key", "node"))
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
            idx = np.flatnonzero(fresh)
            as_before = np.zeros(len(idx), bool)
            as_before[0] = paired
            as_before[1:] = key[idx[1:]] == key[idx[:-1]]
            pick = idx[:-1][as_before[:-1] | (key[idx[1:]] == key[idx[:-1]])]
            if len(pick):
                yield from t.take(pa.array(pick)).combine_chunks().to_batches()
            held = t.slice(int(idx[-1]), 1).combine_chunks().to_batches()[0]
            paired = bool(as_before[-1])
        if paired:
            yield held

    dealt = entries.repartition(partitions(entries.sparkSession), "key").sortWithinPartitions("key", "node")
    # partitions that share a task follow each other whole, so a key's rows stay together
    return (dealt if rows is None else in_tasks(dealt, rows)).mapInArrow(run, entries.schema)


def _pairs(df: DataFrame, x: str, y: str, keep: Column) -> DataFrame:
    """Distinct pairs a < b of the entries in struct columns x and y that pass the filter on (na, pa, nb, pb)."""
    swap = F.col(f"{x}.node") > F.col(f"{y}.node")
    lo, hi = F.when(swap, F.col(y)).otherwise(F.col(x)), F.when(swap, F.col(x)).otherwise(F.col(y))
    d = df.where(F.col(f"{x}.node") != F.col(f"{y}.node")).select(lo.alias("l"), hi.alias("h"))
    d = d.select(F.col("l.node").alias("a"), F.col("l.n").alias("na"), F.col("l.pos").alias("pa"),
                 F.col("h.node").alias("b"), F.col("h.n").alias("nb"), F.col("h.pos").alias("pb"))
    return d.where(keep).select("a", "b", "na", "nb").distinct()


def link(e: DataFrame, verify: Verify, keep: Column | None = None, length: Column | None = None, refine: Verify | None = None) -> DataFrame:
    """(node, component) of the nodes with a true link.

    e: a written table of shared_entries: key, node (long), n and pos (int; size of
    the node, place of the key in it). keep: a filter on na, pa, nb, pb that every
    true pair passes under one of its keys at least; length: one on na and nb that it
    always passes. verify: (a, b, na, nb) and the number of rows -> a written table
    (a, b) of true links, which is deleted here, as e is. refine: entries -> entries, so that every true pair
    under a key shares one of the new keys; it may add columns, which it gets again
    with the entries that need another refinement, and gives keys that it cannot
    refine further a negative pos.
    """
    true = F.lit(True)
    keep, length = true if keep is None else keep, true if length is None else length
    columns = ["key", "node", "n", "pos"]
    placeless = keep is length
    rows = e.count()
    hot = e.groupBy("key").count().where(F.col("count") > HOT_NODES)
    salt = F.pmod(F.xxhash64("node"), F.ceil(F.coalesce("count", F.lit(1)) / HOT_NODES))
    me = F.struct("node", "n", "pos")
    w = Window.partitionBy("key", "salt").orderBy("node")
    met = e.join(hot, "key", "left").select("key", salt.alias("salt"), "node", me.alias("x"))
    met = met.select("x", F.array(F.first("x").over(w), F.lag("x").over(w)).alias("ys"))
    met = met.select("x", F.explode("ys").alias("y")).where("y is not null")
    tables = [written(in_tasks(_pairs(met, "x", "y", keep), 2 * rows), "pairs")]
    found = verify(tables[0], tables[0].count())
    labels = connected_components(found)
    drop_scratch(found)

    def mixed(e: DataFrame, rows: int) -> DataFrame:
        """Entries (at most `rows`) with their component c, under keys with several."""
        c = e.join(labels, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
        of = [F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("s0"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("s1"), F.max("pos").alias("pos")]
        several = c.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), *(of if placeless else [])).where("c0 <> c1").drop("c0", "c1")
        if placeless:  # of keys with the same nodes, one that can be refined if there is any
            several = several.groupBy("s0", "s1").agg(F.min(F.struct(F.col("pos") < 0, "key")).alias("k")).select("k.key")
        return written(in_tasks(c.join(several, "key", "left_semi"), rows), "mixed")

    def joined(pairs: DataFrame, rows: int | None = None) -> bool:
        """Verify the pairs (at most `rows`, if that is known) that are new; whether a link was among them."""
        nonlocal labels
        done = reduce(DataFrame.unionByName, [t.select("a", "b") for t in tables])
        new = pairs.join(done, ["a", "b"], "left_anti")
        tables.append(written(new if rows is None else in_tasks(new, rows), "pairs"))
        if not (size := tables[-1].count()):
            drop_scratch(tables.pop())
            return False
        found = verify(tables[-1], size)
        if some := not found.isEmpty():
            stars = labels.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
            before, labels = labels, connected_components(found.select("a", "b").unionByName(stars))
            drop_scratch(before)
        drop_scratch(found)
        return some

    def probed(c: DataFrame) -> DataFrame:
        """What is left of the entries c after the rounds of step 2."""
        k, size = 0, c.count()
        while size:
            one = c.groupBy("key", "c").agg(F.count(F.lit(1)).alias("size"), F.min_by(me, F.xxhash64("node", "key", F.lit(k))).alias("x"))
            largest = one.groupBy("key").agg(F.max_by("x", F.struct("size", "c")).alias("y"))
            if not joined(_pairs(one.join(largest, "key"), "x", "y", length), size):
                break
            before, c = c, mixed(c.drop("c"), size)
            drop_scratch(before)
            last, size, k = size, c.count(), k + 1
            if size > PROBE_SHRINK * last:
                break
        return c

    c = probed(mixed(e, rows))
    drop_scratch(e)
    rest = []
    while refine is not None:
        rows = c.count()
        many = written(in_tasks(c.where("pos >= 0").groupBy("key").count().where(F.col("count") > REFINED_NODES).select("key"), rows), "many")
        if many.isEmpty():
            drop_scratch(many)
            break
        finer = written(shared_entries(refine(in_tasks(c.join(many, "key", "left_semi").drop("c"), rows)), REFINED_KEYS * rows), "entries")
        rest.append(written(in_tasks(c.join(many, "key", "left_anti").select(*columns), rows), "rest"))
        drop_scratch(many)
        drop_scratch(c)
        c = mixed(finer, finer.count())
        drop_scratch(finer)
    if rest:
        rest.append(probed(c))
        c = reduce(DataFrame.unionByName, [r.select(*columns) for r in rest])
        c = mixed(c, c.count())
        for r in rest:
            drop_scratch(r)
    before = F.collect_list("key").over(Window.partitionBy("node").orderBy("key").rowsBetween(-BEFORE, -1)) if placeless else F.lit(None).cast("array<long>")
    met = c.select("key", "c", me.alias("x"), before.alias("before"))
    both = met.toDF("key", "cl", "x", "bl").join(met.toDF("key", "cr", "y", "br"), "key").where("x.node < y.node and cl <> cr")
    joined(_pairs(both.where("not arrays_overlap(bl, br)") if placeless else both, "x", "y", keep))
    for t in [c, *tables]:
        drop_scratch(t)
    return labels
