"""Operator 5, embedding near-dedup: epsilon grid order join.

Two unit vectors with cosine >= c are at most eps = sqrt(2 - 2c) apart. Vectors
are sorted by the cells (of width eps) of their leading principal coordinates and
cut into intervals of that sequence. Pairs of intervals are joined recursively,
from a few long intervals down to leaves: a pair whose bounding boxes are more
than eps apart is skipped. Leaf pairs are compared in rounds, one side of which is
broadcast, so that the disk does not hold a leaf once a pair. They are cut further inside a task, and what is
left is compared by cosine in double precision.

Equal vectors are one node. A task gives out the numbers of links and a spanning
forest of the links it finds, not the links, so a group of copies does not cost
the square of its size; forests keep the components as they are.

The principal axes are fitted on a bounded sample (about SAMPLE vectors); they
decide how much is skipped, not what is found.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offblock.llm.common import arrow_batches, partitions, small_batches, written
from offblock.llm.linking import connected_components
from offblock.session import scratch_path

COSINE = 0.9
SAMPLE = 4096
#: Leading principal coordinates; those of them that order the sequence.
AXES, ORDER_AXES = 16, 4
LEAF_BYTES = 1 << 20
TILE = 256
#: Leaves that are broadcast at a time.
ROUND_BYTES = 4 << 20
#: Children of an interval, and the most intervals of the top level.
FAN = 8


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length 1, in double precision; scaled first, so that squares stay finite."""
    x = rows.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def usable(v) -> np.ndarray | None:
    """A vector as an array; None if it is null, empty or zero, or has null or non-finite components."""
    if not v or any(x is None for x in v):
        return None
    a = np.asarray(v, np.float64)
    return a if np.isfinite(a).all() and a.any() else None


def vector_rows(batches):
    """(vec_id, node, dim, data): node and data are null for vectors that link with nothing."""
    for batch in batches:
        out = []
        for v in batch.column("embedding").to_pylist():
            a = usable(v)
            out.append((None, None, None) if a is None else (xxhash.xxh3_64_intdigest(a.tobytes()) - (1 << 63), len(a), a.tobytes()))
        node, dim, data = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(node, pa.int64()), pa.array(dim, pa.int32()), pa.array(data, pa.binary())],
                                         names=["vec_id", "node", "dim", "data"])


def principal_axes(nodes: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and leading principal axes for each dimension, from a bounded sample of its vectors."""
    counts = {r["dim"]: r["count"] for r in nodes.groupBy("dim").count().collect()}
    if not counts:
        return {}
    shares = F.create_map(*[x for d, n in counts.items() for x in (F.lit(d), F.lit(min(1.0, SAMPLE / n)))])
    chance = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / float(1 << 30)
    by_dim: dict[int, list[bytes]] = {}
    for r in nodes.where(chance < F.element_at(shares, F.col("dim"))).select("dim", "data").limit(2 * SAMPLE * len(counts)).collect():
        by_dim.setdefault(r["dim"], []).append(r["data"])
    out = {}
    for dim in counts:
        x = unit(np.frombuffer(b"".join(by_dim.get(dim, [])) or np.eye(1, dim).tobytes()).reshape(-1, dim))
        mean = x.mean(0)
        _, axes = np.linalg.eigh((x - mean).T @ (x - mean))
        out[dim] = (mean, axes[:, ::-1][:, : min(AXES, dim)].copy())
    return out


def leaves(nodes: DataFrame, axes: dict, eps: float) -> DataFrame:
    """(part, i, dim, ids, counts, data, lo, hi): runs of the grid order, with their bounding boxes.

    Boxes have AXES coordinates (0 beyond the dimension); data has the runs' units.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(axes)

    def place(batches):
        for batch in batches:
            dims, data = np.array(batch.column("dim")), batch.column("data").to_pylist()
            cells = np.zeros((len(data), ORDER_AXES + 1))
            for dim in set(dims.tolist()):
                at = np.flatnonzero(dims == dim)
                mean, v = shared.value[dim]
                p = (unit(np.frombuffer(b"".join(data[k] for k in at)).reshape(-1, dim)) - mean) @ v[:, :ORDER_AXES]
                cells[at, : p.shape[1]] = np.floor(p / eps)
                cells[at, ORDER_AXES] = p[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(cells), pa.list_(pa.float64()))], names=["node", "dim", "n", "data", "cells"])

    def cut(batches):
        part, i = TaskContext.get().partitionId(), 0
        held: list[tuple[int, int, bytes]] = []

        def leaf(rows, i):
            dim = rows[0][1]
            x = unit(np.frombuffer(b"".join(r[2] for r in rows)).reshape(-1, dim))
            mean, v = shared.value[dim]
            p = np.zeros((len(rows), AXES))
            p[:, : v.shape[1]] = (x - mean) @ v
            return (part, i, dim, np.array([r[0] for r in rows], np.int64).tobytes(), np.array([r[3] for r in rows], np.int64).tobytes(),
                    x.tobytes(), p.min(0).tolist(), p.max(0).tolist())

        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        as_batch = lambda row: pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=LEAF_NAMES)
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("node", "dim", "data", "n")), strict=True):
                if held and (r[1] != held[0][1] or len(held) >= max(TILE, LEAF_BYTES // (8 * r[1]))):
                    yield as_batch(leaf(held, i))
                    held, i = [], i + 1
                held.append(r)
        if held:
            yield as_batch(leaf(held, i))

    order = ["dim", *[F.col("cells")[k] for k in range(ORDER_AXES + 1)]]
    placed = nodes.select("node", "dim", "n", "data").mapInArrow(place, "node long, dim int, n long, data binary, cells array<double>")
    dealt = placed.repartitionByRange(partitions(nodes.sparkSession), *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(cut, "part int, i int, dim int, ids binary, counts binary, data binary, lo array<double>, hi array<double>")


FOUND = "node long, links long, peer long"
LEAF_NAMES = ["part", "i", "dim", "ids", "counts", "data", "lo", "hi"]


def close_pairs(boxes: DataFrame, total: int, eps: float) -> DataFrame:
    """(a, b), a <= b: the leaves whose boxes are within eps, found from the top level down.

    boxes: (leaf, dim, lo, hi), leaves numbered 0 to total - 1 in grid order.
    """
    apart = F.zip_with(F.zip_with("lo_a", "hi_b", lambda x, y: x - y), F.zip_with("lo_b", "hi_a", lambda x, y: x - y),
                       lambda x, y: F.greatest(x, y, F.lit(0.0)))
    square = F.aggregate(apart, F.lit(0.0), lambda s, x: s + x * x)
    near = (square <= eps * eps + 1e-9) & (F.col("d0_a") <= F.col("d1_b")) & (F.col("d0_b") <= F.col("d1_a"))
    depth = 0
    while total > FAN ** (depth + 1):
        depth += 1
    pairs = None
    for level in range(depth, -1, -1):
        n = F.floor(F.col("leaf") / FAN**level).cast("long").alias("k")
        sides = [F.array(*[f(F.col(c)[j]) for j in range(AXES)]).alias(c) for c, f in (("lo", F.min), ("hi", F.max))]
        box = written(boxes.groupBy(n).agg(*sides, F.min("dim").alias("d0"), F.max("dim").alias("d1")), "boxes")
        if pairs is None:  # at most FAN intervals
            pairs = box.select(F.col("k").alias("a"), F.explode(F.sequence("k", F.lit(FAN - 1).cast("long"))).alias("b"))
        else:
            kids = F.sequence(F.lit(0), F.lit(FAN - 1))
            pairs = pairs.select((F.col("a") * FAN).alias("a"), (F.col("b") * FAN).alias("b"), F.explode(kids).alias("x"))
            pairs = pairs.select((F.col("a") + F.col("x")).alias("a"), "b", F.explode(kids).alias("y"))
            pairs = pairs.select("a", (F.col("b") + F.col("y")).alias("b")).where("a <= b")
        left = box.toDF("a", *[f"{c}_a" for c in ("lo", "hi", "d0", "d1")])
        right = box.toDF("b", *[f"{c}_b" for c in ("lo", "hi", "d0", "d1")])
        pairs = written(pairs.join(left, "a").join(right, "b").where(near).select("a", "b"), "close")
    return pairs


def forest(tiles: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """A spanning forest of edges given as arrays of ends."""
    root: dict[int, int] = {}

    def find(x):
        while (p := root.setdefault(x, x)) != x:
            root[x] = root[p]
            x = p
        return x

    out = []
    for a, b in tiles:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            p, q = find(x), find(y)
            if p != q:
                root[max(p, q)] = min(p, q)
                out.append((x, y))
    return out


def tile_stars(hit: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links of a tile connect: each end with one node of its component."""
    rows, cols = np.flatnonzero(hit.any(1)), np.flatnonzero(hit.any(0))
    m = hit[np.ix_(rows, cols)]
    label = np.arange(len(rows))  # of rows; that of a column is the least of its rows
    while True:
        c = np.where(m, label[:, None], len(rows)).min(0)
        new = np.where(m, c[None, :], len(rows)).min(1)
        if (new == label).all():
            break
        label = new
    return (np.concatenate([left[rows], right[cols]]), left[rows][np.concatenate([label, c])])


def join_leaves(cosine: float, eps: float):
    """For a pair of leaves: (node, links, peer) rows: link counts (peer null) and edges of a forest (links null)."""
    def run(table: pa.Table) -> pa.Table:
        nodes, links, peers = [], [], []
        for r in table.to_pylist():
            dim = r["dim"]
            x, y = (np.frombuffer(r[k]).reshape(-1, dim) for k in ("data_a", "data_b"))
            ids_x, n_x, ids_y, n_y = (np.frombuffer(r[k], np.int64) for k in ("ids_a", "counts_a", "ids_b", "counts_b"))
            same = r["a"] == r["b"]
            found_x, found_y, stars = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64), []

            def join(i0, i1, j0, j1):
                """Join two intervals: skip them, compare them, or join their halves."""
                if same and j1 <= i0:
                    return
                a, b = x[i0:i1], y[j0:j1]
                gap = np.maximum(0, np.maximum(a.min(0) - b.max(0), b.min(0) - a.max(0)))
                if gap @ gap > eps * eps + 1e-9:
                    return
                if max(i1 - i0, j1 - j0) > TILE:
                    i, j = (i0 + i1) // 2, (j0 + j1) // 2
                    for u in ((i0, i), (i, i1)):
                        for v in ((j0, j), (j, j1)):
                            if u[0] < u[1] and v[0] < v[1]:
                                join(*u, *v)
                    return
                hit = a @ b.T >= cosine
                if same and i0 == j0:
                    np.fill_diagonal(hit, False)
                if hit.any():
                    found_x[i0:i1] += hit @ n_y[j0:j1]
                    if not same:
                        found_y[j0:j1] += n_x[i0:i1] @ hit
                    elif i0 != j0:
                        found_x[j0:j1] += n_x[i0:i1] @ hit
                    stars.append(tile_stars(hit, ids_x[i0:i1], ids_y[j0:j1]))

            join(0, len(x), 0, len(y))
            for ids, found in ((ids_x, found_x), (ids_y, found_y)):
                at = np.flatnonzero(found)
                nodes += ids[at].tolist()
                links += found[at].tolist()
                peers += [None] * len(at)
            for u, v in forest(stars):
                nodes.append(u)
                links.append(None)
                peers.append(v)
        return pa.table({"node": pa.array(nodes, pa.int64()), "links": pa.array(links, pa.int64()), "peer": pa.array(peers, pa.int64())})

    return run


def paired(pairs: DataFrame, cut: DataFrame, before: dict[int, int], total: int, compare) -> DataFrame:
    """What compare gives for each pair (a, b) of leaves, written.

    A round takes the pairs of the next ROUND_BYTES of leaves, which are broadcast, and
    reads the other leaves where they lie: no leaf is shuffled, however many pairs it is
    in. Of a pair, either leaf may be the one that is broadcast, so that each round's
    pairs are spread over all leaves.
    """
    spark, path = cut.sparkSession, scratch_path(cut.sparkSession, f"found-{uuid.uuid4().hex}")
    each = max(1, ROUND_BYTES // LEAF_BYTES)
    odd = (F.col("a") + F.col("b")) % 2 == 1
    pairs = pairs.select(F.when(odd, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(odd, F.col("a")).otherwise(F.col("b")).alias("b"))
    pairs = written(pairs.withColumn("round", F.floor(F.col("a") / each)), "rounds")
    side = cut.select("leaf", "dim", "ids", "counts", "data")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                yield from compare(pa.Table.from_batches([batch.slice(k, 1)])).to_batches()

    spark.createDataFrame([], FOUND).write.parquet(path)
    for r in sorted(x["round"] for x in pairs.select("round").distinct().collect()):
        here = F.lit(False)  # by columns of the files, so that others are not read
        for part, first in before.items():
            last = min([x for x in before.values() if x > first], default=total)
            if first < (r + 1) * each and last > r * each:
                here = here | (F.col("part") == part) & (F.col("i") >= r * each - first) & (F.col("i") < (r + 1) * each - first)
        left = cut.where(here).select("leaf", "ids", "counts", "data").toDF("a", "ids_a", "counts_a", "data_a")
        mine = pairs.where(F.col("round") == r).select("a", "b")
        both = side.toDF("b", "dim", "ids_b", "counts_b", "data_b").join(F.broadcast(mine), "b").join(F.broadcast(left), "a")
        with arrow_batches(spark, 1):  # one pair at a time reaches Python
            both.mapInArrow(run, FOUND).write.mode("append").parquet(path)
    return spark.read.schema(FOUND).parquet(path)


def cosine_components(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Vectors that are null, empty or zero, or hold null or non-finite components,
    link with nothing; vectors of different lengths do not link. Rows that repeat
    an id or a vector are vectors of their own. A vector without an id is kept, and
    its component is the smallest id it reaches, if any. Other columns are not read.
    """
    eps = math.sqrt(2 - 2 * cosine) + 1e-9
    d = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    small_batches(vectors.sparkSession)
    rows = written(d.mapInArrow(vector_rows, "vec_id long, node long, dim int, data binary"), "vectors")
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.first("dim").alias("dim"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("vec_id"), F.first("data").alias("data"))
    nodes = written(nodes, "nodes")
    cut = written(leaves(nodes, principal_axes(nodes), eps), "leaves")
    sizes = {r["part"]: r["count"] for r in cut.groupBy("part").count().collect()}  # one number a partition
    at, before = 0, {}
    for part in sorted(sizes):
        before[part], at = at, at + sizes[part]
    number = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("part")) + F.col("i") if before else F.lit(0)
    cut = cut.withColumn("leaf", number.cast("long"))
    pairs = close_pairs(cut.select("leaf", "dim", "lo", "hi"), max(at, 1), eps)
    found = paired(pairs, cut, before, max(at, 1), join_leaves(cosine, eps))
    links = found.where("peer is null").groupBy("node").agg(F.sum("links").alias("links"))
    labels = connected_components(found.where("peer is not null").select(F.col("node").alias("a"), F.col("peer").alias("b")))
    info = nodes.select("node", "n", "vec_id").join(links, "node", "left").join(labels, "node", "left").withColumn("c", F.coalesce("component", "node"))
    low = info.groupBy("c").agg(F.min("vec_id").alias("component_id"))
    info = info.join(low, "c").select("node", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "node").join(info, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
