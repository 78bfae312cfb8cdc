"""Tree ensembles grown by histogram aggregates.

Inputs are cut at up to BINS borders; rows lie in blocks of byte codes, written
once. One Spark job a level serves all trees that grow at the time, of all
trials: each task adds up gradient, weight and rows by (tree, node, input, bin),
the shuffle adds the tasks' sums, and the best split of a node is picked where
its sums meet; one row a node reaches the driver, which extends the trees. Nodes
of few rows send these in place of their sums, all of a level in one job. Rows that
are few in all go to tasks that fit whole models (at_hand), which are the same.

Growth rules
- depth: every node of a level splits where the gain is positive;
- leaf: the leaf of the highest gain splits, up to a budget of leaves. A level is
  computed ahead for the leaves that could be next, then the choice is replayed
  in order, so the tree is that of one split at a time;
- symmetric: one split for all nodes of a level.

Missing values have a bin of their own. A split tries them on either side and
keeps the better one; where a node saw none, they follow the larger child.

Sums are of whole numbers (gradients times a power of two, weights times
WEIGHT_ONE), exact up to 2**53, and row draws are hashes of a row key, so a model
does not depend on how the rows are partitioned.
"""

from __future__ import annotations

import heapq
import json
import math
import sys
import uuid
from array import array
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offblock.ml.features import VECTOR
from offblock.operators.schema import q
from offblock.session import cut_lineage, drop_scratch, scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Most borders of an input; the code after the last value bin means missing.
BINS = 254
BLOCK_ROWS = 16_384
#: Borders come from about so many rows, chosen by a hash of the row key.
BORDER_ROWS = 200_000
#: Sums that a task holds in one pass; more nodes take several passes.
HIST_BYTES = 48 << 20
#: Rounds after which the sums of the trees so far are written beside the rows.
MARGIN_ROUNDS = 5
WEIGHT_ONE = 1024
#: Nodes of a model that are broadcast at a time.
BLOCK_NODES = 500_000


@dataclass(frozen=True)
class TreeParams:
    growth: str = "depth"
    rounds: int = 100
    depth: int = 6
    leaves: int = 1 << 30
    rate: float = 0.1
    rows: float = 1.0  # share of the rows, for each tree
    columns: float = 1.0  # share of the inputs, for each tree
    node_columns: str = "all"  # inputs drawn at each node: all, sqrt, log2
    alpha: float = 0.0
    lam: float = 0.0
    gamma: float = 0.0
    child_weight: float = 0.0
    child_rows: int = 1
    split_rows: int = 2
    bins: int = BINS
    temperature: float = 0.0  # weights (-ln u) ** temperature, for each tree
    strength: float = 0.0  # noise on a split's score, in parts of its scale
    forest: bool = False
    bootstrap: bool = False
    seed: int = 42

    @property
    def unit(self) -> int:
        return WEIGHT_ONE if self.temperature > 0 else 1


# ------------------------------------------------------------------ rows

@dataclass
class Layout:
    """Places of the inputs' bins in a node's sums."""
    borders: list[np.ndarray]

    def __post_init__(self):
        self.sizes = np.array([len(b) + 2 for b in self.borders])  # values, then missing
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(int)
        self.total = int(self.sizes.sum())
        # a candidate for each value bin: it and all below go left
        self.col = np.repeat(np.arange(len(self.borders)), self.sizes - 1)
        self.code = np.concatenate([np.arange(s - 1) for s in self.sizes]) if len(self.sizes) else np.empty(0, int)
        self.slot = self.starts[self.col] + self.code if len(self.col) else np.empty(0, int)

    def allowed(self, bins: int) -> np.ndarray:
        """Candidates of a learner with so many borders: those spread evenly over the input's."""
        out = np.ones(len(self.col), bool)
        for c, b in enumerate(self.borders):
            if len(b) > bins:
                keep = np.unique(np.floor((np.arange(bins) + 1) * (len(b) + 1) / (bins + 1)).astype(int) - 1)
                out[self.col == c] = np.isin(np.arange(len(b) + 1), np.append(keep, len(b)))
        return out

    def threshold(self, col: int, code: int) -> float:
        return float(self.borders[col][code]) if code < len(self.borders[col]) else math.inf


@dataclass
class Binned:
    """Blocks of coded rows (n, codes, y, key, margin) with what was learned of them."""
    blocks: DataFrame
    layout: Layout
    n: int
    base: float
    span: float


def vectors(batch, p: int) -> np.ndarray:
    """The rows x inputs matrix of an Arrow column of lists."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, p)


BLOCK = "n int, codes binary, y binary, key binary, margin binary"


def coder(layout: Layout):
    """A function that puts rows (x, y, key) into blocks of codes."""
    borders, missing, p = layout.borders, layout.sizes - 1, len(layout.borders)

    def code(batches):
        held = []

        def block():
            x, y, key = (np.concatenate(z) for z in zip(*held, strict=True))
            codes = np.empty((p, len(y)), np.uint8)
            for c in range(p):
                codes[c] = np.where(np.isnan(x[:, c]), missing[c], np.searchsorted(borders[c], x[:, c], side="left"))
            return pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), *(pa.array([z.tobytes()], pa.binary()) for z in (codes, y, key)), pa.array([b""], pa.binary())],
                                              names=["n", "codes", "y", "key", "margin"])

        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                b = batch.slice(i, BLOCK_ROWS)
                held.append((vectors(b, p), b.column("y").to_numpy(), b.column("key").to_numpy()))
                if sum(len(h[1]) for h in held) >= BLOCK_ROWS:
                    yield block()
                    held.clear()
        if held:
            yield block()

    return code


def binned(df: DataFrame, label: str) -> Binned:
    """Code and write the rows of df (features, label) that have a label.

    The key is a hash of the row's other columns and its inputs; a row that is
    repeated as a whole is drawn or left out with its copies.
    """
    spark = df.sparkSession
    others = [q(c) for c in df.columns if c not in (VECTOR, label)]
    d = df.where(q(label).isNotNull()).select(vector_to_array(F.col(VECTOR)).alias("x"), q(label).cast("double").alias("y"), *others)
    d = cut_lineage(d.select("x", "y", F.xxhash64("x", *others).alias("key")), "rows")
    s = d.agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("lo"), F.max("y").alias("hi"), F.max(F.size("x")).alias("p")).first()
    n, p = s["n"], s["p"] or 0
    if not n:
        raise ValueError("no rows with a label to learn from")
    span = max(abs(s["lo"]), abs(s["hi"]), 1e-9)
    exact = 2.0 ** math.floor(math.log2(2.0**52 / (n * span)))
    total = d.agg(F.sum(F.round(F.col("y") * exact).cast("decimal(38,0)"))).first()[0]
    base = float(total) / exact / n

    share = min(1.0, BORDER_ROWS / n)
    sample = d.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else d

    def by_input(batches):
        for batch in batches:
            if batch.num_rows:
                x = vectors(batch, p)
                yield pa.RecordBatch.from_arrays([pa.array(range(p), pa.int32()), pa.array([np.ascontiguousarray(x[:, c]).tobytes() for c in range(p)])],
                                                 names=["col", "data"])

    def cut(t: pa.Table) -> pa.Table:
        x = np.concatenate([np.frombuffer(b) for b in t.column("data").to_pylist()])
        x = np.sort(x[~np.isnan(x)])
        values = np.unique(x)
        if len(values) > BINS + 1:
            values = np.unique(x[np.floor((np.arange(BINS) + 1) * len(x) / (BINS + 1)).astype(int) - 1])
            values = values[values < x[-1]]
        else:
            values = values[:-1]
        return pa.table({"col": [t.column("col")[0].as_py()], "borders": [values.tobytes()]}, schema=pa.schema([("col", pa.int32()), ("borders", pa.binary())]))

    found = sample.select("x").mapInArrow(by_input, "col int, data binary").groupBy("col").applyInArrow(cut, "col int, borders binary")
    at = {r["col"]: np.frombuffer(r["borders"]) for r in found.collect()}
    layout = Layout([at[c] for c in range(p)])
    blocks = cut_lineage(d.mapInArrow(coder(layout), BLOCK), "blocks")
    drop_scratch(d)
    return Binned(blocks, layout, n, base, span)


def blocks_of(batch, *names: str):
    """The blocks of an Arrow batch, their rows and columns; one is copied at a time."""
    columns = [batch.column(c) for c in names]
    for k, n in enumerate(batch.column("n").to_pylist()):
        yield n, *(c[k].as_buffer() for c in columns)


def uniforms(key: np.ndarray, *seeds: int) -> np.ndarray:
    """A number in (0, 1) for each key, by a mixed 64-bit hash of the key and the seeds."""
    x = key.view(np.uint64).copy()
    with np.errstate(over="ignore"):
        for s in (*seeds, 0x5DEECE66D):
            x = (x ^ np.uint64(s & (2**64 - 1))) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(32)
    return (x >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54


def draw(p: TreeParams, tree: int, key: np.ndarray) -> np.ndarray:
    """Whole weights of the rows in a tree, in units of p.unit."""
    w = np.full(len(key), float(p.unit))
    if p.bootstrap:  # Poisson counts stand for draws with replacement
        u, chance, below = uniforms(key, p.seed, tree, 1), math.exp(-1), math.exp(-1)
        w = np.zeros(len(key))
        for k in range(1, 20):
            more = u > below
            if not more.any():
                break
            w += more
            chance /= k
            below += chance
    if p.temperature > 0:
        w = np.rint(w * (-np.log(uniforms(key, p.seed, tree, 2))) ** p.temperature)
    if p.rows < 1:
        w = np.where(uniforms(key, p.seed, tree, 3) < p.rows, w, 0.0)
    return w


def drawn_columns(share: float | str, n: int, *seeds: int) -> np.ndarray:
    """Whether each of n inputs is drawn: a share of them, their square root or their logarithm, one at least."""
    if share in (1.0, "all"):
        return np.ones(n, bool)
    k = {"sqrt": math.isqrt(n), "log2": int(math.log2(max(n, 1)))}.get(share) if isinstance(share, str) else round(share * n)
    order = np.random.default_rng([s & 0xFFFFFFFF for s in seeds]).permutation(n)
    out = np.zeros(n, bool)
    out[order[: max(1, k)]] = True
    return out


# ------------------------------------------------------------------ trees

@dataclass
class Tree:
    """A tree that grows. Arrays by node; left is -1 at a leaf; value is not yet scaled by the rate."""
    col: array = field(default_factory=lambda: array("i"))
    code: array = field(default_factory=lambda: array("i"))
    missing_left: bytearray = field(default_factory=bytearray)
    left: array = field(default_factory=lambda: array("i"))
    right: array = field(default_factory=lambda: array("i"))
    value: array = field(default_factory=lambda: array("d"))
    cover: array = field(default_factory=lambda: array("d"))
    depth: array = field(default_factory=lambda: array("i"))
    gain: list[float | None] = field(default_factory=list)  # None: not evaluated

    def add(self, depth: int, value: float, cover: float) -> int:
        for a, x in ((self.col, -1), (self.code, -1), (self.missing_left, False), (self.left, -1), (self.right, -1), (self.value, value),
                     (self.cover, cover), (self.depth, depth), (self.gain, None)):
            a.append(x)
        return len(self.col) - 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        whole = [np.array(x, np.int32) for x in (self.col, self.code)], [np.array(x, np.int32) for x in (self.left, self.right)]
        return (*whole[0], np.array(self.missing_left, bool), *whole[1], np.array(self.value))


def place(tree: tuple[np.ndarray, ...], codes: np.ndarray, missing: np.ndarray, symmetric: bool = False) -> np.ndarray:
    """The node each row of a block ends in. A symmetric tree has one split a level and its nodes in order of the levels."""
    col, code, missing_left, left, right = tree[:5]
    if symmetric:
        at, start = np.zeros(codes.shape[1], np.int64), 0
        while left[start] >= 0:
            c = codes[col[start]]
            goes_right = c > code[start]
            goes_right[c == missing[col[start]]] = not missing_left[start]
            at = 2 * at + goes_right
            start = 2 * start + 1
        return start + at
    n = codes.shape[1]
    node = np.zeros(n, np.int64)
    if left[0] < 0:
        return node
    # missing values are above all codes of a split: they go left where a node says so
    flat, kids = np.ascontiguousarray(codes).ravel(), np.stack([right, left], axis=1).ravel().astype(np.int64)
    start, also = col.astype(np.int64) * n, np.where(missing_left, missing[col], -1).astype(np.int16)
    code, inner = code.astype(np.int16), left >= 0
    rows, at = np.arange(n), node.copy()
    while len(rows):
        c = flat.take(start.take(at) + rows)
        at = kids.take(2 * at + ((c <= code.take(at)) | (c == also.take(at))))
        more = inner.take(at)
        if not more.all():
            node[rows] = at
            rows, at = rows[more], at[more]
    return node


def leaf_value(g, h, p: TreeParams):
    """The minimiser of the penalised squared loss."""
    t = np.sign(g) * np.maximum(np.abs(g) - p.alpha, 0.0)
    return np.where(h + p.lam > 0, -t / np.where(h + p.lam > 0, h + p.lam, 1.0), 0.0)


def leaf_number(g: float, h: float, p: TreeParams) -> float:
    """leaf_value of one leaf."""
    t = ((g > 0) - (g < 0)) * max(abs(g) - p.alpha, 0.0)
    return -t / (h + p.lam) if h + p.lam > 0 else 0.0


def score(g, h, p: TreeParams):
    t = np.maximum(np.abs(g) - p.alpha, 0.0)
    return np.where(h + p.lam > 0, t * t / np.where(h + p.lam > 0, h + p.lam, 1.0), 0.0)


def candidates(g: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums (nodes x bins) -> those left of each candidate without the missing ones, the missing ones, and the nodes' own."""
    run = np.cumsum(g, axis=1)
    before = (run - g)[:, layout.starts]
    total = run[:, layout.starts + layout.sizes - 1] - before
    return run[:, layout.slot] - before[:, layout.col], g[:, (layout.starts + layout.sizes - 1)[layout.col]], total[:, layout.col]


def pick(g, h, n, layout: Layout, p: TreeParams, allowed: np.ndarray, noise: np.ndarray | None = None) -> list[tuple | None]:
    """For each node of g, h, n (nodes x bins) its best split (gain, candidate, missing left, left sums) or None.

    Symmetric trees have one split for all of them, of the highest sum of gains.
    allowed: candidates, or nodes x candidates. Of equal gains the first input,
    the lowest bin and missing to the right win.
    """
    (gl, gm, gt), (hl, hm, ht), (nl, nm, nt) = (candidates(x, layout) for x in (g, h, n))
    own, shared = score(gt, ht, p), p.growth == "symmetric"
    if not gl.shape[1]:
        return [None] * len(g)
    rows = np.arange(len(g))
    best = np.full(len(g), -np.inf)
    out: list[tuple | None] = [None] * len(g)
    for missing_left in (False, True):
        a, b, c = (x + y if missing_left else x for x, y in ((gl, gm), (hl, hm), (nl, nm)))
        gain = 0.5 * (score(a, b, p) + score(gt - a, ht - b, p) - own)
        if shared:
            gain = np.broadcast_to(gain.sum(0) - p.gamma, gain.shape)
            ok = allowed & ((c > 0) & (nt - c > 0)).any(0) & (nm.sum(0) > 0 if missing_left else True)
        else:
            gain = gain - p.gamma
            ok = allowed & (np.minimum(c, nt - c) >= max(1, p.child_rows)) & (np.minimum(b, ht - b) >= p.child_weight) & (nt >= p.split_rows)
            ok = ok & (nm > 0) if missing_left else ok
        rank = np.where(ok & (gain > 1e-10), gain if noise is None else gain + noise, -np.inf)
        k = rank.argmax(1)
        for v in np.flatnonzero(rank[rows, k] > best):
            best[v] = rank[v, k[v]]
            out[v] = (float(gain[v, k[v]]), int(k[v]), missing_left, (a[v, k[v]], b[v, k[v]], c[v, k[v]]))
    if shared and out[0] is not None and not nm[:, out[0][1]].any():
        side = sum(x[3][1] for x in out) * 2 >= ht[:, out[0][1]].sum()
        return [(*x[:2], bool(side), x[3]) for x in out]
    for v, x in enumerate(out):
        if x is not None and not shared and not nm[v, x[1]]:  # no missing value here: to the larger child
            out[v] = (*x[:2], bool(x[3][1] * 2 >= ht[v, x[1]]), x[3])
    return out


def node_inputs(p: TreeParams, n: int, tree: int, nodes) -> np.ndarray | None:
    """The inputs that each node draws, ascending (nodes x as many); None where they are not drawn by node alone."""
    if p.node_columns == "all" or p.columns != 1.0:
        return None
    return np.stack([np.flatnonzero(drawn_columns(p.node_columns, n, p.seed, tree, int(v))) for v in nodes])


def pick_by_rows(of: np.ndarray, g: np.ndarray, h: np.ndarray, codes: np.ndarray, cols: np.ndarray, layout: Layout, p: TreeParams) -> dict[str, np.ndarray]:
    """What pick finds, by node, from the rows of small nodes, in time of the rows and not of the bins.

    of: the row's node, from 0 and ascending; codes: (inputs of the node x rows), cols: (nodes x its
    inputs, ascending). A bin without rows has the gain of the bin below, which wins, so only bins
    with rows are tried, and the lowest bin where all that goes left is missing.
    """
    nodes, missing = len(cols), layout.sizes - 1
    first = np.searchsorted(of, np.arange(nodes))
    last = np.append(first[1:], len(of))
    g_to, h_to = (np.concatenate([[0.0], np.cumsum(x)]) for x in (g, h))
    g0, h0 = g_to[first], h_to[first]
    gt, ht, nt = g_to[last] - g0, h_to[last] - h0, (last - first).astype(float)
    own, short = score(gt, ht, p), of.astype(np.uint16 if nodes <= 1 << 16 else np.int64)
    best = np.full((2, nodes), -np.inf)
    won = np.full((2, 5, nodes), -1.0)  # input, code, sums to the left
    unseen = np.zeros((2, nodes), bool)  # no missing values in the input that won

    def offer(side, v, col, code, a, b, c, lost):
        gain = 0.5 * (score(a, b, p) + score(gt[v] - a, ht[v] - b, p) - own[v]) - p.gamma
        ok = (np.minimum(c, nt[v] - c) >= max(1, p.child_rows)) & (np.minimum(b, ht[v] - b) >= p.child_weight) & (nt[v] >= p.split_rows) & (gain > 1e-10)
        at = np.flatnonzero(ok)
        if not len(at):
            return
        r, own_node = gain[at], v[at]
        new = np.append(True, own_node[1:] != own_node[:-1])
        starts = np.flatnonzero(new)
        segment = np.cumsum(new) - 1
        top = np.maximum.reduceat(r, starts)
        equal = np.flatnonzero(r == top[segment])
        equal = equal[np.append(True, np.diff(segment[equal]) > 0)]  # the lowest bin of each node
        equal = equal[top > best[side, own_node[starts]]]
        k, u = at[equal], own_node[equal]
        best[side, u] = r[equal]
        won[side][:, u] = col[u], code[k], a[k], b[k], c[k]
        unseen[side, u] = lost[u] == 0

    for j in range(len(codes)):
        o = np.argsort(codes[j], kind="stable")
        o = o[np.argsort(short[o], kind="stable")]
        x = codes[j][o]
        ends = np.append(np.flatnonzero((x[1:] != x[:-1]) | (of[1:] != of[:-1])), len(of) - 1)
        v, x, col = of[ends], x[ends], cols[:, j]
        a, b, c = np.cumsum(g[o])[ends] - g0[v], np.cumsum(h[o])[ends] - h0[v], (ends + 1 - first[v]).astype(float)
        valued = x != missing[col[v]]
        v, x, a, b, c = (z[valued] for z in (v, x, a, b, c))
        seen, lowest = np.zeros((3, nodes)), np.full(nodes, -1)
        seen[:, v] = a, b, c  # of a node's bins the last one counts
        lowest[v[::-1]] = x[::-1]
        am, bm, cm = gt - seen[0], ht - seen[1], nt - seen[2]
        offer(0, v, col, x, a, b, c, cm)
        alone = np.flatnonzero((cm > 0) & (lowest != 0))
        if len(alone):
            offer(1, alone, col, np.zeros(len(alone)), am[alone], bm[alone], cm[alone], cm)
        some = cm[v] > 0
        if some.any():
            v, x, a, b, c = (z[some] for z in (v, x, a, b, c))
            offer(1, v, col, x, a + am[v], b + bm[v], c + cm[v], cm)

    side = (best[1] > best[0]).astype(int)
    at = np.arange(nodes)
    gain, w = best[side, at], won[side, :, at].T
    found = np.isfinite(gain)
    left = np.where(unseen[side, at], w[3] * 2 >= ht, side == 1)
    z = lambda x: np.where(found, x, 0.0)
    return {"gain": z(gain), "col": w[0].astype(np.int32), "code": w[1].astype(np.int32), "missing_left": found & left, "g": gt, "h": ht, "n": nt,
            "gl": z(w[2]), "hl": z(w[3]), "nl": z(w[4])}


def best_splits(p: TreeParams, number: int, scale: float, nodes: list[int], sums: np.ndarray, layout: Layout) -> list[tuple]:
    """The splits of nodes of a tree from their sums (3 x nodes x bins): rows of SPLITS without the job."""
    p_inputs = len(layout.borders)
    g, h, n = sums[0] / (scale * p.unit), sums[1] / p.unit, sums[2]
    inputs = drawn_columns(p.columns, p_inputs, p.seed, number)
    by_node = node_inputs(p, p_inputs, number, nodes)
    seen = [int(np.flatnonzero(inputs)[0])] * len(nodes) if by_node is None else by_node[:, 0].tolist()
    own = [slice(layout.starts[c], layout.starts[c] + layout.sizes[c]) for c in seen]
    mine = [(g[k, own[k]].sum(), h[k, own[k]].sum(), n[k, own[k]].sum()) for k in range(len(nodes))]
    noise = None
    if p.strength > 0:  # falls as the ensemble grows
        level = np.random.default_rng([p.seed, number, nodes[0], len(nodes)])
        wide = math.sqrt(sum(float(score(x[0], x[1], p)) for x in mine) + 1.0)
        noise = level.standard_normal(len(layout.col)) * p.strength * wide / (1.0 + number)
    allowed = layout.allowed(p.bins) & inputs[layout.col]
    if by_node is not None:
        drawn = np.zeros((len(nodes), p_inputs), bool)
        np.put_along_axis(drawn, by_node, True, axis=1)
        allowed = allowed & drawn[:, layout.col]
    elif p.node_columns != "all":
        allowed = allowed & np.stack([(inputs & drawn_columns(p.node_columns, p_inputs, p.seed, number, v))[layout.col] for v in nodes])
    rows = []
    for k, (node, found) in enumerate(zip(nodes, pick(g, h, n, layout, p, allowed, noise), strict=True)):
        if found is None:
            rows.append((node, 0.0, -1, -1, False, *mine[k], 0.0, 0.0, 0.0))
        else:
            gain, c, missing_left, left = found
            rows.append((node, gain, int(layout.col[c]), int(layout.code[c]), missing_left, *mine[k], *left))
    return rows


def splits_of_rows(p: TreeParams, number: int, scale: float, of: np.ndarray, g: np.ndarray, w: np.ndarray, codes: np.ndarray, layout: Layout) -> dict[str, np.ndarray]:
    """The splits of nodes of a tree from their rows: columns of SPLITS without the job. of: the rows' nodes, ascending."""
    total, p_inputs = layout.total, len(layout.borders)
    drawn = np.flatnonzero(drawn_columns(p.columns, p_inputs, p.seed, number))
    nodes, first = np.unique(of, return_index=True)
    parts: list[dict[str, np.ndarray]] = []
    if p.growth != "symmetric" and all(len(b) <= p.bins for b in layout.borders) and (p.node_columns == "all" or p.columns == 1.0):
        # nodes of fewer values than bins
        size = np.diff(np.append(first, len(of)))
        width = max(1, round(p_inputs * inputs_share(p, p_inputs))) if p.node_columns != "all" else len(drawn)
        few = size * width <= 2 * total
        if few.any():
            mine = np.repeat(few, size)
            at = np.repeat(np.arange(int(few.sum())), size[few])
            cols = node_inputs(p, p_inputs, number, nodes[few])
            if cols is None:
                own, cols = codes[drawn][:, mine], np.broadcast_to(drawn, (len(size[few]), len(drawn)))
            else:
                own = codes[cols[at].T, np.flatnonzero(mine)]
            parts.append(pick_by_rows(at, g[mine] / (scale * p.unit), w[mine] / p.unit, own, cols, layout, p) | {"node": nodes[few]})
            g, w, of, codes, nodes = g[~mine], w[~mine], of[~mine], codes[:, ~mine], nodes[~few]
            first = np.searchsorted(of, nodes)
    ends = np.append(first[1:], len(of))
    # one split for all nodes of a symmetric tree
    rows, step = [], len(nodes) if p.growth == "symmetric" else max(1, GROUP_BINS // total)
    for k in range(0, len(nodes), max(1, step)):
        some = nodes[k:k + step]
        a, b = first[k], ends[k + len(some) - 1]
        inside = np.repeat(np.arange(len(some)) * total, ends[k:k + step] - first[k:k + step])
        bins, sums = len(some) * total, None
        # some inputs at a time: their places take 8 bytes a value
        for c in range(0, len(drawn), max(1, GROUP_VALUES // max(1, b - a))):
            cols = drawn[c:c + max(1, GROUP_VALUES // max(1, b - a))]
            flat = (codes[cols, a:b] + (layout.starts[cols][:, None] + inside[None, :])).ravel()
            more = np.stack([np.bincount(flat, np.tile(x[a:b], len(cols)), bins) for x in (g, w)] + [np.bincount(flat, minlength=bins)])
            sums = more if sums is None else sums + more
        rows += best_splits(p, number, scale, some.tolist(), sums.reshape(3, len(some), total), layout)
    if rows:
        parts.append({name: np.array(col) for name, col in zip(SPLIT_NAMES, zip(*rows, strict=True), strict=True)})
    return {name: np.concatenate([x[name] for x in parts]) for name in SPLIT_NAMES}


SPLITS = "job int, node int, gain double, col int, code int, missing_left boolean, g double, h double, n double, gl double, hl double, nl double"
SPLIT_NAMES = [c.split()[0] for c in SPLITS.split(", ")][1:]


@dataclass
class Job:
    """One tree under way: trial, tree number, what its rows' margins are made of, and the nodes to evaluate."""
    job: int
    p: TreeParams
    number: int
    margin: int  # row of the margins; -1: none, gradients are those of a mean
    scale: float
    since: list  # (arrays, rate) of trees that the written margins lack
    tree: Tree
    open: list[int] = field(default_factory=list)


def inputs_share(p: TreeParams, n: int) -> float:
    """The share of the inputs whose bins a node holds."""
    own = node_inputs(p, n, 0, [0])
    return 1.0 if own is None else own.shape[1] / n


def evaluate(data: Binned, jobs: list[Job]) -> dict[int, dict[int, dict]]:
    """{job: {node: split}} for all open nodes of the jobs.

    The sums of the nodes, and all of symmetric trees, take one Spark job for each
    HIST_BYTES. The last of these also serves all nodes of at most SMALL_ROWS rows:
    their rows are dealt by node, as they are less than their sums.
    """
    out: dict[int, dict[int, dict]] = {}
    small: list[tuple[Job, list[int]]] = []
    chunk: list[tuple[Job, list[int]]] = []
    size = 0
    for j in jobs:
        few = [] if j.p.growth == "symmetric" else [v for v in j.open if v and j.tree.cover[v] <= SMALL_ROWS * j.p.unit]
        if few:
            small.append((j, few))
        held = set(few)
        many = [v for v in j.open if v not in held]
        for nodes in ([many] if j.p.growth == "symmetric" else [[v] for v in many]):
            cost = 32 * data.layout.total * len(nodes) * inputs_share(j.p, len(data.layout.borders))
            if chunk and size + cost > HIST_BYTES:
                _pass(data, chunk, [], out)
                chunk, size = [], 0
            if chunk and chunk[-1][0] is j:
                chunk[-1][1].extend(nodes)
            else:
                chunk.append((j, list(nodes)))
            size += cost
    if chunk and any(j.p.growth == "symmetric" for j, _ in chunk):
        _pass(data, chunk, [], out)
        chunk = []
    if chunk or small:
        _pass(data, chunk, small, out)
    return out


#: Nodes of one tree whose sums meet in one call.
NODE_GROUP = 16
#: Most rows of a node whose rows are dealt in place of its sums.
SMALL_ROWS = 16_384
#: Rows of small nodes that meet in one call, and bins that it sums up at a time.
GROUP_ROWS = 16_384
GROUP_BINS = 400_000
#: Values of nodes' rows that are placed in bins at a time.
GROUP_VALUES = 4_000_000


def _pass(data: Binned, chunk: list[tuple[Job, list[int]]], small: list[tuple[Job, list[int]]], out: dict) -> None:
    """Evaluate nodes by one Spark job: those of chunk by the tasks' sums, the small ones by their rows (groups below 0)."""
    layout, base = data.layout, data.base
    missing, total = layout.sizes - 1, layout.total
    p_inputs = len(layout.borders)
    tasks = []
    by_job: dict[int, tuple] = {}
    for j, nodes in chunk:
        by_job[j.job] = j, nodes, [k // NODE_GROUP for k in range(len(nodes))]
    for j, nodes in small:
        group = -1 - np.floor(np.cumsum([j.tree.cover[v] for v in nodes]) / GROUP_ROWS)
        _, large, groups = by_job.get(j.job, (j, [], []))
        by_job[j.job] = j, large + nodes, groups + group.tolist()
    for j, nodes, group in by_job.values():
        tasks.append((j.job, j.p, j.number, j.margin, j.scale, j.since, j.tree.arrays(), np.array(nodes, np.int32), np.array(group, np.int32)))

    def records(rows):
        job, group, node, sums = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(job, pa.int32()), pa.array(group, pa.int32()), pa.array(node, pa.int32()), pa.array(sums, pa.binary())],
                                          names=["job", "grp", "node", "sums"])

    def places(p: TreeParams, number: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """The inputs that nodes draw, where the sums of each begin, and the bins of all inputs that they are; None: all inputs."""
        cols = node_inputs(p, p_inputs, number, nodes) if len(nodes) else None
        if cols is None:
            return None
        size = layout.sizes[cols].ravel()
        begin = np.cumsum(size) - size
        slots = np.arange(size.sum()) + np.repeat(layout.starts[cols].ravel() - begin, size)
        return cols, begin.reshape(cols.shape), slots

    def add(batches):
        held: dict[int, np.ndarray] = {}
        inputs = [places(p, number, nodes[group >= 0]) for _, p, number, _, _, _, _, nodes, group in tasks]
        for batch in batches:
            for n, codes, y, key, margin in blocks_of(batch, "codes", "y", "key", "margin"):
                codes, y, key = np.frombuffer(codes, np.uint8).reshape(-1, n), np.frombuffer(y), np.frombuffer(key, np.int64)
                margins = np.frombuffer(margin).reshape(-1, n)
                for i, (job, p, number, row, scale, since, tree, nodes, group) in enumerate(tasks):
                    w = draw(p, number, key)
                    where = np.full(len(tree[0]), -1, np.int32)
                    where[nodes] = np.arange(len(nodes), dtype=np.int32)
                    at = where[place(tree, codes, missing, p.growth == "symmetric")]
                    sel = np.flatnonzero((at >= 0) & (w > 0))
                    if not len(sel):
                        continue
                    if row < 0:
                        m = np.zeros(n)
                    else:
                        m = margins[row] if len(margins) else np.full(n, base)
                        for t, rate in since:
                            m = m + rate * t[5][place(t, codes, missing, p.growth == "symmetric")]
                    at, w = at[sel], w[sel]
                    g = np.rint((m[sel] - y[sel]) * scale) * w
                    dealt = group[at] < 0
                    if dealt.any():
                        order = np.flatnonzero(dealt)
                        order = order[np.argsort(at[order], kind="stable")]
                        to, cut = group[at[order]], codes[:, sel[order]]
                        ends = np.append(np.flatnonzero(np.diff(to)) + 1, len(to)).tolist()
                        yield records([(job, int(to[a]), b - a, nodes[at[order[a:b]]].tobytes() + g[order[a:b]].tobytes() + w[order[a:b]].tobytes() + cut[:, a:b].tobytes())
                                       for a, b in zip([0, *ends], ends, strict=False)])
                        sel, at, w, g = sel[~dealt], at[~dealt], w[~dealt], g[~dealt]
                    if not len(sel):
                        continue
                    several = p.bootstrap or p.temperature > 0  # else a row's weight is one
                    if inputs[i] is not None:
                        cols, begin, slots = inputs[i]
                        bins, width = len(slots), cols.shape[1]
                        flat = (codes[cols[at].T, sel] + begin[at].T).ravel()
                    else:
                        drawn = np.flatnonzero(drawn_columns(p.columns, p_inputs, p.seed, number))
                        bins, width = int((group >= 0).sum()) * total, len(drawn)
                        inside = at.astype(np.int64) * total
                        flat = (codes[drawn][:, sel] + (layout.starts[drawn][:, None] + inside[None, :])).ravel()
                    if i not in held:
                        held[i] = np.zeros((3, bins))
                    held[i][0] += np.bincount(flat, np.tile(g, width), bins)
                    count = np.bincount(flat, minlength=bins)
                    held[i][2] += count
                    held[i][1] += np.bincount(flat, np.tile(w, width), bins) if several else count
        for i, sums in held.items():
            job, nodes, group = tasks[i][0], tasks[i][7], tasks[i][8]
            begin = np.arange(0, sums.shape[1], total) if inputs[i] is None else inputs[i][1][:, 0]
            for k, (a, b) in enumerate(zip(begin, np.append(begin[1:], sums.shape[1]), strict=True)):
                mine = sums[:, a:b]
                u = np.flatnonzero(mine[2])
                if len(u):
                    slot = u if inputs[i] is None else inputs[i][2][a + u]
                    yield records([(job, int(group[k]), int(nodes[k]), np.concatenate([slot[None, :].astype(float), mine[:, u]]).tobytes())])

    about = {j.job: (j.p, j.number, j.scale) for j, *_ in by_job.values()}
    kinds = {"int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [(c.split()[0], kinds[c.split()[1]]) for c in SPLITS.split(", ")]

    def merged(t: pa.Table) -> tuple[list[int], np.ndarray]:
        """The nodes of some tasks' records and their sums."""
        ids = t.column("node").to_pylist()
        nodes = sorted(set(ids))
        at = {v: k for k, v in enumerate(nodes)}
        sums = np.zeros((3, len(nodes), total))
        for v, b in zip(ids, t.column("sums"), strict=True):
            x = np.frombuffer(b.as_buffer()).reshape(4, -1)
            sums[:, at[v], x[0].astype(np.int64)] += x[1:]
        return nodes, sums

    def merge(t: pa.Table) -> pa.Table:
        nodes, sums = merged(t)
        job = t.column("job")[0].as_py()
        parts = []
        for k in range(len(nodes)):
            u = np.flatnonzero(sums[2, k])
            parts.append((job, 0, nodes[k], np.concatenate([u[None, :].astype(float), sums[:, k, u]]).tobytes()))
        return pa.Table.from_batches([records(parts)])

    def choose(t: pa.Table) -> pa.Table:
        job = t.column("job")[0].as_py()
        p, number, scale = about[job]
        if t.column("grp")[0].as_py() >= 0:
            rows = best_splits(p, number, scale, *merged(t), layout)
            return pa.table({name: pa.array(col, kind) for (name, kind), col in zip(fields, zip(*((job, *r) for r in rows), strict=True), strict=True)})
        parts = []
        for n, b in zip(t.column("node").to_pylist(), t.column("sums"), strict=True):
            b = b.as_buffer()
            parts.append((np.frombuffer(b, np.int32, n), np.frombuffer(b, np.uint8, 16 * n, 4 * n).view(float),
                          np.frombuffer(b, np.uint8, p_inputs * n, 20 * n).reshape(p_inputs, n)))
        of = np.concatenate([x[0] for x in parts])
        order = np.argsort(of, kind="stable")
        g = np.concatenate([x[1][:len(x[0])] for x in parts])[order]
        w = np.concatenate([x[1][len(x[0]):] for x in parts])[order]
        found = splits_of_rows(p, number, scale, of[order], g, w, np.concatenate([x[2] for x in parts], axis=1)[:, order], layout)
        found["job"] = np.full(len(found["node"]), job)
        return pa.table({name: pa.array(found[name], kind, safe=False) for name, kind in fields})

    partial = data.blocks.mapInArrow(add, "job int, grp int, node int, sums binary")
    if any(j.p.growth == "symmetric" for j, _ in chunk):
        # one split for all nodes of a tree: the tasks' sums are added by groups of nodes first
        found = partial.groupBy("job", "grp").applyInArrow(merge, partial.schema).groupBy("job").applyInArrow(choose, SPLITS)
    else:
        found = partial.groupBy("job", "grp").applyInArrow(choose, SPLITS)
    names = [name for name, _ in fields]
    got = found.toArrow()
    for r in zip(*(got.column(c).to_pylist() for c in names), strict=True):
        out.setdefault(r[0], {})[r[1]] = dict(zip(names, r, strict=True))


def split_node(j: Job, node: int, r: dict) -> None:
    """Give a node its two children."""
    t, p = j.tree, j.p
    t.col[node], t.code[node], t.missing_left[node] = r["col"], r["code"], r["missing_left"]
    gr, hr = r["g"] - r["gl"], r["h"] - r["hl"]
    t.left[node] = t.add(t.depth[node] + 1, leaf_number(r["gl"], r["hl"], p), r["hl"])
    t.right[node] = t.add(t.depth[node] + 1, leaf_number(gr, hr, p), hr)


def extend(j: Job, found: dict[int, dict]) -> None:
    """Take in the splits of the open nodes and open those that follow."""
    t, p = j.tree, j.p
    for node in j.open:
        r = found.get(node) or {"gain": 0.0, "col": -1, "g": 0.0, "h": 0.0}
        if node == 0:
            t.value[0], t.cover[0] = float(leaf_value(r["g"], r["h"], p)), r["h"]
        t.gain[node] = r["gain"] if r["col"] >= 0 and t.depth[node] < p.depth else 0.0
        if r["col"] >= 0 and t.depth[node] < p.depth:
            split_node(j, node, r)
        elif p.growth == "symmetric" and found and t.depth[node] < p.depth and (r0 := next(iter(found.values())))["col"] >= 0:
            # a node without rows splits with its level
            split_node(j, node, {**r0, "g": 0.0, "h": 0.0, "gl": 0.0, "hl": 0.0})
    kids = [c for v in j.open for c in (t.left[v], t.right[v]) if c >= 0]
    if p.growth != "leaf":
        j.open = [c for c in kids if t.depth[c] < p.depth]
        return
    for c in kids:
        if t.depth[c] >= p.depth:
            t.gain[c] = 0.0
    chosen, whole = replay(t, p.leaves)
    if whole:
        j.tree, j.open = prune(t, chosen), []
    else:
        waiting = [v for v in range(len(t.gain)) if t.gain[v] is None]
        parent = {c: v for v in range(len(t.gain)) for c in (t.left[v], t.right[v]) if c >= 0}
        needed = {v for v in waiting if parent[v] in chosen}
        # besides what the replay waits for, the children of the best others, as they may come next
        rest = sorted((v for v in waiting if v not in needed), key=lambda v: (-t.gain[parent[v]], v))
        j.open = sorted(needed | set(rest[: max(0, 2 * p.leaves - len(needed))]))


def replay(t: Tree, leaves: int) -> tuple[set[int], bool]:
    """The nodes that splitting the best leaf, again and again, has split; False where it needs a node not yet evaluated."""
    chosen: set[int] = set()
    if leaves <= 1:
        return chosen, True
    if t.gain[0] is None:
        return chosen, False
    front = [(-t.gain[0], 0)]
    while len(chosen) + 1 < leaves and front:
        gain, best = heapq.heappop(front)
        if gain >= 0:
            break
        chosen.add(best)
        kids = t.left[best], t.right[best]
        if len(chosen) + 1 < leaves and any(t.gain[v] is None for v in kids):
            return chosen, False
        for v in kids:
            heapq.heappush(front, (-(t.gain[v] or 0.0), v))
    return chosen, True


def prune(t: Tree, split: set[int]) -> Tree:
    """The tree whose inner nodes are those of split."""
    out = Tree()
    todo = [(0, out.add(0, t.value[0], t.cover[0]))]
    while todo:
        old, new = todo.pop()
        out.gain[new] = t.gain[old]
        if old not in split:
            continue
        out.col[new], out.code[new], out.missing_left[new] = t.col[old], t.code[old], t.missing_left[old]
        for side, kid in (("left", t.left[old]), ("right", t.right[old])):
            k = out.add(out.depth[new] + 1, t.value[kid], t.cover[kid])
            getattr(out, side)[new] = k
            todo.append((kid, k))
    return out


def grow(data: Binned, jobs: list[Job]) -> None:
    """Grow the trees of all jobs together, a pass a level."""
    for j in jobs:
        j.tree.add(0, 0.0, 0.0)
        j.open = [0]
    while True:
        active = [j for j in jobs if j.open]
        if not active:
            return
        found = evaluate(data, active)
        for j in active:
            extend(j, found.get(j.job, {}))


# ------------------------------------------------------------------ fitting

def fit_many(df: DataFrame, label: str, params: list[TreeParams]) -> list[HistogramModel]:
    """A model for each set of parameters. Rows without a label are left out.

    Rows that are at hand (see there) are sent to tasks that fit boosted models
    whole, or some trees of a forest. Else all models read the rows once a level.
    """
    data = binned(df, label)
    rows = at_hand(data.blocks, data.n, data.layout)
    models = fit_apart(df.sparkSession, data, rows, params) if rows is not None else fit_together(data, params)
    drop_scratch(data.blocks)
    return models


def holdout_errors(fit_part: DataFrame, val_part: DataFrame, label: str, params: list[TreeParams]) -> list[float]:
    """Root mean squared error on val_part of a model of fit_part for each set of parameters; NaN without rows.

    Where the rows are at hand, models stay in their tasks. Else those of a forest
    are fitted and scored one after the other, so the driver holds one of them.
    """
    data = binned(fit_part, label)
    rows = at_hand(data.blocks, data.n, data.layout)
    if rows is not None:
        val = val_part.where(q(label).isNotNull()).select(vector_to_array(F.col(VECTOR)).alias("x"), q(label).cast("double").alias("y"), F.lit(0).cast("long").alias("key"))
        blocks = cut_lineage(val.mapInArrow(coder(data.layout), BLOCK), "blocks")
        held_out = at_hand(blocks, blocks.agg(F.sum("n")).first()[0] or 0, data.layout)
        drop_scratch(blocks)
        if held_out is not None:
            drop_scratch(data.blocks)
            return errors_apart(fit_part.sparkSession, data, rows, held_out, params)
    out: list[float] = [math.nan] * len(params)
    boosted = [i for i, p in enumerate(params) if not p.forest]
    for group in [boosted] * bool(boosted) + [[i] for i, p in enumerate(params) if p.forest]:
        for i, e in zip(group, squared_errors(fit_together(data, [params[i] for i in group]), val_part, label), strict=True):
            out[i] = e
    drop_scratch(data.blocks)
    return out


def gradient_scale(data: Binned, p: TreeParams) -> float:
    """The power of two that gradients are multiplied by."""
    weight = 32.0 * p.unit if p.temperature > 0 or p.bootstrap else 1.0
    return 2.0 ** max(math.floor(math.log2(2.0**53 / (data.n * 4 * data.span * weight))), math.ceil(math.log2(2.0**20 / data.span)))


def fit_together(data: Binned, params: list[TreeParams]) -> list[HistogramModel]:
    """The models, a Spark job a level for all that grow.

    Boosted ensembles advance a round at a time, together.
    """
    models = [forest_together(data, p) if p.forest else HistogramModel(base=data.base, params=[asdict(p)]) for p in params]
    boosted = [i for i, p in enumerate(params) if not p.forest]
    since: dict[int, list] = {i: [] for i in boosted}
    for r in range(max((params[i].rounds for i in boosted), default=0)):
        if r and r % MARGIN_ROUNDS == 0:
            data.blocks = with_margins(data, [since[i] for i in boosted])
            since = {i: [] for i in boosted}
        jobs = [Job(i, params[i], r, k, gradient_scale(data, params[i]), since[i], Tree()) for k, i in enumerate(boosted) if r < params[i].rounds]
        grow(data, jobs)
        for j in jobs:
            since[j.job].append((j.tree.arrays(), j.p.rate))
            models[j.job].add(j.tree, data.layout, j.p.rate)
    return models


def forest_together(data: Binned, p: TreeParams) -> HistogramModel:
    """A forest. So many trees grow at once that they have about FOREST_ROWS rows; beyond BLOCK_NODES those that are grown are written."""
    spark, some = data.blocks.sparkSession, max(1, FOREST_ROWS // data.n)
    path, written, held = scratch_path(spark, f"trees-{uuid.uuid4().hex}"), 0, HistogramModel(0.0, [asdict(p)])
    for first in range(0, p.rounds, some):
        jobs = [Job(k, p, k, -1, gradient_scale(data, p), [], Tree()) for k in range(first, min(first + some, p.rounds))]
        grow(data, jobs)
        for j in jobs:
            held.add(j.tree, data.layout, 1.0 / p.rounds)
        if sum(held.tree_sizes()) > BLOCK_NODES or written and first + some >= p.rounds:
            held.nodes(spark).withColumn("tree", F.col("tree") + F.lit(written)).write.mode("append").parquet(path)
            written, held = written + len(held.trees), HistogramModel(0.0, [asdict(p)])
    return HistogramModel.of_table(0.0, [asdict(p)], spark.read.parquet(path)) if written else held


# ------------------------------------------------------------------ fitting where the rows are at hand

#: Coded rows of at most so many bytes are sent to tasks as a whole.
LOCAL_BYTES = 48 << 20
#: Trees of a forest that one task grows.
FOREST_TREES = 10
#: Rows of the trees of a forest that grow together where the rows are not at hand.
FOREST_ROWS = 4 << 20


@dataclass
class Rows:
    """All rows, coded: inputs x rows, labels and keys."""
    codes: np.ndarray
    y: np.ndarray
    key: np.ndarray


def at_hand(blocks: DataFrame, n: int, layout: Layout) -> Rows | None:
    """The rows of all blocks if they take at most LOCAL_BYTES."""
    p = len(layout.borders)
    if n * (p + 16) > LOCAL_BYTES:
        return None
    out = Rows(np.empty((p, n), np.uint8), np.empty(n), np.empty(n, np.int64))
    at = 0
    for batch in blocks.select("n", "codes", "y", "key").toArrow().to_batches():
        for k, codes, y, key in blocks_of(batch, "codes", "y", "key"):
            out.codes[:, at:at + k] = np.frombuffer(codes, np.uint8).reshape(p, k)
            out.y[at:at + k], out.key[at:at + k] = np.frombuffer(y), np.frombuffer(key, np.int64)
            at += k
    return out


def grow_here(p: TreeParams, number: int, scale: float, g: np.ndarray, w: np.ndarray, codes: np.ndarray, layout: Layout) -> Tree:
    """The tree of rows that are drawn and at hand; that of grow, as sums are exact."""
    j = Job(0, p, number, -1, scale, [], Tree())
    j.tree.add(0, 0.0, 0.0)
    j.open = [0]
    at, n = np.zeros(codes.shape[1], np.int64), codes.shape[1]
    missing, flat = layout.sizes - 1, codes.ravel()
    while j.open:
        t = j.tree
        mine = np.zeros(len(t.col), bool)
        mine[j.open] = True
        sel = np.flatnonzero(mine[at])
        sel = sel[np.argsort(at[sel], kind="stable")]
        found = {}
        if len(sel):
            whole = len(t.col) == 1
            got = splits_of_rows(p, number, scale, at[sel], *((g, w, codes) if whole else (g[sel], w[sel], codes[:, sel])), layout)
            for r in zip(*(got[c].tolist() for c in SPLIT_NAMES), strict=True):
                found[r[0]] = dict(zip(SPLIT_NAMES, r, strict=True))
        extend(j, found)
        if not j.open:
            break
        left = np.array(t.left)
        sel = sel[left[at[sel]] >= 0]
        node = at[sel]
        c = flat[np.array(t.col)[node] * n + sel]
        goes_left = (c <= np.array(t.code)[node]) | (c == missing[np.array(t.col)[node]]) & np.array(t.missing_left, bool)[node]
        at[sel] = np.where(goes_left, left[node], np.array(t.right)[node])
    return j.tree


def trees_here(p: TreeParams, first: int, last: int, scale: float, base: float, rows: Rows, layout: Layout):
    """Trees first to last - 1 of a model, all of them if it is boosted."""
    missing, m = layout.sizes - 1, np.zeros(len(rows.y)) if p.forest else np.full(len(rows.y), base)
    for k in range(first, last):
        w = draw(p, k, rows.key)
        sel = np.flatnonzero(w > 0)
        codes, y, mine = (rows.codes, rows.y, m) if len(sel) == len(w) else (rows.codes[:, sel], rows.y[sel], m[sel])
        w = w[sel]
        tree = grow_here(p, k, scale, np.rint((mine - y) * scale) * w, w, codes, layout)
        yield tree
        if not p.forest and k + 1 < last:
            t = tree.arrays()
            m = m + p.rate * t[5][place(t, rows.codes, missing, p.growth == "symmetric")]


def _units(params: list[TreeParams]) -> list[tuple[int, int, int]]:
    """(model, first tree, last tree) of each task, those that may take longest first."""
    out = []
    for i, p in enumerate(params):
        step = FOREST_TREES if p.forest else max(1, p.rounds)
        out += [(i, k, min(k + step, p.rounds)) for k in range(0, p.rounds, step)]
    return sorted(out, key=lambda u: (-(u[2] - u[1]) * min(params[u[0]].depth, 12), u))


def _apart(spark: SparkSession, data: Binned, rows: Rows, params: list[TreeParams], result, schema: str) -> DataFrame:
    """What result(unit, trees) yields for each unit, one to a task."""
    units, base, layout = _units(params), data.base, data.layout
    scales = [gradient_scale(data, p) for p in params]
    shared = spark.sparkContext.broadcast(rows)

    def run(batches):
        for batch in batches:
            for u in batch.column(0).to_pylist():
                i, first, last = units[u]
                yield from result(units[u], trees_here(params[i], first, last, scales[i], base, shared.value, layout))

    return spark.range(0, len(units), 1, max(1, len(units))).mapInArrow(run, schema)


def fit_apart(spark: SparkSession, data: Binned, rows: Rows, params: list[TreeParams]) -> list[HistogramModel]:
    """The models of rows at hand. Their nodes are written by the tasks; those of large ones do not reach the driver."""
    layout = data.layout

    def nodes(unit, trees):
        i, first, _ = unit
        rate = 1.0 / params[i].rounds if params[i].forest else params[i].rate
        for k, tree in enumerate(trees):
            t = node_arrays(tree, layout, rate)
            size = len(t["col"])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, i, np.int32)), pa.array(np.full(size, first + k, np.int32)), pa.array(np.arange(size, dtype=np.int32)),
                                              *(pa.array(t[c]) for c in NODE_NAMES)], names=["model", "tree", "node", *NODE_NAMES])

    table = cut_lineage(_apart(spark, data, rows, params, nodes, f"model int, {NODES}"), "trees")
    return [HistogramModel.of_table(0.0 if p.forest else data.base, [asdict(p)], table.where(F.col("model") == i).drop("model")) for i, p in enumerate(params)]


def errors_apart(spark: SparkSession, data: Binned, rows: Rows, held_out: Rows, params: list[TreeParams]) -> list[float]:
    """holdout_errors of rows at hand."""
    layout, val, n = data.layout, spark.sparkContext.broadcast(held_out), len(held_out.y)
    starts = [0.0 if p.forest else data.base for p in params]

    def sums(unit, trees):
        i, first, _ = unit
        p, missing = params[i], layout.sizes - 1
        total = np.full(n, starts[i] if first == 0 else 0.0)
        for tree in trees:
            t = tree.arrays()
            total += (t[5] * (1.0 / p.rounds if p.forest else p.rate))[place(t, val.value.codes, missing, p.growth == "symmetric")]
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([first], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["model", "first", "sums"])

    def error(t: pa.Table) -> pa.Table:
        t = t.sort_by("first")
        e = sum((np.frombuffer(b.as_buffer()) for b in t.column("sums")), np.zeros(n)) - val.value.y
        return pa.table({"model": t.column("model")[:1], "error": [float(e @ e)]})

    found = _apart(spark, data, rows, params, sums, "model int, first int, sums binary").groupBy("model").applyInArrow(error, "model int, error double")
    errors = {r["model"]: r["error"] for r in found.collect()}
    return [math.sqrt(errors[i] / n) if n else math.nan for i in range(len(params))]


def with_margins(data: Binned, since: list[list]) -> DataFrame:
    """The blocks with the given trees added to their margins, a row for each ensemble; the old table is dropped."""
    base, missing = data.base, data.layout.sizes - 1

    def run(batches):
        for batch in batches:
            for i, (n, codes, margin) in enumerate(blocks_of(batch, "codes", "margin")):
                codes = np.frombuffer(codes, np.uint8).reshape(-1, n)
                m = np.frombuffer(margin).reshape(-1, n).copy() if margin.size else np.full((len(since), n), base)
                for k, trees in enumerate(since):
                    for t, rate in trees:
                        m[k] += rate * t[5][place(t, codes, missing)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, 1) for c in ("n", "codes", "y", "key")), pa.array([m.tobytes()], pa.binary())],
                                                 names=["n", "codes", "y", "key", "margin"])

    old = data.blocks
    new = cut_lineage(old.mapInArrow(run, old.schema), "blocks")
    drop_scratch(old)
    return new


# ------------------------------------------------------------------ models

NODES = "tree int, node int, col int, threshold double, missing_left boolean, left int, right int, value double, cover double, gain double"
NODE_NAMES = [c.split()[0] for c in NODES.split(", ")][2:]


def node_arrays(t: Tree, layout: Layout, rate: float) -> dict[str, np.ndarray]:
    """A grown tree as a model holds it, by NODE_NAMES."""
    thresholds = [layout.threshold(c, k) if c >= 0 else math.nan for c, k in zip(t.col, t.code, strict=True)]
    return {"col": np.array(t.col, np.int32), "threshold": np.array(thresholds), "missing_left": np.array(t.missing_left, bool),
            "left": np.array(t.left, np.int32), "right": np.array(t.right, np.int32), "value": np.array(t.value) * rate,
            "cover": np.array(t.cover, float), "gain": np.array([g or 0.0 for g in t.gain])}


def trees_of(nodes: DataFrame) -> list[dict[str, np.ndarray]]:
    """The trees of a table of nodes."""
    t = nodes.toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])
    col = {c: t.column(c).to_numpy() for c in NODE_NAMES}
    starts = np.flatnonzero(np.diff(t.column("tree").to_numpy(), prepend=-1))
    return [{c: x[a:b] for c, x in col.items()} for a, b in zip(starts, np.append(starts[1:], t.num_rows), strict=True)]


@dataclass
class HistogramModel:
    """A fitted ensemble: prediction = base + the value of the leaf of each tree. Nodes by tree, values scaled.

    The trees of a model of over BLOCK_NODES nodes stay in a table; ``sizes`` are their nodes.
    """
    base: float
    params: list[dict] = field(default_factory=list)
    trees: list[dict[str, np.ndarray]] = field(default_factory=list)
    table: DataFrame | None = None
    sizes: list[int] = field(default_factory=list)

    @staticmethod
    def of_table(base: float, params: list[dict], table: DataFrame) -> HistogramModel:
        """The model of a written table of nodes."""
        sizes = [r["count"] for r in table.groupBy("tree").count().orderBy("tree").collect()]
        if sum(sizes) <= BLOCK_NODES:
            return HistogramModel(base, params, trees_of(table))
        return HistogramModel(base, params, [], table, sizes)

    def add(self, t: Tree, layout: Layout, rate: float) -> None:
        self.trees.append(node_arrays(t, layout, rate))

    def tree_sizes(self) -> list[int]:
        return self.sizes if self.table is not None else [len(t["col"]) for t in self.trees]

    def some(self, first: int, last: int) -> list[dict[str, np.ndarray]]:
        """Trees first to last - 1."""
        return self.trees[first:last] if self.table is None else trees_of(self.table.where((F.col("tree") >= first) & (F.col("tree") < last)))

    def parts(self, weights: list[int], most: int) -> list[tuple[int, int]]:
        """(first, last) of runs of trees of at most so much weight; a tree is not cut."""
        out, first, held = [], 0, 0
        for k, w in enumerate(weights):
            if k > first and held + w > most:
                out.append((first, k))
                first, held = k, 0
            held += w
        return [*out, (first, len(weights))]

    def blocks(self, nodes: int = 0) -> list[list[dict[str, np.ndarray]]]:
        """The trees in blocks of at most so many nodes (a tree is not cut)."""
        return [self.some(*x) for x in self.parts(self.tree_sizes(), nodes or BLOCK_NODES)]

    def transform(self, df: DataFrame) -> DataFrame:
        """df with a prediction. Beyond BLOCK_NODES the sum is written after each block of trees, so one block is held at a time."""
        sc, out = df.sparkSession.sparkContext, df.withColumn("prediction", F.lit(self.base))
        parts = self.parts(self.tree_sizes(), BLOCK_NODES)
        for k, part in enumerate(parts):
            out = out.withColumn("prediction", adder(sc.broadcast(self.some(*part)))(vector_to_array(F.col(VECTOR)), F.col("prediction")))
            if k + 1 < len(parts):
                out = cut_lineage(out, "scores")
        return out

    def nodes(self, spark: SparkSession) -> DataFrame:
        """All nodes as a table."""
        if self.table is not None:
            return self.table
        parts = [pa.table({"tree": np.full(len(t["col"]), k, np.int32), "node": np.arange(len(t["col"]), dtype=np.int32), **{c: t[c] for c in NODE_NAMES}})
                 for k, t in enumerate(self.trees)]
        if not parts:
            return spark.createDataFrame([], NODES)
        return spark.createDataFrame(pa.concat_tables(parts).to_pandas(), NODES)

    def save(self, spark: SparkSession, path: str) -> None:
        self.nodes(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        about = json.dumps({"base": self.base, "params": self.params, "n_trees": len(self.tree_sizes())})
        spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> HistogramModel:
        about = json.loads(spark.read.text(f"{path}/about").first()["value"])
        return HistogramModel.of_table(about["base"], about["params"], spark.read.parquet(f"{path}/nodes"))


def adder(shared):
    """A function of vectors and sums so far that adds the values of a broadcast block of trees."""
    @F.pandas_udf("double")
    def add(x: pd.Series, before: pd.Series) -> pd.Series:
        if not len(x):
            return before
        m = np.stack(x.to_numpy()).astype(float)
        return pd.Series(sum((t["value"][walk(t, m)] for t in shared.value), before.to_numpy(float)))

    return add


def walk(t: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The leaf each row of x (rows x inputs, NaN: missing) ends in."""
    node = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    while len(rows):
        rows = rows[t["left"][node[rows]] >= 0]
        at = node[rows]
        v = x[rows, t["col"][at]]
        goes_left = np.where(np.isnan(v), t["missing_left"][at], v <= t["threshold"][at])
        node[rows] = np.where(goes_left, t["left"][at], t["right"][at])
    return node


def squared_errors(models: list[HistogramModel], df: DataFrame, label: str) -> list[float]:
    """Root mean squared error of each model on df, in one scan; NaN without rows."""
    spark = df.sparkSession
    d = df.where(q(label).isNotNull()).select(vector_to_array(F.col(VECTOR)).alias("x"), q(label).cast("double").alias("y"))
    sums, n = np.zeros(len(models)), 0
    todo = [(i, m.base, m.trees) for i, m in enumerate(models)]
    while todo:  # as many models as fit one broadcast, one at least
        part, size = [], 0
        while todo and (not part or size + sum(len(t["col"]) for t in todo[0][2]) <= BLOCK_NODES):
            part.append(todo.pop(0))
            size += sum(len(t["col"]) for t in part[-1][2])
        shared = spark.sparkContext.broadcast(part)

        def run(batches, shared=shared):
            total, rows = np.zeros(len(shared.value)), 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, y = np.stack(batch.column("x").to_numpy(zero_copy_only=False)).astype(float), batch.column("y").to_numpy()
                rows += len(y)
                for k, (_, base, trees) in enumerate(shared.value):
                    e = sum((t["value"][walk(t, x)] for t in trees), np.full(len(y), base)) - y
                    total[k] += e @ e
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64())), pa.array([rows], pa.int64())], names=["e", "n"])

        got = d.mapInArrow(run, "e array<double>, n long").agg(F.sum("n").alias("n"), *[F.sum(F.get("e", F.lit(k))).alias(f"e{k}") for k in range(len(part))]).first()
        n = got["n"] or 0
        for k, (i, *_) in enumerate(part):
            sums[i] = got[f"e{k}"] or 0.0
    return [math.sqrt(s / n) if n else math.nan for s in sums]


