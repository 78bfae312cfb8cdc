"""Operator 11, ranked lexical search: K2-treaps over the term-document grid.

The index is a table of shards, each of about SHARD_CELLS cells (distinct terms
of a document) of consecutive input rows. A shard's grid has a row for each of
its terms, the most frequent first, and a column for each document, by id. The
rows are cut into bands as high as the grid is wide; each band is a quadtree
whose nodes hold the greatest impact below them, four bits that tell which
quarters are not empty, and, where a single cell is left, that cell's place
instead of a path (the compression). Nodes of one depth lie together, so children
are found by counting bits.

A search reads each shard once. For each item the paths of all its terms' rows
descend together: a state is a document range with the node of each term over
it, and its bound is the sum of weight times greatest impact. The ranges of the
highest bounds are halved first; a range of one document has its exact score. A
range goes only when its bound, or its bound and smallest id, cannot reach the
item's ten best so far.

Impacts depend on the number and mean length of all documents, which a first pass
counts; weights depend on the terms' document frequencies, summed over shards.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offblock.llm.common import arrow_batches, written

TOP = 10
#: Cells of a shard, about: what a task holds at a time. A document is never cut.
SHARD_CELLS = 1 << 20
#: Characters of item texts that are searched for in one pass over the index, about.
BLOCK_CHARS = 4 << 20
#: Nodes that are expanded in one step.
STEP_NODES = 4096
#: A shard is a row group of its own, without dictionaries and least and greatest values. A writer holds
#: a row group, whose size it first looks at after 100 rows, and the extremes of all row groups of its file,
#: so it would hold all shards of its task; a reader would decode all of them at a time.
ONE_ROW = {"parquet.block.row.count.limit": "1", "parquet.enable.dictionary": "false", "parquet.column.statistics.enabled": "false"}
LAST = np.iinfo(np.int64).max

#: Other bytes than those of terms end a term; A-Z are lower-cased.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

INDEX = "first_id long, n_docs int, terms array<string>, dfs array<int>, ids binary, known binary, heads binary, kids binary, peaks binary, leaf_rows binary, leaf_cols binary"


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a whole UTF-8 text."""
    return (text or b"").translate(TERM_BYTES).split()


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all terms of all documents; two numbers a task are added up."""
    def run(batches):
        n = total = 0
        for batch in batches:
            for t in batch.column(0).cast(pa.binary()).to_pylist():
                k = len(terms_of(t))
                n, total = n + (k > 0), total + k
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total], pa.int64())], names=["n", "total"])

    r = docs.select("text").mapInArrow(run, "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    return r[0] or 0, r[1] or 0


def interleaved(rows: np.ndarray, cols: np.ndarray, bits: int) -> np.ndarray:
    """Band, then row and column bits in turn, from the highest: the order of a quadtree."""
    out = (rows >> bits).astype(np.uint64)
    for b in range(bits - 1, -1, -1):
        out = out << np.uint64(2) | ((rows >> b & 1) << 1 | cols >> b & 1).astype(np.uint64)
    return out


def build_treap(rows: np.ndarray, cols: np.ndarray, impact: np.ndarray, bits: int, bands: int) -> dict[str, np.ndarray]:
    """The quadtrees of cells (row, col, impact) in a grid 2**bits wide.

    Nodes in order of depth, then place. heads: node of each band's root or -1;
    kids: four bits a node, 0 for a single cell; peaks: greatest impact below;
    leaf_rows, leaf_cols: places of the single cells, in order of nodes.
    """
    key = interleaved(rows, cols, bits)
    order = np.argsort(key)
    key, rows, cols, impact = key[order], rows[order], cols[order], impact[order]
    heads = np.full(bands, -1, np.int32)
    kids, peaks, leaf_rows, leaf_cols = [], [], [], []
    for depth in range(bits + 1):
        if not len(key):
            break
        node = key >> np.uint64(2 * (bits - depth))
        starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        if depth == 0:
            heads[node[starts].astype(np.int64)] = np.arange(len(starts), dtype=np.int32)
        peaks.append(np.maximum.reduceat(impact, starts))
        single = sizes == 1
        bitmap = np.zeros(len(starts), np.uint8)
        if depth < bits:
            quarter = (key >> np.uint64(2 * (bits - depth - 1)) & np.uint64(3)).astype(np.uint8)
            bitmap = np.bitwise_or.reduceat(np.uint8(1) << quarter, starts)
            bitmap[single] = 0
        kids.append(bitmap)
        leaf_rows.append(rows[starts[single]])
        leaf_cols.append(cols[starts[single]])
        left = np.repeat(~single, sizes)
        key, rows, cols, impact = key[left], rows[left], cols[left], impact[left]
    join = lambda parts, kind: np.concatenate([np.empty(0, kind), *parts]).astype(kind)
    return {"heads": heads, "kids": join(kids, np.uint8), "peaks": join(peaks, np.int32),
            "leaf_rows": join(leaf_rows, np.int32), "leaf_cols": join(leaf_cols, np.int32)}


def build_index(docs: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """The shards of INDEX over all rows of docs (doc_id, text). Rows without a term have no cells."""
    def shard(ids, lengths, each, vocabulary, rows, tf):
        # columns by id, rows without one last
        known = np.array([i is not None for i in ids])
        number = np.array([LAST if i is None else i for i in ids], np.int64)
        order = np.lexsort((~known, number))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        rows, tf = np.frombuffer(rows, np.int32).astype(np.int64), np.frombuffer(tf, np.int64)
        cols, n = np.repeat(place, each), np.repeat(np.array(lengths, np.int64), each)
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * (100 - 90 + 90 * n * n_docs // n_terms))
        dfs = np.bincount(rows, minlength=len(vocabulary))
        by_df = np.argsort(-dfs, kind="stable")
        rank = np.empty(len(by_df), np.int64)
        rank[by_df] = np.arange(len(by_df))
        bits = max(1, int(len(ids) - 1).bit_length())
        treap = build_treap(rank[rows], cols, impact, bits, ((len(vocabulary) - 1) >> bits) + 1)
        words = list(vocabulary)
        return [int(number[order][0]), len(ids), [words[k].decode() for k in by_df], dfs[by_df].tolist(), number[order].tobytes(), known[order].tobytes(),
                *(treap[k].tobytes() for k in ("heads", "kids", "peaks", "leaf_rows", "leaf_cols"))]

    kinds = [pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), *[pa.binary()] * 7]
    names = [c.split()[0] for c in INDEX.split(", ")]

    def run(batches):
        # documents, their terms and cells so far; words are kept once, cells as numbers
        held = [], [], [], {}, array("i"), array("q")
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                terms = terms_of(t)
                if not terms:
                    continue
                ids, lengths, each, vocabulary, rows, tf = held
                c = Counter(terms)
                ids.append(i)
                lengths.append(len(terms))
                each.append(len(c))
                rows.extend([vocabulary.setdefault(t, len(vocabulary)) for t in c])
                tf.extend(c.values())
                if len(rows) >= SHARD_CELLS:
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(shard(*held), kinds, strict=True)], names=names)
                    held = [], [], [], {}, array("i"), array("q")
        if held[0]:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(shard(*held), kinds, strict=True)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, INDEX)


class Shard:
    """One shard, ready for descents."""

    def __init__(self, row: dict):
        get = lambda name, kind: np.frombuffer(row[name] or b"", kind)
        self.n, self.ids, self.known = row["n_docs"], get("ids", np.int64), get("known", bool)
        self.bits = max(1, (self.n - 1).bit_length())
        self.heads, self.kids, self.peaks = get("heads", np.int32), get("kids", np.uint8), get("peaks", np.int32)
        size = np.bitwise_count(self.kids).astype(np.int64)
        # nodes lie in order of depth and place: a node's children follow those of all nodes before it
        self.first = (np.cumsum(size) - size + np.count_nonzero(self.heads >= 0)).astype(np.int32)
        leaf = self.kids == 0
        at = np.cumsum(leaf) - 1
        rows, cols = get("leaf_rows", np.int32), get("leaf_cols", np.int32)
        self.leaf_row, self.leaf_col = np.full(len(leaf), -1, np.int32), np.full(len(leaf), -1, np.int32)
        self.leaf_row[leaf], self.leaf_col[leaf] = rows[at[leaf]], cols[at[leaf]]

    def best(self, rows: np.ndarray, weights: np.ndarray, top: list[tuple[int, int, bool]], k: int = TOP) -> list[tuple[int, int, bool]]:
        """The k best of top and this shard's documents, as (-score, id, id is missing), by the weights of the terms in rows."""
        bits = self.bits
        heads = self.heads[rows >> bits]
        node = np.where((heads >= 0) & ((self.leaf_row[heads] < 0) | (self.leaf_row[heads] == rows)), heads, -1)[None, :]
        depth, start = np.zeros(1, np.int64), np.zeros(1, np.int64)
        bound = (np.where(node >= 0, self.peaks[node], 0) * weights).sum(1)
        step = max(1, STEP_NODES // max(1, len(rows)))
        while len(bound):
            # what cannot reach the k best goes: by its bound, or with an equal one by its smallest id
            live = bound > 0
            if len(top) == k:
                live &= (bound > -top[-1][0]) | ((bound == -top[-1][0]) & (self.ids[start] <= top[-1][1]))
            if not live.all():
                bound, depth, start, node = bound[live], depth[live], start[live], node[live]
                if not len(bound):
                    break
            if len(bound) > step:
                pick = np.argpartition(-bound, step)[:step]
                rest = np.ones(len(bound), bool)
                rest[pick] = False
                held = bound[rest], depth[rest], start[rest], node[rest]
                b, d, s, m = bound[pick], depth[pick], start[pick], node[pick]
            else:
                held, (b, d, s, m) = None, (bound, depth, start, node)
            done = d == bits
            if done.any():
                found = [(-int(x), int(self.ids[i]), not self.known[i]) for x, i in zip(b[done], s[done], strict=True)]
                top = sorted(top + found)[:k]
                d, s, m = d[~done], s[~done], m[~done]
            parts = [] if held is None else [held]
            if len(d):
                shift = bits - d - 1
                here = m >= 0
                at = np.where(here, m, 0)
                bitmap, first = self.kids[at], self.first[at]
                leaf_row, leaf_col = self.leaf_row[at], self.leaf_col[at]
                row_bit = rows[None, :] >> shift[:, None] & 1
                for half in (0, 1):
                    begin = s + (half << shift)
                    quarter = (row_bit << 1 | half).astype(np.uint8)
                    inner = here & (bitmap >> quarter & 1 == 1)
                    child = first + np.bitwise_count(bitmap & ((np.uint8(1) << quarter) - np.uint8(1)))
                    child = np.where(inner, child, 0)
                    child = np.where(inner & ((self.leaf_row[child] < 0) | (self.leaf_row[child] == rows[None, :])), child, -1)
                    # a single cell stays what it is, in the half that has its column
                    stays = here & (leaf_row >= 0) & ((leaf_col >> shift[:, None]) == (begin >> shift)[:, None])
                    child = np.where(stays, at, child)
                    new = (np.where(child >= 0, self.peaks[child], 0) * weights).sum(1)
                    ok = new > 0
                    parts.append((new[ok], d[ok] + 1, begin[ok], child[ok]))
            bound, depth, start, node = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.empty(0, np.int64),) * 4
        return top


def search(index: DataFrame, items: list[tuple], k: int = TOP) -> DataFrame:
    """(item, doc_id, score): candidates for the k best documents of each of items (item, [(term, weight)]), some k for each task."""
    shared = index.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        wanted = shared.value
        vocabulary = pa.array(sorted({t for _, terms in wanted for t, _ in terms}), pa.string())
        code = {t: c for c, t in enumerate(vocabulary.to_pylist())}
        codes = [np.array([code[t] for t, _ in terms], np.int64) for _, terms in wanted]
        weights = [np.array([w for _, w in terms], np.int64) for _, terms in wanted]
        tops: list[list] = [[] for _ in wanted]
        for batch in batches:
            for r in range(batch.num_rows):
                terms = batch.column("terms")[r].values
                row_of = pc.index_in(vocabulary, value_set=terms).fill_null(-1).to_numpy(zero_copy_only=False)
                shard = Shard({c: batch.column(c)[r].as_py() for c in batch.schema.names if c != "terms"})
                for q in range(len(wanted)):
                    rows = row_of[codes[q]].astype(np.int64)
                    has = rows >= 0
                    if has.any():
                        tops[q] = shard.best(rows[has], weights[q][has], tops[q], k)
        out = [(wanted[q][0], None if missing else i, -score) for q, top in enumerate(tops) for score, i, missing in top]
        item, doc, score = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return index.drop("first_id", "dfs").mapInArrow(run, "item int, doc_id long, score long")


def ranked_search(documents: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each row of items (item_id, text).

    All documents are indexed and counted. Equal scores are ordered by doc_id, rows
    without one last; rows that repeat an id are documents of their own, and rows of
    items that repeat an item_id, or have none, are items of their own. Null and
    empty texts have no terms: such documents are not found, such items find
    nothing. Empty tables give an empty result. Other columns are not read.
    Items are searched for in blocks of about BLOCK_CHARS characters, each a
    pass over the index; only a block's terms and weights are broadcast.
    """
    spark = documents.sparkSession
    d = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with arrow_batches(spark, 1000):
        n_docs, n_terms = corpus_size(d)
    i = items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chars = i.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    kind = i.schema["item_id"].dataType.simpleString()
    empty = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    if not n_docs or not blocks:
        return empty
    with arrow_batches(spark, 1000):
        index = written(build_index(d, n_docs, n_terms), "index", ONE_ROW)
    out = empty
    for block in range(blocks):
        mine = i.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == block).collect()
        asked = [(n, r["item_id"], sorted({t.decode() for t in terms_of(r["text"].encode())})) for n, r in enumerate(mine)]
        words = spark.createDataFrame([(t,) for t in sorted({t for *_, terms in asked for t in terms})], "term string")
        held = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.dfs").alias("df"))
        df = {r["term"]: r["df"] for r in held.join(words, "term").groupBy("term").agg(F.sum("df").alias("df")).collect()}
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for t, c in df.items()}
        wanted = [(n, [(t, weight[t]) for t in terms if weight.get(t, 0) > 0]) for n, _, terms in asked]
        with arrow_batches(spark, 1):  # a shard at a time
            found = written(search(index, wanted, k), "found")
        w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        ids = spark.createDataFrame([(n, item) for n, item, _ in asked], f"item int, item_id {kind}")
        out = out.unionByName(best.join(ids, "item").select("item_id", "rank", "doc_id", "score"))
    return out


OP11_SQL = """
WITH d AS (
  SELECT doc_id, ROW_NUMBER() OVER () AS r,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
  FROM documents),
sized AS (SELECT doc_id, r, t, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
total AS (SELECT COUNT(*)::BIGINT AS big_n, SUM(n)::BIGINT AS big_l FROM sized),
tf AS (SELECT r, term, COUNT(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM sized) GROUP BY r, term),
df AS (SELECT term, COUNT(*)::BIGINT AS df FROM tf GROUP BY term),
q AS (
  SELECT DISTINCT item_id, i, term FROM (
    SELECT item_id, i, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM (SELECT item_id, text, ROW_NUMBER() OVER () AS i FROM benchmark))),
scored AS (
  SELECT q.item_id, q.i, s.doc_id, s.r, SUM(
           floor(1000 * ln((2 * big_n + 2) / (2 * df.df + 1)))::BIGINT
           * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (100 - 90 + (90 * s.n * big_n) // big_l))))::BIGINT AS score
  FROM q JOIN df USING (term) JOIN tf USING (term) JOIN sized s USING (r) CROSS JOIN total GROUP BY ALL),
ranked AS (
  SELECT item_id, ROW_NUMBER() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
