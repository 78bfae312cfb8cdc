"""Operator 6, n-gram Jaccard join: rare-first prefix filtering on word shingles.

Words are split at blanks, A-Z lower-cased; a document's set holds its distinct
5-word shingles as 64-bit hashes, or its whole word sequence if it has fewer
words. Documents with equal sets are one node.

- Document frequencies of all shingles of all documents are counted in
  2**COUNTER_BITS hashed counters (a fixed size, so they can be broadcast). Any
  common order gives right results; counting decides how rare the prefix is.
- Sorted rare-first, two sets with Jaccard >= t share one of their first
  n - ceil(t n) + 1 shingles; only these are shuffled, once.
- Length filter: t na <= nb. Positional filter: at the first common prefix
  shingle, what follows must still hold the required overlap.
- Suffix filter: each half of the hash space, each half of that and so on, down to
  RANGES ranges, bounds the overlap from above by the sets' counts in it; the
  finest ranges give the tightest bound of the recursion and are compared at once.
- Each pair left is verified once, on the full sets.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offblock.llm.common import partitions, semi, small_batches, written
from offblock.llm.linking import in_tasks, link, shared_entries
from offblock.session import drop_scratch

WORDS = 5
#: Similarity in hundredths.
PERCENT = 75
COUNTER_BITS = 20
COUNTERS_PER_ROW = 4096
#: Hash ranges of the suffix filter: eight halvings.
RANGES = 256
#: Word hashes that a task keeps.
CACHE_WORDS = 150_000
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD,
                        0xC4CEB9FE1A85EC53], np.uint64)


class WordHashes(dict):
    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text; empty without words."""
    w = (text or b"").lower().split()  # bytes: A-Z and the six blanks of the contract only
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, w), np.uint64, len(w))
    m = MULTIPLIERS
    with np.errstate(over="ignore"):
        if len(w) < WORDS:
            s = (h * m[: len(h)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(w)) * m[WORDS]
        else:
            k = len(h) - WORDS + 1
            s = h[:k] * m[0]
            for i in range(1, WORDS):
                s += h[i : i + k] * m[i]
        s ^= s >> np.uint64(29)
        s *= m[1]
        s ^= s >> np.uint64(32)
    return np.unique(s)


def node_of(s: np.ndarray) -> int | None:
    """64-bit digest of a set; null for the empty one."""
    if not len(s):
        return None
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


SETS = "doc_id long, n int, node long, part int, counts binary"


class Counters:
    """Hashed counters of shingles, filled in blocks."""

    BLOCK = 1 << 20

    def __init__(self):
        self.counts, self.held, self.size = np.zeros(1 << COUNTER_BITS, np.int64), [], 0

    def add(self, s: np.ndarray) -> None:
        self.held.append(s)
        self.size += len(s)
        if self.size >= self.BLOCK:
            self.flush()

    def flush(self) -> None:
        if self.held:
            self.counts += np.bincount(counter_of(np.concatenate(self.held)), minlength=len(self.counts))
        self.held, self.size = [], 0


def counter_of(s: np.ndarray) -> np.ndarray:
    return (s & np.uint64((1 << COUNTER_BITS) - 1)).astype(np.int64)


def range_counts(s: np.ndarray) -> bytes:
    """How many shingles lie in each of RANGES hash ranges, a byte each, at most 255.

    Counts cut off at 255 differ by no more than the counts, so the bound on the overlap still holds.
    """
    return np.minimum(np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=RANGES), 255).astype(np.uint8).tobytes()


def overlap_filter(batches):
    """Pairs (a, b, na, nb, ra, rb) whose overlap the hash ranges do not bound below the need."""
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, RANGES).astype(np.int16) for c in ("ra", "rb"))
        n = batch.column("na").to_numpy().astype(np.int64) + batch.column("nb").to_numpy()
        most = (n - np.abs(x - y).sum(1, dtype=np.int64)) // 2
        ok = pa.array(100 * most >= PERCENT * (n - most), pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(ok) for c in ("a", "b", "na", "nb")], names=["a", "b", "na", "nb"])


def true_links(batches):
    """Pairs (a, b, na, nb, sa, sb) of enough Jaccard similarity; sa and sb are the sets, as bytes of sorted hashes."""
    for batch in batches:
        ok = []
        for na, nb, sa, sb in zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "sa", "sb")), strict=True):
            both = len(np.intersect1d(np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64), assume_unique=True))
            ok.append(100 * both >= PERCENT * (na + nb - both))
        mask = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])


def set_rows(batches):
    """A row (doc_id, n, node, counts by hash range) for each document, then the task's shingle counts by ranges of counters."""
    hashes, counters = WordHashes(), Counters()
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("part", pa.int32()), ("counts", pa.binary())])
    for batch in batches:
        n, node, ranges = [], [], []
        for text in texts(batch, "text"):
            s = shingle_set(text, hashes)
            counters.add(s)
            n.append(len(s))
            node.append(node_of(s))
            ranges.append(range_counts(s))
        k = len(n)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(node, pa.int64()), pa.nulls(k, pa.int32()),
                                          pa.array(ranges, pa.binary())], schema=schema)
    counters.flush()
    rows = counters.counts.reshape(-1, COUNTERS_PER_ROW)
    parts = [i for i in range(len(rows)) if rows[i].any()]
    k = len(parts)
    yield pa.RecordBatch.from_arrays([
        pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()),
        pa.array(parts, pa.int32()), pa.array([rows[i].astype(np.int32).tobytes() for i in parts], pa.binary())], schema=schema)


def summed(rows: DataFrame) -> np.ndarray:
    """The counters over all tasks. 2**COUNTER_BITS of them, whatever the input, reach the driver."""
    def run(batches):
        sums = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts, np.int32).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                                         names=["part", "counts"])

    parts = rows.where("part is not null").select("part", "counts").repartition(partitions(rows.sparkSession), "part")
    out = np.zeros((1 << COUNTER_BITS) // COUNTERS_PER_ROW * COUNTERS_PER_ROW, np.int64).reshape(-1, COUNTERS_PER_ROW)
    for r in parts.mapInArrow(run, "part int, counts binary").collect():
        out[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return out.ravel()


def prefix_entries(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """(key, node, n, pos): the prefix shingles of each distinct set, rare-first."""
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(counts, 2**31 - 1).astype(np.int32))
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])

    def run(batches):
        hashes, freq, seen = WordHashes(), shared.value, set()
        for batch in batches:
            keys, nodes, sizes, places = [], [], [], []
            for text in texts(batch, "text"):
                s = shingle_set(text, hashes)
                node = node_of(s)
                if node is None or node in seen:  # a copy in this task; others meet in the shuffle
                    continue
                if len(seen) >= CACHE_WORDS:
                    seen.clear()
                seen.add(node)
                p = len(s) - (PERCENT * len(s) + 99) // 100 + 1
                order = np.lexsort((s, freq[counter_of(s)]))[:p]
                keys.append(s[order].view(np.int64))
                nodes.append(np.full(p, node, np.int64))
                sizes.append(np.full(p, len(s), np.int32))
                places.append(np.arange(p, dtype=np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, nodes, sizes, places)], schema=schema)

    return docs.select("text").mapInArrow(run, "key long, node long, n int, pos int")


def full_sets(docs: DataFrame) -> DataFrame:
    """(node, shingles) of each document's set."""
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for part in range(0, batch.num_rows, 256):
                sets = [shingle_set(t, hashes) for t in texts(batch.slice(part, 256), "text")]
                yield pa.RecordBatch.from_arrays([
                    pa.array([node_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "shingles"])

    return docs.select("text").mapInArrow(run, "node long, shingles binary")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row: the smallest doc_id reachable by links of Jaccard >= 0.75.

    Null, empty and blank texts have an empty set and are linked with nothing.
    Rows with equal sets are linked, so repeated rows and ids share a component.
    A missing id has a null component unless its component holds an id. Sets are
    compared by 64-bit hashes of their shingles. Other columns are not read.
    """
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    small_batches(docs.sparkSession)
    both = written(d.mapInArrow(set_rows, SETS), "sets")
    rows = both.where("part is null").select("doc_id", "n", "node")
    counts = summed(both)
    ranges = both.where("part is null and node is not null")
    nodes = written(ranges.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("counts").alias("ranges")), "nodes")

    need = F.ceil((F.col("na") + F.col("nb")) * PERCENT / (100.0 + PERCENT) - 1e-9)
    rest = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    length = 100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")

    def verify(pairs: DataFrame, size: int) -> DataFrame:
        info = nodes.select("node", "ranges")
        p = pairs.join(info.toDF("a", "ra"), "a").join(info.toDF("b", "rb"), "b")
        p = written(in_tasks(p, size).mapInArrow(overlap_filter, "a long, b long, na int, nb int"), "suffix")
        ids = p.select("a").unionByName(p.select(F.col("b").alias("a"))).toDF("node").distinct()
        of = written(nodes.select("node", "doc_id").join(ids, "node"), "asked")
        sets = full_sets(semi(d, of.select("doc_id"), "doc_id")).join(of.select("node"), "node", "left_semi").dropDuplicates(["node"])
        sets = written(sets, "shingles")
        q = p.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
        links = written(q.mapInArrow(true_links, "a long, b long"), "links")
        for t in (p, of, sets):
            drop_scratch(t)
        return links

    entries = written(shared_entries(prefix_entries(d, counts)), "entries")
    labels = link(entries, verify, length & (rest >= need), length)
    ids = nodes.join(labels, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("c"))
    low = ids.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    of = ids.join(low, "c").select("node", "component_id")
    out = rows.join(of, "node", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                      F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of docs whose id is the smallest of its component; one of rows that repeat an id and text.

    Rows without an id come after all others, in the order of a hash of their text; of
    those with equal texts one is left. All columns of docs are kept.
    """
    own = f"own_{uuid.uuid4().hex}"
    far = 1 << 62  # beyond the ids of documents
    d = docs.withColumn(own, F.coalesce(F.col(doc_id).cast("long"), F.lit(far) + F.pmod(F.xxhash64(F.col(text).cast("string")), F.lit(far))))
    gone = jaccard_components(d, own, text).where("doc_id <> component_id").select(F.col("doc_id").alias(own)).distinct()
    return d.join(gone, own, "left_anti").dropDuplicates([own, text]).select(*docs.columns)
