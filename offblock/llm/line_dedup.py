"""Operator 7, line dedup: segment-partition edit join on lines.

All lines (split at newlines) but blank ones are compared. Two lines are alike
within the edits (insert, delete, replace a code point) that the shorter one
allows: one for every EDIT_CHARS code points, at most EDITS; so lines of under
EDIT_CHARS are alike only if they are equal. Classes are the components of that
relation. The first line of a class, by (doc_id, line number), stays; all others
are dropped.

Equal lines are one node. A line of length l that allows e edits is cut into e + 1
segments; if a longer one is within e edits of it, that holds one of its segments
at a place that is off by little. So each line is filed under its segments, and
probes, for each shorter length l within the edits that l allows, the substrings
that such a segment could be (the multi-match-aware window). Lines that meet under
a key (length, segment number, substring) are verified with a banded bit-parallel
edit distance, which stops as soon as the band holds no distance within e.

Lines that share a segment with very many others are filed anew, under halves: two
lines within e edits have an equal half, and the other half within e edits, or (for
e = 2) each half within one edit. Halves of what is left open are compared in turn,
until few lines meet under a key. So many lines with one passage in common, or many
near copies of one line that are not alike, do not meet in pairs.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offblock.llm.common import BLANKS, semi, small_batches, written
from offblock.llm.linking import in_tasks, link, shared_entries
from offblock.session import drop_scratch

EDITS = 2
#: Code points of a line for each edit that it allows.
EDIT_CHARS = 20
#: Code points of the shortest line that is compared: all lines but blank ones are.
MIN_CHARS = 1
#: Digests of lines seen that a task keeps.
SEEN_LINES = 200_000


def compared(line: str) -> bool:
    return len(line) >= MIN_CHARS and bool(line.strip(BLANKS))


def edits_of(length: int) -> int:
    """The edits that a line allows, if it is the shorter one."""
    return min(EDITS, length // EDIT_CHARS)


def line_node(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


def segments(length: int, edits: int = EDITS) -> list[tuple[int, int]]:
    """(start, size) of the edits + 1 even segments; the last ones are longer by one."""
    k, rest = divmod(length, edits + 1)
    out, at = [], 0
    for i in range(edits + 1):
        size = k + (i >= edits + 1 - rest)
        out.append((at, size))
        at += size
    return out


def probes(length: int, edits: int = EDITS) -> list[tuple[int, int, int, int]]:
    """(l, i, start, size): the substrings of a line of `length` that can be segment i of one of length l <= length.

    If the left part holds at most i edits, and the right part at most edits - i,
    segment i starts within these windows. Those with l = length at offset 0 are
    the line's own segments.
    """
    out = []
    for l in range(max(edits + 1, length - edits), length + 1):
        more = length - l
        for i, (at, size) in enumerate(segments(l, edits)):
            lo = max(0, at - i, at + more - (edits - i))
            hi = min(length - size, at + i, at + more + (edits - i))
            out += [(l, i, start, size) for start in range(lo, hi + 1)]
    return out


def line_probes(length: int) -> list[tuple[int, int, int, int]]:
    """The probes of a line: each shorter length has the segments of the edits that it allows."""
    return [x for e in range(1, EDITS + 1) for x in probes(length, e) if edits_of(x[0]) == e]


def within(a: str, b: str, edits: int = EDITS) -> bool:
    """Whether the edit distance of a and b is at most `edits`, by a banded bit-parallel recurrence.

    Equal ends are cut off first. Then a word for each number of edits e holds, in
    one bit for each of the 2 * edits + 1 diagonals of the band, whether the
    prefixes that end there are within e edits.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    lo, n = 0, min(len(a), len(b))
    step = 1 << max(n.bit_length() - 1, 0)
    while step:  # longest common prefix by halving
        if lo + step <= n and a[lo : lo + step] == b[lo : lo + step]:
            lo += step
        step >>= 1
    a, b = a[lo:], b[lo:]
    hi, n = 0, min(len(a), len(b))
    step = 1 << max(n.bit_length() - 1, 0)
    while step:
        if hi + step <= n and a[len(a) - hi - step : len(a) - hi] == b[len(b) - hi - step : len(b) - hi]:
            hi += step
        step >>= 1
    a, b = a[: len(a) - hi], b[: len(b) - hi]
    if not a or not b:
        return max(len(a), len(b)) <= edits
    # Row i of the band: bit j of words[e] says that a[:i] and b[:i + j - edits] are within e edits.
    width = 2 * edits + 1
    full = (1 << width) - 1

    def valid(i):  # diagonals whose column lies in b
        low, high = max(0, edits - i), min(width - 1, len(b) - i + edits)
        return ((1 << (high + 1)) - 1) & ~((1 << low) - 1) & full if high >= low else 0

    words = [((1 << (edits + e + 1)) - 1) & ~((1 << edits) - 1) & valid(0) for e in range(edits + 1)]
    for i, ch in enumerate(a, 1):
        same, first = 0, i - edits - 1  # column of diagonal 0 is i - edits; its character is the one before
        for j in range(max(0, -first), min(width, len(b) - first)):
            if b[first + j] == ch:
                same |= 1 << j
        ok, new = valid(i), []
        for e in range(edits + 1):
            w = words[e] & same  # a match keeps the diagonal
            if e:
                w |= words[e - 1] | (words[e - 1] >> 1)  # replace; delete from a: the diagonal above moves down
                w |= new[e - 1] << 1  # insert from b
            new.append(w & ok)
        words = new
        if not words[edits]:
            return False
    end = len(b) - len(a) + edits
    return bool(words[edits] >> end & 1)


def occurrences(batches):
    """(doc_id, of_text, line_no, node) of every compared line."""
    for batch in batches:
        ids, of, no, node = [], [], [], []
        for doc, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "of_text", "text")), strict=True):
            for i, line in enumerate((text or "").split("\n")):
                if compared(line):
                    ids.append(doc)
                    of.append(key)
                    no.append(i)
                    node.append(line_node(line))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(of, pa.int64()), pa.array(no, pa.int32()), pa.array(node, pa.int64())],
                                         names=["doc_id", "of_text", "line_no", "node"])


def segment_entries(batches):
    """(key, node, n, pos) of every line that allows edits and is new to this task; pos is the place of the key in line_probes(n)."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])
    seen, plans = set(), {}
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            keys, nodes, sizes, counts, places = [], [], [], [], []
            for text in batch.slice(start, 512).column("text").to_pylist():
                for line in (text or "").split("\n"):
                    if not (edits_of(len(line)) and compared(line)):
                        continue
                    node = line_node(line)
                    if node in seen:
                        continue
                    if len(seen) >= SEEN_LINES:
                        seen.clear()
                    seen.add(node)
                    n = len(line)
                    plan = plans.get(n)
                    if plan is None:
                        if len(plans) > 20_000:
                            plans.clear()
                        plan = plans[n] = [(l * (EDITS + 1) + i, s, s + size) for l, i, s, size in line_probes(n)]
                    if line.isascii():  # a code point is a byte
                        raw = line.encode()
                        keys += [digest(raw[s:t], p) for p, s, t in plan]
                    else:
                        keys += [digest(line[s:t].encode("utf-8", "surrogatepass"), p) for p, s, t in plan]
                    nodes.append(node)
                    sizes.append(n)
                    counts.append(len(plan))
                    places.append(np.arange(len(plan), dtype=np.int32))
            # the digests less 2**63, as signed numbers
            signed = (np.array(keys, np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(signed), pa.array(np.repeat(np.array(nodes, np.int64), counts)), pa.array(np.repeat(np.array(sizes, np.int32), counts)),
                pa.array(np.concatenate(places) if places else np.empty(0, np.int32))], schema=schema)


def candidate_lines(batches):
    """(node, line) of every compared line."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            lines = [x for t in batch.slice(start, 512).column("text").to_pylist() for x in (t or "").split("\n") if compared(x)]
            yield pa.RecordBatch.from_arrays([pa.array(map(line_node, lines), pa.int64()), pa.array(lines, pa.string())], names=["node", "line"])


def true_pairs(batches):
    for batch in batches:
        ok = [within(x, y, edits_of(min(len(x), len(y)))) for x, y in zip(batch.column("la").to_pylist(), batch.column("lb").to_pylist(), strict=True)]
        mask = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])


def halvings(lx: int, ly: int, edits: int) -> list[tuple[list, list]]:
    """Ways to cut strings x and y, of lx and ly characters and within `edits` of each other, at half.

    A way is ([(start in x, start in y, size) of parts that are equal],
    [(start in x, start in y, size in x, size in y, edits) of parts that are open]);
    at least one of them holds.
    """
    least = min(lx, ly)
    if least <= 1:
        return [([], [(0, 0, lx, ly, edits)])]
    h, g = least // 2, least - least // 2
    out = [([(0, 0, h)], [(h, h, lx - h, ly - h, edits)]), ([(lx - g, ly - g, g)], [(0, 0, lx - g, ly - g, edits)])]
    if edits == 2:  # one in each half; the cut in y is off by that of the first
        for d in (-1, 0, 1):
            if 0 <= h + d <= ly and abs(ly - lx - d) <= 1:
                for c1, o1 in halvings(h, h + d, 1):
                    for c2, o2 in halvings(lx - h, ly - h - d, 1):
                        out.append((c1 + [(x + h, y + h + d, z) for x, y, z in c2], o1 + [(x + h, y + h + d, *z) for x, y, *z in o2]))
    return out


@lru_cache(maxsize=4096)
def ways(opens: tuple[tuple[int, int, int], ...]) -> list[tuple[list, list]]:
    """halvings of several open parts (size in x, size in y, edits) at once; parts are numbered in the places."""
    out = [([], [])]
    for k, part in enumerate(opens):
        out = [(c + [(k, *x) for x in c2], o + [(k, *x) for x in o2]) for c, o in out for c2, o2 in halvings(*part)]
    return out


def refined(line: str, key: int, states: list[list[int]], found: dict) -> None:
    """The keys and states that follow from states of a line under a key are added to found.

    A state holds the part that the line plays (0: x, 1: y), then for each open part
    its start in the line, both sizes and the edits.
    """
    for role, *flat in states:
        parts = [flat[i : i + 4] for i in range(0, len(flat), 4)]
        for i, (closed, opened) in enumerate(ways(tuple((lx, ly, e) for _, lx, ly, e in parts))):
            new = xxhash.xxh3_64_intdigest(i.to_bytes(4, "little"), key)
            for k, x, y, size in closed:
                start = parts[k][0] + (y if role else x)
                new = xxhash.xxh3_64_intdigest(line[start : start + size].encode("utf-8", "surrogatepass"), new)
            state = [role]
            for k, x, y, lx, ly, e in opened:
                state += [parts[k][0] + (y if role else x), lx, ly, e]
            at = found.setdefault(new, [])
            if state not in at:
                at.append(state)


def first_states(n: int) -> list[tuple[int, list[int]]]:
    """(key, state) of a line of n characters, as the shorter and as the longer one of a pair."""
    out = []
    for lx in range(max(1, n - EDITS), n + 1):
        e = edits_of(lx)
        if e >= n - lx and e:
            out.append((lx * (EDITS + 1) + n - lx, [1, 0, lx, n, e]))
    e = edits_of(n)
    return out + [(n * (EDITS + 1) + d, [0, 0, n, n + d, e]) for d in range(e + 1) if e]


#: Halvings at a time, after the first.
HALVINGS = 2


def refined_entries(batches):
    """Entries (key, node, n, pos, open) under finer keys; pos is -1 if nothing is left to halve.

    Rows: node, line, and key and open (the states under the key), both null the first time.
    """
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("open", pa.list_(pa.list_(pa.int32())))])
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            keys, nodes, sizes, places, states = [], [], [], [], []
            for x in batch.slice(start, 64).to_pylist():
                line = x["line"]
                if x["open"] is None:
                    found = {}
                    for key, state in first_states(len(line)):
                        found.setdefault(key, []).append(state)
                else:
                    found = {x["key"] + (1 << 63): x["open"]}
                for _ in range(1 if x["open"] is None else HALVINGS):
                    before, found = found, {}
                    for key, at in before.items():
                        refined(line, key, at, found)
                keys += [k - (1 << 63) for k in found]
                nodes += [x["node"]] * len(found)
                sizes += [len(line)] * len(found)
                # all states of a key have open parts of the same sizes
                places += [-1 if all(min(at[0][i], at[0][i + 1]) <= 1 for i in range(2, len(at[0]), 4)) else 0 for at in found.values()]
                states += found.values()
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(places, pa.int32()),
                                              pa.array(states, schema.field("open").type)], schema=schema)


def line_classes(docs: DataFrame, where: DataFrame) -> DataFrame:
    """(node, component) of the lines alike to another line.

    docs: doc_id, text; where: (node, doc_id), a document of each line.
    """
    entries = docs.select("text").mapInArrow(segment_entries, "key long, node long, n int, pos int")
    entries = written(shared_entries(entries), "entries")
    # the lines with a key in common with another are written once
    of = written(where.join(entries.select("node").distinct(), "node"), "asked")
    lines = semi(docs, of.select("doc_id"), "doc_id").select("text").mapInArrow(candidate_lines, "node long, line string")
    lines = written(lines.join(of.select("node"), "node", "left_semi").dropDuplicates(["node"]), "lines")
    drop_scratch(of)

    def verify(pairs: DataFrame, rows: int) -> DataFrame:
        both = pairs.select("a", "b").join(lines.toDF("a", "la"), "a").join(lines.toDF("b", "lb"), "b")
        return written(in_tasks(both, rows).mapInArrow(true_pairs, "a long, b long"), "links")

    def refine(entries: DataFrame) -> DataFrame:
        if "open" not in entries.columns:
            entries = entries.select("node").distinct().select(F.lit(None).cast("long").alias("key"), "node", F.lit(None).cast("array<array<int>>").alias("open"))
        return entries.join(lines, "node").select("node", "key", "open", "line").mapInArrow(refined_entries, "key long, node long, n int, pos int, open array<array<int>>")

    near = F.abs(F.col("na") - F.col("nb")) <= EDITS
    labels = link(entries, verify, near, near, refine)
    drop_scratch(lines)
    return labels


LAST_ID = 2**63 - 1


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, of_text, lines): the (line_no, node) of each document that are not the first of their class.

    of_text: a hash of the text, so that rows that share an id, or have none, are not one group.
    """
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.xxhash64("text").alias("of_text"), "text")
    at = written(rows.mapInArrow(occurrences, "doc_id long, of_text long, line_no int, node long"), "line-places")
    place = F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("d"), "line_no")
    nodes = written(at.groupBy("node").agg(F.min(place).alias("first"), F.max(place).alias("last")), "line-nodes")
    labels = line_classes(docs, nodes.select("node", F.expr(f"nullif(first.d, {LAST_ID})").alias("doc_id")))
    n = nodes.join(labels, "node", "left")
    low = n.where("component is not null").groupBy("component").agg(F.min("first").alias("low"))
    n = n.join(low, "component", "left").withColumn("low", F.coalesce("low", "first"))
    # only lines that occur elsewhere than at the first place of their class
    again = n.where("first <> low or last <> low").select("node", "low")
    gone = at.join(again, "node").where(place != F.col("low"))
    gone = written(gone.groupBy("doc_id", "of_text").agg(F.collect_set(F.struct("line_no", "node")).alias("lines")), "line-drops")
    for t in (at, nodes, labels):
        drop_scratch(t)
    return gone


def with_dropped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with _drops: the dropped lines of the row's document, or null. All columns and rows are kept."""
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    drops = dropped_lines(d).toDF("_drop_id", "_drop_text", "_drops")
    same = docs[doc_id].cast("long").eqNullSafe(drops["_drop_id"]) & (F.xxhash64(docs[text].cast("string")) == drops["_drop_text"])
    return docs.join(drops, same, "left").drop("_drop_id", "_drop_text")


def left_lines(text: str | None, drops) -> list[str]:
    """The lines of a text without those at (line_no, node) of drops."""
    lines = (text or "").split("\n")
    if not drops:
        return lines
    gone = {(x["line_no"], x["node"]) for x in drops}
    return [x for i, x in enumerate(lines) if not compared(x) or (i, line_node(x)) not in gone]


def line_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped (long) and kept_sha256 (of the kept lines joined by newlines), one row per row.

    A null text counts as empty; an empty text has one empty line. Empty and blank
    lines are never dropped. Rows that repeat an id are one document: a line at the first place of
    its class stays in each of them. Documents without an id come last. Other
    columns are not read.
    """
    def run(batches):
        for batch in batches:
            ids, n, gone, sha = batch.column("doc_id"), [], [], []
            for t, drops in zip(batch.column("text").to_pylist(), batch.column("_drops").to_pylist(), strict=True):
                kept = left_lines(t, drops)
                n.append((t or "").count("\n") + 1)
                gone.append(n[-1] - len(kept))
                sha.append(hashlib.sha256("\n".join(kept).encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
                                             names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return with_dropped(d).mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with the dropped lines taken out of the text; rows of which no line is left go.

    All columns are kept; n_chars, if there, is set to the new length. A row with
    nothing dropped is as it was.
    """
    rows = with_dropped(docs, doc_id, text)
    schema = rows.drop("_drops").schema

    def run(batches):
        for batch in batches:
            out, keep, sizes = [], [], []
            for t, drops in zip(batch.column(text).to_pylist(), batch.column("_drops").to_pylist(), strict=True):
                kept = left_lines(t, drops) if drops else None
                out.append(t if kept is None else "\n".join(kept))
                keep.append(kept is None or bool("".join(kept).strip()))
            cols = [pa.array(out, pa.string()) if f == text else batch.column(f) for f in schema.names]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names).filter(pa.array(keep, pa.bool_()))

    done = rows.mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col(text).isNotNull(), F.char_length(text).cast(schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return done
