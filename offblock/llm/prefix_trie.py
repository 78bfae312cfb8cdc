"""Operator 12, conversation prefix trie: depth-band rollup.

A node is a distinct sequence of first turns; its key is a polynomial hash of
the turns' hashes (two moduli-61 residues, 122 bits), so the key of a rebuilt
prefix follows from the keys of the original ones by arithmetic.

- Turns are numbered by a range sort: each task numbers its run of rows, and the
  runs of a conversation that spans tasks are shifted by what lies before them.
  Prefix hashes are made for blocks of BLOCK turns and shifted the same way. No
  conversation has to fit one task.
- Levels: level 0 holds every depth; level l + 1 the depths at which a band of
  BAND depths of level l begins. A row carries the keys above it in its band (at
  most BAND - 1), one list for each level that it is on.
- Rollup of a level: every node adds its value to itself and to those keys. What
  the band roots gather is rolled up on the next level, where they are the
  nodes, and the completed totals are added at the node above each band root
  and to the keys above that one. So a node is exploded to less than 2 * BAND
  others, and there are log_BAND(depth) levels.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offblock.llm.common import partitions, written

#: Conversations share the first turns of the one whose id ends in two zeros; so many at most.
SHARE, FIRST = 100, 6
BAND = 16
#: Turns that are hashed in one run; ids that are joined to one text.
BLOCK = 4096
#: Parts of the children of one node when they meet it.
SALTS = 64
P = (1 << 61) - 1
BASES = (0x1F3D5B79A2C4E6F1 % P, 0x0B7E151628AED2A6 % P)

Key = tuple[int, int]


def extend(key: Key, after: Key, n: int) -> Key:
    """The hash of a sequence followed by one of n turns."""
    return tuple((k * pow(b, n, P) + a) % P for k, a, b in zip(key, after, BASES, strict=True))


def without(key: Key, before: Key, n: int) -> Key:
    """The hash of the last n turns of a sequence; before: that of all others."""
    return tuple((k - a * pow(b, n, P)) % P for k, a, b in zip(key, before, BASES, strict=True))


def packed(key: Key) -> bytes:
    return key[0].to_bytes(8, "big") + key[1].to_bytes(8, "big")


def unpacked(key: bytes) -> Key:
    return int.from_bytes(key[:8], "big"), int.from_bytes(key[8:], "big")


ROOT = packed((0, 0))


def numbered(turns: DataFrame) -> DataFrame:
    """(conv, pos, x, y, len): turns (conv, turn, role, tie, x, y, len) numbered from 1 in each conversation.

    Rows are sorted by range, so a conversation may lie in several partitions.
    """
    def run(batches):
        part, conv, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            pos = []
            for c in batch.column("conv").to_pylist():
                conv, n = c, n + 1 if c == conv else 1
                pos.append(n)
            cols = [batch.column(c) for c in ("conv", "x", "y", "len")]
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(pos), pa.int32()), pa.array(pos, pa.int64()), *cols],
                                             names=["part", "pos", "conv", "x", "y", "len"])

    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("role"), F.col("tie")]
    dealt = turns.repartitionByRange(partitions(turns.sparkSession), *order).sortWithinPartitions(*order)
    runs = written(dealt.mapInArrow(run, "part int, pos long, conv long, x long, y long, len long"), "runs")
    sizes = runs.groupBy("conv", "part").agg(F.max("pos").alias("n"))
    several = sizes.groupBy("conv").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1").select("conv")  # two a partition at most
    w = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.join(F.broadcast(several), "conv").select("conv", "part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    return runs.join(F.broadcast(before), ["conv", "part"], "left").select(
        "conv", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "x", "y", "len")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv, pos, len, key): key is the hash of the first pos turns."""
    def run(batches):
        at, key = None, (0, 0)
        for batch in batches:
            keys = []
            for c, b, x, y in zip(*(batch.column(k).to_pylist() for k in ("conv", "block", "x", "y")), strict=True):
                if (c, b) != at:
                    at, key = (c, b), (0, 0)
                key = extend(key, (x % P, y % P), 1)
                keys.append(packed(key))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("conv", "block", "pos", "len")), pa.array(keys, pa.binary())],
                                             names=["conv", "block", "pos", "len", "key"])

    d = turns.withColumn("block", F.floor((F.col("pos") - 1) / BLOCK))
    d = d.repartition(partitions(turns.sparkSession), "conv", "block").sortWithinPartitions("conv", "block", "pos")
    d = written(d.mapInArrow(run, "conv long, block long, pos long, len long, key binary"), "blocks")
    # whole blocks before a block, in order: one row for each BLOCK turns
    ends = d.where(F.col("pos") == (F.col("block") + 1) * BLOCK).select("conv", "block", F.col("key").alias("own"))

    def chain(batches):
        conv, key = None, (0, 0)
        for batch in batches:
            keys = []
            for c, own in zip(batch.column("conv").to_pylist(), batch.column("own").to_pylist(), strict=True):
                key = extend((0, 0) if c != conv else key, unpacked(own), BLOCK)
                conv = c
                keys.append(packed(key))
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), pa.array(keys, pa.binary())], names=["conv", "block", "before"])

    ends = ends.repartition(partitions(turns.sparkSession), "conv").sortWithinPartitions("conv", "block")
    before = ends.mapInArrow(chain, "conv long, block long, before binary").select("conv", (F.col("block") + 1).alias("block"), "before")

    def shift(batches):
        for batch in batches:
            keys = [packed(extend(unpacked(b), unpacked(k), (p - 1) % BLOCK + 1)) for k, b, p in zip(
                *(batch.column(c).to_pylist() for c in ("key", "before", "pos")), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "pos", "len")), pa.array(keys, pa.binary())],
                                             names=["conv", "pos", "len", "key"])

    first = d.where("block = 0").select("conv", "pos", "len", "key")
    later = d.where("block > 0").join(before, ["conv", "block"])
    return first.unionByName(later.select("conv", "pos", "len", "key", "before").mapInArrow(shift, "conv long, pos long, len long, key binary"))


def rebuilt(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, len, key) of the rebuilt turns, by the original prefixes.

    convs: (conv, base, h, n, m): own turns, and how many come from the base.
    """
    early = prefixes.where(F.col("pos") < FIRST).select(F.col("conv").alias("base"), F.col("pos").alias("depth"), "len", "key")
    taken = convs.join(early, "base").where("depth <= m").select("conv", "depth", "len", "key")
    # the hashes of the base's first m and of the conversation's own first h turns
    base = early.select("base", F.col("depth").alias("m"), F.col("key").alias("base_key"))
    own = early.select(F.col("base").alias("conv"), F.col("depth").alias("h"), F.col("key").alias("own_key"))
    heads = convs.where("n > h").join(base, ["base", "m"], "left").join(own, ["conv", "h"], "left").select("conv", "h", "m", "base_key", "own_key")

    def run(batches):
        for batch in batches:
            depth, keys = [], []
            for pos, key, h, m, b, o in zip(*(batch.column(c).to_pylist() for c in ("pos", "key", "h", "m", "base_key", "own_key")), strict=True):
                tail = without(unpacked(key), unpacked(o or ROOT), pos - h)
                keys.append(packed(extend(unpacked(b or ROOT), tail, pos - h)))
                depth.append(m + pos - h)
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(depth, pa.int64()), batch.column("len"), pa.array(keys, pa.binary())],
                                             names=["conv", "depth", "len", "key"])

    rest = prefixes.join(heads, "conv").where("pos > h")
    return taken.unionByName(rest.mapInArrow(run, "conv long, depth long, len long, key binary"))


def with_paths(rows: DataFrame, levels: int) -> DataFrame:
    """rows (conv, depth, key, ...) with a path (keys above in the band) and an up (key above, at a band's root) for each level.

    Both are null where the row's depth is not on the level. A window holds at most BAND rows.
    """
    out = rows
    for level in range(levels):
        step = BAND**level
        on = out.where(F.col("depth") % step == 1) if level else out
        place = F.floor((F.col("depth") - 1) / step)
        on = on.select("conv", "depth", "key", F.floor(place / BAND).alias("band"))
        w = Window.partitionBy("conv", "band").orderBy("depth")
        path = F.collect_list("key").over(w.rowsBetween(Window.unboundedPreceding, -1))
        on = on.select("conv", "depth", path.alias("path"), F.lag("key").over(w).alias("up"), "key")
        above = on.select("conv", (F.col("depth") + step).alias("depth"), F.col("key").alias("above"))
        roots = on.where(F.size("path") == 0).join(above, ["conv", "depth"], "left").select("conv", "depth", "path", F.col("above").alias("up"))
        on = on.where(F.size("path") > 0).select("conv", "depth", "path", "up").unionByName(roots)
        out = out.join(on.toDF("conv", "depth", f"path{level}", f"up{level}"), ["conv", "depth"], "left")
        out = written(out, "paths")
    return out


def rollup(nodes: DataFrame, values: list[str], level: int = 0, levels: int = 1) -> DataFrame:
    """(key, values): for each node of the level the sums over its subtree; nodes: key, path.., up.., values."""
    path, up = f"path{level}", f"up{level}"

    def spread(d: DataFrame) -> DataFrame:
        """The values of (key, path, values) added up at the key and at the keys of its path."""
        return d.select(F.explode(F.array_append(path, F.col("key"))).alias("key"), *values).groupBy("key").agg(*[F.sum(v).alias(v) for v in values])

    sums = spread(nodes)
    if level + 1 == levels:
        return sums
    sums = written(sums, "sums")
    roots = nodes.where(F.size(path) == 0).select("key", up, *[f"{c}{k}" for c in ("path", "up") for k in range(level + 1, levels)])
    total = written(rollup(roots.join(sums, "key"), values, level + 1, levels), "totals")
    # what band roots have in all goes to the node above each, and to those above that one in its band
    below = roots.where(f"{up} is not null").join(total, "key").groupBy(F.col(up).alias("key")).agg(*[F.sum(v).alias(v) for v in values])
    more = spread(nodes.select("key", path).join(below, "key"))
    return sums.unionByName(more).groupBy("key").agg(*[F.sum(v).alias(v) for v in values])


def end_hashes(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the conversations (conv, key) that end at each node.

    SHA-256 reads its text in order, so one task hashes all ids of a node; the ids
    are sorted and joined in blocks first, and the task streams one text a block.
    """
    block = F.floor(F.col("conv") / BLOCK)
    texts = ends.groupBy("key", block.alias("block")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids"))

    def run(batches):
        at, sha = None, None
        for batch in batches:
            keys, digests = [], []
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if key == at:
                    sha.update(b",")
                else:
                    if at is not None:
                        keys.append(at)
                        digests.append(sha.hexdigest())
                    at, sha = key, hashlib.sha256()
                sha.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], names=["key", "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([sha.hexdigest()], pa.string())], names=["key", "ends_sha256"])

    dealt = texts.repartition(partitions(ends.sparkSession), "key").sortWithinPartitions("key", "block")
    return dealt.select("key", "ids").mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row for each node of the trie of rebuilt conversations; see the module.

    Null roles and texts are empty; null turns come first; turns of one number are
    ordered by role, then by the SHA-256 of the text, so repeated rows are turns of
    their own. Rows without a conv_id belong to no conversation. c - c % 100 keeps
    the sign of c. An empty table has no nodes. Other columns are not read.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    d = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), role_.alias("role"),
        F.sha2(text_.cast("binary"), 256).alias("tie"), F.xxhash64(role_, text_).alias("x"), F.xxhash64(F.lit(1), text_, role_).alias("y"),
        F.char_length(text_).cast("long").alias("len"))
    turns = written(numbered(d), "turns")
    counts = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % FIRST).cast("long")
    counts = written(counts.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % SHARE).alias("base")), "counts")
    lent = counts.select(F.col("conv").alias("base"), F.least("n", F.lit(FIRST)).alias("lent"))
    convs = counts.join(lent, "base", "left").withColumn("m", F.least("h", F.coalesce("lent", F.lit(0)))).drop("lent")
    convs = written(convs.withColumn("last", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "convs")

    rows = written(rebuilt(written(prefix_hashes(turns), "prefixes"), convs), "rebuilt")
    deepest = rows.agg(F.max("depth")).first()[0] or 0
    levels = 1
    while BAND**levels < deepest:
        levels += 1
    rows = with_paths(rows, levels)
    last = convs.select("conv", F.col("last").alias("depth"))
    ends = end_hashes(rows.select("conv", "depth", "key").join(last, ["conv", "depth"]).select("conv", "key").unionByName(
        last.where("depth = 0").select("conv", F.lit(ROOT).alias("key"))))

    carried = [f"{c}{k}" for c in ("path", "up") for k in range(levels)]
    nodes = rows.groupBy("key").agg(F.min("conv").alias("conv_id"), F.first("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
                                    F.first("len").alias("len"), *[F.first(c).alias(c) for c in carried])
    nodes = written(nodes, "nodes")
    up = F.coalesce("up0", F.lit(ROOT))
    children = nodes.groupBy(up.alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    values = nodes.select("key", *carried, F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
                          ((F.col("n_convs") - 1) * F.col("len")).alias("saved_tokens"))
    totals = written(rollup(values, ["n_leaves", "saved_tokens"], 0, levels), "totals")

    tops = nodes.where("depth = 1").select("key", "n_children").join(totals, "key").agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    root = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    t = tops.first()
    root = root.select(F.lit(ROOT).alias("key"), "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
                       F.lit(t["n_children"]).cast("long").alias("n_children"), F.lit(t["n_leaves"] or 1).cast("long").alias("n_leaves"),
                       F.lit(t["saved_tokens"] or 0).cast("long").alias("saved_tokens"))

    # children meet their parent in SALTS parts, each of which fetches the parent's id once
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS))
    seats = nodes.select("key", "up0", salt.alias("salt"))
    asked = seats.where("up0 is not null").select("up0", "salt").distinct()
    found = asked.join(nodes.select(F.col("key").alias("up0"), F.col("conv_id").alias("parent_conv_id")), "up0")
    first = F.lit(convs.agg(F.min("conv")).first()[0]).cast("long")
    inner = nodes.withColumn("salt", salt).join(found, ["up0", "salt"], "left").join(totals, "key").select(
        "key", "conv_id", "depth", F.when(F.col("up0").isNull(), first).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens")
    out = inner.unionByName(root).join(ends, "key", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


OP12_SQL = """
WITH own AS (
  SELECT conv_id AS c, COALESCE(role, '') AS r, COALESCE(text, '') AS t,
         ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, COALESCE(role, ''), sha256(COALESCE(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 100 AS base, xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT], flatten(list_transform(string_split(c::VARCHAR, ''),
             lambda d: [ord(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END)) % 6 AS h
  FROM own GROUP BY c),
turns AS (
  SELECT v.c, o.pos, o.r, o.t FROM convs v JOIN own o ON o.c = v.base AND o.pos <= v.h
  UNION ALL SELECT v.c, o.pos, o.r, o.t FROM convs v JOIN own o ON o.c = v.c AND o.pos > v.h),
placed AS (SELECT c, r, t, ROW_NUMBER() OVER (PARTITION BY c ORDER BY pos) AS depth FROM turns),
keyed AS (
  SELECT c, depth, length(t) AS len,
         sha256(string_agg(sha256(length(r) || ':' || r || t), '') OVER (PARTITION BY c ORDER BY depth)) AS k FROM placed
  UNION ALL SELECT c, 0, 0, '' FROM convs),
path AS (SELECT c, depth, len, k, LAG(k) OVER (PARTITION BY c ORDER BY depth) AS up, LEAD(k) OVER (PARTITION BY c ORDER BY depth) IS NULL AS ends FROM keyed),
nodes AS (
  SELECT k, MIN(depth) AS depth, MIN(up) AS up, MIN(c) AS conv_id, COUNT(*) AS n_convs, (COUNT(*) - 1) * MIN(len) AS saved,
         sha256(COALESCE(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM path GROUP BY k),
kids AS (SELECT up AS k, COUNT(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
full_nodes AS (SELECT nodes.*, COALESCE(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)),
sums AS (
  SELECT a.k, SUM(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, SUM(n.saved) AS saved_tokens
  FROM full_nodes n JOIN path a ON a.c = n.conv_id AND a.depth <= n.depth GROUP BY a.k)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s USING (k) LEFT JOIN full_nodes p ON p.k = n.up
"""
