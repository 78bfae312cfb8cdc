"""Operator 1, document fingerprints: SimHash on word shingles, built-in functions only.

A term is a run of five consecutive words (lower-cased; blanks separate words;
a text of fewer words is one term). The 64-bit hash of each term votes +1 or -1
on each bit, once for each occurrence, so a term weighs as often as it occurs;
the fingerprint holds the bits with a positive sum. Texts without a word have
fingerprint 0. Likeness is the share of equal bits.

``near_counts`` finds fingerprints within a Hamming radius by permuted block
tables: 64 bits in six blocks; two fingerprints that differ in at most three
bits agree on some three blocks, so each of the 20 choices of three blocks is a
table, joined on the chosen blocks (about 32 bits).
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offblock.llm.common import BLANKS, partitions, written

SHINGLE = 5
RADIUS = 3
BLOCKS = 6
#: Id ranges for each shuffle partition; more even out the partitions.
RANGES_PER_PARTITION = 8
#: Bits of a lane of packed votes, and so a quarter of its range in terms of a run.
LANE_BITS = 16


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased words; an empty array for a null or blank text."""
    t = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(BLANKS))
    w = F.transform(F.split(t, "[\\x20\\x09-\\x0D]+"), lambda x: F.xxhash64(x))
    return F.when(t == "", F.array().cast("array<long>")).otherwise(w)


def with_terms(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys and _t: hashes of all runs of SHINGLE (five) words of the text.

    Built from the words' hashes: pairs, pairs of pairs, one word more; each step
    is a column of its own, so that none is computed twice.
    """
    def mixed(c: Column, d: Column, skip: int) -> Column:  # the last `skip` have no partner, and are cut off below
        return F.zip_with(c, F.slice(d, F.lit(skip + 1), F.size(d)), lambda x, y: F.xxhash64(x, y))

    d = df.select(*keys, word_hashes(F.col(text)).alias("_w"))
    d = d.select(*keys, "_w", mixed(F.col("_w"), F.col("_w"), 1).alias("_2"))
    d = d.select(*keys, "_w", mixed(F.col("_2"), F.col("_2"), 2).alias("_4"))
    n = F.size("_w")
    five = F.slice(mixed(F.col("_4"), F.col("_w"), SHINGLE - 1), F.lit(1), F.greatest(n - (SHINGLE - 1), F.lit(0)))
    return d.select(*keys, F.when(n == 0, F.col("_w")).when(n < SHINGLE, F.array(F.xxhash64("_w"))).otherwise(five).alias("_t"))


def fingerprints(df: DataFrame, keys: list[str], text: str, name: str = "fp") -> DataFrame:
    """keys and the 64-bit fingerprint of each row's text; keys must tell rows apart.

    Sixteen longs hold the 64 bit counts of up to 2**14 terms, four 16-bit
    lanes each: lane k of sum i counts bit i + 16k. They are unpacked and summed
    over a document's runs of terms. The sums are built where the terms are made,
    so little is shuffled, and nothing is if df is dealt out by a key.
    """
    h = with_terms(df, keys, text).select(*keys, F.posexplode_outer("_t").alias("_p", "_h"))
    lanes = F.lit(0x0001000100010001)
    h = h.withColumn("_p", F.shiftright("_p", LANE_BITS - 2))
    runs = h.groupBy(*keys, "_p").agg(F.count("_h").alias("_n"), *[
        F.sum(F.shiftrightunsigned("_h", i).bitwiseAND(lanes)).alias(f"_s{i}") for i in range(16)])
    # lanes of two's complement: the sums stay below 2**63, as a lane stays below 2**15
    bits = [F.sum(F.shiftrightunsigned(f"_s{b % 16}", 16 * (b // 16)).bitwiseAND(F.lit(0xFFFF))).alias(f"_b{b}") for b in range(64)]
    votes = runs.groupBy(*keys).agg(F.sum("_n").alias("_n"), *bits)
    fp = F.lit(0).cast("long")
    for i in range(64):
        bit = -(1 << 63) if i == 63 else 1 << i
        fp = fp.bitwiseOR(F.when(2 * F.col(f"_b{i}") > F.col("_n"), F.lit(bit)).otherwise(F.lit(0)).cast("long"))
    return votes.select(*keys, fp.alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Share of the 64 bits on which two fingerprints agree."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def with_next(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (bucket, rn, ghost, doc_id, text, next_text) with the next row's text by (doc_id, text).

    Ids are cut at quantiles into ranges, one window partition each; the first
    rows of a range are copied ("ghost") behind the range before it, and those of
    the first behind the last. Texts are shuffled once. Only the bounds and the
    first id of each range, as many as there are ranges, reach the driver.
    Missing ids come before all others; a lone document is its own next.
    """
    spark = df.sparkSession
    d = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ids = d.select("doc_id")
    n = 1
    while n < RANGES_PER_PARTITION * partitions(spark):
        n *= 2
    cuts = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 8 * n)).first()[0] or []
    top = 2**63 - 1
    bounds = F.array(*[F.lit(x).cast("long") for x in (sorted(cuts) + [top] * n)[: n - 1]]) if n > 1 else F.array(F.lit(top))
    steps = [n >> i for i in range(1, n.bit_length())]

    def bucket(c: Column) -> Column:
        return F.aggregate(
            F.array(*map(F.lit, steps)), F.lit(0), lambda pos, step: pos + F.when(F.get(bounds, pos + step - 1) <= c, step).otherwise(0))

    first = {r[0]: r[1] for r in ids.groupBy(bucket(F.col("doc_id")).alias("b")).agg(F.min("doc_id")).collect()}
    full = sorted(b for b, x in first.items() if x is not None)
    before = dict(zip(full, full[-1:] + full[:-1], strict=True))
    firsts = F.array(*[F.lit(first.get(b)).cast("long") for b in range(n)])
    ghosts = F.array(*[F.lit(before.get(b)).cast("int") for b in range(n)])
    own = d.withColumn("b", bucket(F.col("doc_id")))
    seat = F.struct(F.col("b").alias("bucket"), F.lit(0).alias("ghost"))
    ghost = F.struct(F.get(ghosts, F.col("b")).alias("bucket"), F.lit(1).alias("ghost"))
    is_first = F.coalesce(F.col("doc_id") == F.get(firsts, F.col("b")), F.lit(False))
    seats = own.select("doc_id", "text", F.explode(F.when(is_first, F.array(seat, ghost)).otherwise(F.array(seat))).alias("s"))
    flat = seats.select("s.bucket", "s.ghost", "doc_id", "text")
    w = Window.partitionBy("bucket").orderBy("ghost", "doc_id", "text")
    return flat.select("*", F.row_number().over(w).alias("rn"), F.coalesce(F.lead("text").over(w), F.col("text")).alias("next_text"))


def simhash_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each whole text and of its edited text, one row per row of df.

    Null texts count as empty; equal texts have equal fingerprints; repeated ids
    are ordered by text; other columns are not read. The edited text has its last
    floor(n/2) code points replaced by the first as many of the next document.
    """
    nxt = with_next(df, doc_id, text)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    both = nxt.select("bucket", "ghost", "rn", "doc_id", n.cast("long").alias("n_chars"), F.posexplode(F.array("text", edited)).alias("kind", "t"))
    keys = ["bucket", "ghost", "rn", "doc_id", "n_chars", "kind", "sha"]
    # a ghost is there for its neighbour only: its edited text is not wanted
    both = both.where("ghost = 0 or kind = 0")
    fps = fingerprints(both.withColumn("sha", F.when(F.col("kind") == 1, F.sha2(F.col("t").cast("binary"), 256))), keys, "t")
    row = fps.groupBy("bucket", "ghost", "rn", "doc_id", "n_chars").agg(
        F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("fp_edited"),
        F.max("sha").alias("edited_sha256"))
    w = Window.partitionBy("bucket").orderBy("rn")
    row = row.withColumn("fp_next", F.coalesce(F.lead("fp").over(w), F.col("fp"))).where("ghost = 0")
    hexed = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    return row.select(
        "doc_id", "n_chars", "edited_sha256", hexed("fp").alias("fingerprint"), hexed("fp_edited").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("fp_edited")).alias("near_edited"), likeness(F.col("fp"), F.col("fp_next")).alias("near_next"),
        F.col("fp").alias("fp"))


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """Signed 64-bit masks, one for each choice of blocks that a pair within the radius may agree on."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    masks = [sum(c) for c in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near_counts(fps: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, n) of queries: the number of rows of fps within the radius, equal ones included.

    fps: (fp, n), distinct fingerprints with their number of rows; queries: (fp),
    distinct. Each pair is taken from the first table that holds it, so no pair is
    counted twice; the distance is checked inside the join, so only true pairs
    leave it.
    """
    masks = block_masks(BLOCKS, radius)
    keys = F.posexplode(F.array(*[F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(m))) for t, m in enumerate(masks)]))
    a = queries.select(F.col("fp").alias("qfp"), keys.alias("t", "k"))
    b = fps.select(F.col("fp"), "n", keys.alias("t2", "k2"))
    x = F.col("qfp").bitwiseXOR(F.col("fp"))
    first = F.coalesce(*[F.when(x.bitwiseAND(F.lit(m)) == 0, F.lit(t)) for t, m in enumerate(masks)], F.lit(-1))
    on = (F.col("k") == F.col("k2")) & (F.bit_count(x) <= radius) & (first == F.col("t")) & (F.col("t2") == F.col("t"))
    return a.join(b, on).groupBy(F.col("qfp").alias("fp")).agg(F.sum("n").alias("n"))


def op1_simhash(docs: DataFrame) -> DataFrame:
    """The contract's columns and n_near: for ids divisible by 20 (the query set), the
    number of other documents within three bits; null for the rest."""
    rows = written(simhash_documents(docs), "simhash")
    fps = rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    asked = F.coalesce(F.col("doc_id") % 20 == 0, F.lit(False))
    near = near_counts(fps, rows.where(asked).select("fp").distinct()).select("fp", (F.col("n") - 1).alias("n_near"))
    return rows.join(near, "fp", "left").withColumn("n_near", F.when(asked, F.col("n_near"))).drop("fp")
