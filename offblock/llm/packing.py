"""Operator 10, best-fit packing into sequences of several permitted lengths.

Documents (words and one end mark) are packed largest first. A document goes to
the open bin with the least room that holds it; if none does, the permitted
length with the least cost for each token it can still be filled with is opened.
At the end each bin is cut down to the shortest permitted length that holds it.

Documents longer than the longest bin are cut into full bins and a rest, so no
token is lost. Pieces are dealt to shards of about SHARD_PIECES at random, each
packed by itself; only ids and lengths are shuffled. Equal rows are numbered, so
shards and bins do not depend on how docs is partitioned.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offblock.llm.common import written
from offblock.operators.identity import numbered_copies

LENGTHS = (512, 1024, 2048, 4096)
SHARD_PIECES = 4096


def cost(length: int) -> float:
    """Cost of a sequence: a fixed part, its tokens, and the square of them for attention."""
    return 64 + length + length * length / 65536


def best_fit(sizes: list[int], lengths: tuple[int, ...] = LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each size, and the final length of each bin. Sizes are at most the longest length.

    Open bins are kept in stacks by their room; an integer's bits say which rooms have one.
    """
    left = sum(sizes)
    stacks: dict[int, list[int]] = {}
    rooms, used = 0, []
    where, offset = [0] * len(sizes), [0] * len(sizes)
    full: list[int] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                rooms &= ~(1 << room)
        else:
            room = min((c for c in lengths if c >= size), key=lambda c: (cost(c) / min(c, left), c))
            b = len(used)
            used.append(0)
            full.append(room)
        where[i], offset[i] = b, used[b]
        used[b] += size
        left -= size
        if room > size:
            stacks.setdefault(room - size, []).append(b)
            rooms |= 1 << (room - size)
    return where, offset, [min((c for c in lengths if c >= u), key=cost) for u in used]


def pieces(docs: DataFrame, doc_id: str, text: str, longest: int) -> DataFrame:
    """(row, doc_id, piece, start, n_tokens): whole documents, or cuts of at most `longest` tokens.

    row: the number of a row among those of equal id and length.
    """
    words = F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    d = numbered_copies(docs.select(F.col(doc_id).cast("long").alias("doc_id"), (words + 1).cast("long").alias("_n")), "row")
    cuts = F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / longest).cast("int"))
    p = d.select("row", "doc_id", "_n", F.explode(cuts).alias("piece"))
    start = F.col("piece").cast("long") * longest
    return p.select("row", "doc_id", "piece", start.alias("start"), F.least(F.col("_n") - start, F.lit(longest).cast("long")).alias("n_tokens"))


PACKED = "doc_id long, piece int, start long, n_tokens long, bin_id long, bin_offset long, bin_length long, bin_used long"


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """One row for each piece of each row of docs, with its bin, its place in it, and the bin's length and contents.

    Null, empty and blank texts are one end mark. Repeated rows and ids are packed
    each for itself. Ties in size go by doc_id (missing first) and piece. The rows
    are the same on any partitioning of docs. Other columns are not read.
    """
    p = written(pieces(docs, doc_id, text, max(lengths)), "pieces")
    shards = max(1, -(-p.count() // SHARD_PIECES))
    p = p.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "n_tokens", "row"), F.lit(shards)))

    def pack(key, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "piece", "n_tokens", "row"], na_position="first", ignore_index=True)
        where, offset, final = best_fit(part["n_tokens"].tolist(), lengths)
        b = pd.Series(where, dtype="int64")
        used = part["n_tokens"].groupby(b.to_numpy()).sum()
        return pd.DataFrame({
            "doc_id": part["doc_id"].astype("Int64"), "piece": part["piece"], "start": part["start"], "n_tokens": part["n_tokens"],
            "bin_id": b + (int(key[0]) << 32), "bin_offset": offset, "bin_length": [final[x] for x in where], "bin_used": used.loc[where].to_numpy()})

    return p.groupBy("shard").applyInPandas(pack, PACKED)
