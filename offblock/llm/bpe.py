"""Operator 9, byte-level BPE encoding and decoding with a segment tree.

A text is cut by the pattern; each match is encoded by itself. A segment tree
over its byte positions holds at every node the smallest (rank, position) of the
pairs below, so the root names the leftmost pair of minimum rank. A merge changes
the pair at its position, the pair before it and the one it swallows: three
point updates of logarithmic cost. Matches new to a task are encoded together,
all trees of one size in one array, a merge in each of them at a time; a match
of more than VECTOR_BYTES bytes gets a tree of its own.

No match of the pattern goes on across a space that stands before a non-blank, so
texts are first cut there; a task keeps the ids of the pieces, and the bytes of
their ids, and runs the pattern on pieces that are new to it.

Merges go by the rank of the joined bytes, whichever two tokens make them up.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offblock.llm.common import small_batches

#: Matches of up to so many bytes are encoded many at a time.
VECTOR_BYTES = 64
#: Encoded pieces that a task keeps.
CACHE_PIECES = 500_000
#: A space that is not followed by a non-blank.
ODD_SPACE = re.compile(r" (?!\S)")
CUT = re.compile(r"(?= \S)")
#: Rows encoded together.
ROWS = 256
NONE = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file; read on the driver."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in f if x.strip())}


class Encoder:
    """Ids of matches, by segment trees; keeps those of frequent matches."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.text_of = {str(r): t for t, r in ranks.items()}
        self.text_ids = {r: str(r) for r in ranks.values()}
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.find = regex.compile(pattern).findall
        self.ids_of: dict[str, str] = {}
        self.bytes_of_ids: dict[str, bytes] = {}
        # all pairs of tokens whose joined bytes are a token, sorted for lookup of many pairs at once
        self.base = max(ranks.values()) + 2  # also the id of "no token"
        pairs = [(ranks[t[:i]] * self.base + ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs] + [NONE], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs] + [NONE], np.int64)
        one = self.single
        self.first = self._rank(np.repeat(one, 256), np.tile(one, 256))  # of all pairs of bytes

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.base + right
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def encode_many(self, pieces: list[bytes]) -> list[str]:
        """Decimal ids of the pieces, joined by commas; short ones of a similar length share an array of trees."""
        out: list = [None] * len(pieces)
        groups: dict[int, list[int]] = {2 << k: [] for k in range(VECTOR_BYTES.bit_length())}
        for i, p in enumerate(pieces):
            rank = self.ranks.get(p)
            if rank is not None:
                out[i] = str(rank)  # a match that is a token is that token
            elif len(p) > VECTOR_BYTES:
                out[i] = ",".join(map(str, self.encode_long(p)))
            else:
                groups[1 << (len(p) - 1).bit_length()].append(i)
        for size, members in groups.items():
            # many trees at a time, but no more than stay in a processor's cache
            for at in range(0, len(members), 1 << 12):
                block = members[at : at + (1 << 12)]
                for i, ids in zip(block, self._trees([pieces[i] for i in block], size), strict=True):
                    out[i] = ids
        return out

    def _trees(self, pieces: list[bytes], size: int) -> list[str]:
        """One tree of `size` leaves for each piece; node 1 is the root, leaves start at `size`."""
        n = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        flat = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(n, size)
        none = self.base - 1
        token = np.where(np.arange(size) < lengths[:, None], self.single[flat], none)
        after = np.tile(np.arange(1, size + 1), (n, 1))  # next live position
        before = np.tile(np.arange(-1, size - 1), (n, 1))
        tree = np.full((n, 2 * size), NONE, np.int64)
        places = np.arange(size - 1)
        rank = np.where(places + 1 < lengths[:, None], self.first[flat[:, :-1].astype(np.int64) * 256 + flat[:, 1:]], NONE)
        tree[:, size : 2 * size - 1] = np.where(rank < NONE, rank * size + places, NONE)
        for node in range(size - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])

        # flat views: one index for a piece and a place in it
        nodes, tokens, nexts, priors = tree.ravel(), token.ravel(), after.ravel(), before.ravel()

        def update(roots, place, value):
            at = place + size
            nodes[roots + at] = value
            for _ in range(size.bit_length() - 1):  # up to the root
                at >>= 1
                left = roots + 2 * at
                nodes[roots + at] = np.minimum(nodes[left], nodes[left + 1])

        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            roots, base = rows * (2 * size), rows * size
            best = nodes[roots + 1]
            place, merged = best % size, best // size
            gone = nexts[base + place]
            beyond = nexts[base + gone]
            tokens[base + place] = merged
            tokens[base + gone] = none
            nexts[base + place] = beyond
            inside = beyond < size
            priors[(base + beyond)[inside]] = place[inside]
            right = np.where(inside, tokens[base + np.minimum(beyond, size - 1)], none)
            rank = self._rank(merged, right)
            update(roots, gone, NONE)
            update(roots, place, np.where(rank < NONE, rank * size + place, NONE))
            prior = priors[base + place]
            has = np.flatnonzero(prior >= 0)
            if len(has):
                p = prior[has]
                rank = self._rank(tokens[base[has] + p], merged[has])
                update(roots[has], p, np.where(rank < NONE, rank * size + p, NONE))
            rows = rows[nodes[roots + 1] < NONE]
        live = token != none
        texts, ends = list(map(self.text_ids.__getitem__, token[live].tolist())), np.cumsum(live.sum(1)).tolist()
        return [",".join(texts[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def encode_long(self, piece: bytes) -> list[int]:
        """The same with one tree in a list, for a piece of any length."""
        n = len(piece)
        size = 1 << (n - 1).bit_length()
        text = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [NONE] * (2 * size)
        get = self.ranks.get

        def value(i):
            j = after[i]
            r = get(text[i] + text[j]) if j < n else None
            return NONE if r is None else r * size + i

        def update(i, v):
            i += size
            tree[i] = v
            while i > 1:
                i >>= 1
                v = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == v:
                    return
                tree[i] = v

        for i in range(n - 1):
            tree[size + i] = value(i)
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        while tree[1] < NONE:
            i = tree[1] % size
            j = after[i]
            text[i], text[j] = text[i] + text[j], b""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            update(j, NONE)
            update(i, value(i))
            if before[i] >= 0:
                update(before[i], value(before[i]))
        return [self.ranks[t] for t in text if t]

    def cut(self, text: str | None) -> list[str]:
        """Pieces of a text, cut before each space that stands before a non-blank."""
        if not text:
            return []
        if "\0" in text or ODD_SPACE.search(text):
            return [x for x in CUT.split(text) if x]
        return [x for x in text.replace(" ", "\0 ").split("\0") if x]

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces that are not kept yet, and decode their ids."""
        new = [x for x in pieces if x not in self.ids_of]
        if len(self.ids_of) + len(new) > CACHE_PIECES:
            self.ids_of, self.bytes_of_ids, new = {}, {}, list(pieces)
        # letters alone, or behind one space, are one match
        found = [(x,) if x.isalpha() or (x[0] == " " and x[1:].isalpha()) else self.find(x) for x in new]
        matches = list({m for f in found for m in f})
        ids = dict(zip(matches, self.encode_many([m.encode("utf-8") for m in matches]), strict=True))
        for x, f in zip(new, found, strict=True):
            self.ids_of[x] = joined = ids[f[0]] if len(f) == 1 else ",".join([ids[m] for m in f])
            self.bytes_of_ids[joined] = self.decode(joined)

    def decode(self, ids: str) -> bytes:
        """Bytes of decimal ids joined by commas."""
        return b"".join(map(self.text_of.__getitem__, ids.split(","))) if ids else b""


def encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by commas) and decoded bytes of every row's whole text.

    A null text counts as empty, and has no ids. The ranks are broadcast: a
    vocabulary file, whose size does not depend on the data. Rows, repeated ones
    included, are encoded one by one; other columns are not read.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        coder = Encoder(shared.value, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                cut = [coder.cut(t) for t in part.column("text").to_pylist()]
                coder.learn(set().union(*cut))
                ids = [list(map(coder.ids_of.__getitem__, c)) for c in cut]
                plain = [b"".join(map(coder.bytes_of_ids.__getitem__, i)) for i in ids]
                ids = [",".join(i) for i in ids]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([x.count(",") + 1 if x else 0 for x in ids], pa.int64()),
                    pa.array(ids, pa.string()), pa.array(plain, pa.binary())], names=["doc_id", "n_tokens", "ids", "decoded"])

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, n_tokens long, ids string, decoded binary")


def op9_bpe(docs: DataFrame) -> DataFrame:
    """The contract's digests of the ids and of the decoded bytes."""
    import public_tokenizers as P

    e = encoded(docs, load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    return e.select("doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
