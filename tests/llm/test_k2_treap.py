"""Operator 11 against brute force: the index, the descents, ties, odd and empty tables."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from offblock.llm import k2_treap as K

DOCS = "doc_id long, text string, ids string, item string"
ITEMS = "item_id long, text string, df long"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=10):
    """Sorted (item_id, rank, doc_id, score) rows as strings."""
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 100 - 90 + 90 * sum(b.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 8 * m))
                    for t in set(terms(text)) if t in b)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(map(str, out))


def found(spark, docs, items):
    d = spark.createDataFrame([(*r, "a", "b") for r in docs], DOCS).repartition(3)
    return sorted(str(tuple(r)) for r in K.ranked_search(d, spark.createDataFrame([(*r, 1) for r in items], ITEMS)).collect())


@pytest.fixture(scope="module")
def docs():
    r = random.Random(4)
    words = ["".join(r.choice("abcdeABé日") for _ in range(r.randint(1, 4))) for _ in range(150)]
    pick = lambda n: " ".join(words[min(149, int(r.expovariate(0.04)))] + r.choice(["", "", ",", ".", "'s"]) for _ in range(n))
    out = [(i, pick(r.randint(1, 60))) for i in range(300)]
    out += [(1000 + i, out[7][1]) for i in range(120)]  # ties
    return out + [(None, out[7][1]), (None, None), (2, None), (3, ""), (4, " .,!\x7f\x00 "), (5, pick(6000)), (6, out[6][1]), (6, out[6][1]), (-3, out[7][1]), (7, "İSTANBUL ÉÀ x1y2")]


@pytest.fixture(scope="module")
def items(docs):
    r = random.Random(5)
    out = [(i, r.choice(docs[:300])[1]) for i in range(25)]
    return out + [(None, docs[7][1]), (3, docs[9][1]), (50, None), (51, ""), (52, "zzzz unseen"), (53, "İstanbul éà"), (54, docs[7][1] + " " + docs[8][1])]


def test_against_brute_force(spark, docs, items):
    assert found(spark, docs, items) == brute(docs, items)


def test_many_shards_small_steps_and_blocks(spark, docs, items, monkeypatch):
    monkeypatch.setattr(K, "SHARD_CELLS", 150)
    monkeypatch.setattr(K, "STEP_NODES", 20)
    monkeypatch.setattr(K, "BLOCK_CHARS", 2000)
    assert found(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark, docs, items):
    assert found(spark, [], items) == found(spark, docs, []) == found(spark, [(1, None), (2, "..")], items) == []


@pytest.mark.parametrize("seed", range(6))
def test_treap_holds_the_cells(seed):
    """Every cell is found by descent, every peak is the greatest below."""
    r = np.random.default_rng(seed)
    bits, bands = int(r.integers(1, 6)), int(r.integers(1, 4))
    cells = {(int(r.integers(bands << bits)), int(r.integers(1 << bits))): int(r.integers(1, 99)) for _ in range(int(r.integers(1, 200)))}
    rows, cols = (np.array([k[j] for k in cells], np.int64) for j in (0, 1))
    t = K.build_treap(rows, cols, np.array(list(cells.values())), bits, bands)
    shard = K.Shard({"n_docs": 1 << bits, "ids": np.arange(1 << bits).tobytes(), "known": np.ones(1 << bits, bool).tobytes(), **{k: v.tobytes() for k, v in t.items()}})
    got, below = {}, defaultdict(list)

    def walk(node, depth, row, col):
        if shard.kids[node] == 0:
            cell = int(shard.leaf_row[node]), int(shard.leaf_col[node])
            assert (cell[0] >> (bits - depth), cell[1] >> (bits - depth)) == (row, col)
            got[cell] = int(shard.peaks[node])
            return [got[cell]]
        child = int(shard.first[node])
        for q in range(4):
            if shard.kids[node] >> q & 1:
                below[node] += walk(child, depth + 1, 2 * row + (q >> 1), 2 * col + (q & 1))
                child += 1
        assert max(below[node]) == shard.peaks[node]
        return below[node]

    for band, head in enumerate(shard.heads):
        if head >= 0:
            walk(int(head), 0, band, 0)
    assert got == cells


def test_descent_leaves_most_ranges_out(spark, docs, items, monkeypatch):
    """Best-first: far fewer documents are reached than there are."""
    reached = []
    plain = K.np.argpartition
    d = spark.createDataFrame([(i, t) for i, t in docs], "doc_id long, text string")
    n, total = K.corpus_size(d)
    row = K.build_index(d.coalesce(1), n, total).first().asDict()
    shard = K.Shard(row)
    text = set(terms(docs[5][1]))
    rows = np.array([i for i, t in enumerate(row["terms"]) if t in text], np.int64)
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * row["dfs"][i] + 1))) for i in rows], np.int64)
    monkeypatch.setattr(K, "STEP_NODES", len(rows))
    monkeypatch.setattr(K.np, "argpartition", lambda a, k: reached.append(k) or plain(a, k))
    top = shard.best(rows, weights, [])
    assert len(top) == 10 and top[0][1] == 5
    assert len(reached) < shard.n


def test_sql(spark, docs, items, tmp_path):
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}/*.parquet'")
    assert sorted(map(str, con.execute(K.OP11_SQL).fetchall())) == brute(docs, items)
