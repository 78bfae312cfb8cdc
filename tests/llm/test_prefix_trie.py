"""Operator 12 against plain Python and its SQL: deep, hot, odd and empty tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from offblock.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, key string, path0 string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c - 100 * int(c / 100))
        built[c] = tuple(own.get(base, [])[:h] + mine[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in kids
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    return Counter((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items())


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", "p") for r in rows], SCHEMA).repartition(5)


def found(spark, rows):
    return Counter(tuple(r[c] for c in COLUMNS) for r in T.prefix_trie(table(spark, rows)).collect())


@pytest.fixture(scope="module")
def rows():
    r = random.Random(1)
    out = []
    words = ["hi", "yes", "no", "é🙂", "", None]
    for c in range(0, 260):
        out += [(c, t, r.choice(["user", "assistant", None]), r.choice(words)) for t in range(r.choice([0, 1, 2, 5, 7, 9]))]
    out += [(300, None, "user", "x"), (300, None, "user", "x"), (300, 1, "user", "x"), (300, 1, "a", "x"), (None, 0, "user", "lost"),
            (-5, 0, "user", "neg"), (-205, 1, "user", "neg"), (-200, 0, "u", "base"), (777, 0, "user", "t" * 40000)]
    copies = [("user", "same"), ("assistant", "answer"), ("user", "more")]
    for c in range(1000, 1400):  # a third of the conversations say the same
        out += [(c, t, *x) for t, x in enumerate(copies)]
    return out


def test_against_brute_force(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_several_levels_and_blocks(spark, monkeypatch):
    """Small bands and blocks: conversations of 90 turns need five levels and many blocks."""
    monkeypatch.setattr(T, "BAND", 3)
    monkeypatch.setattr(T, "BLOCK", 4)
    r = random.Random(2)
    rows = []
    for c in range(40):
        kind = r.randrange(3)
        rows += [(c, t, "user", str(t % 7 if kind else r.randrange(3))) for t in range(r.choice([1, 4, 26, 27, 28, 90]))]
    assert found(spark, rows) == brute(rows)


def test_one_conversation_in_several_partitions(spark):
    rows = [(100, t, "user", str(t)) for t in range(5000)] + [(c, 0, "user", "x") for c in (99, 101, 250)]
    got = T.numbered(table(spark, rows).selectExpr("conv_id AS conv", "turn", "role", "text AS tie", "turn AS x", "turn AS y", "turn AS len"))
    assert Counter((r.conv, r.pos, r.x) for r in got.collect()) == Counter((c, t + 1, t) for c, t, _, _ in rows)
    assert {r.conv: r.n for r in got.groupBy("conv").count().withColumnRenamed("count", "n").collect()}[100] == 5000


def test_empty_and_turnless(spark):
    assert found(spark, []) == Counter()
    assert found(spark, [(None, 0, "user", "x")]) == Counter()
    lone = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(lone, 0, "user", "gone")]  # no base, and all turns are before the fifth
    assert found(spark, rows) == brute(rows) == Counter({(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest()): 1})


def test_sql(spark, rows, tmp_path):
    table(spark, rows).write.parquet(f"{tmp_path}/c")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    sql = con.execute(T.OP12_SQL)
    names = [d[0] for d in sql.description]
    assert Counter(tuple(dict(zip(names, r, strict=True))[c] for c in COLUMNS) for r in sql.fetchall()) == brute(rows)
