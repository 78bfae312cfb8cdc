"""Keys with the same nodes, and pairs that share many keys, in linking."""

import random

from pyspark.sql import functions as F

from offblock.llm import linking
from offblock.llm.common import written

ENTRIES = "key long, node long, n int, pos int"


def components(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in root}


def linked(spark, rows, true, monkeypatch, refine=None):
    """The components that link finds, and the rows that the last join of entries makes."""
    truth = spark.createDataFrame(sorted(true) or [(-1, -2)], "a long, b long").select(F.col("a"), F.col("b"))
    made, pairs = [], linking._pairs

    def spy(df, *rest):
        made.append(df.count())
        return pairs(df, *rest)

    monkeypatch.setattr(linking, "_pairs", spy)
    e = written(linking.shared_entries(spark.createDataFrame(rows, ENTRIES)), "entries")
    found = linking.link(e, lambda p, n: written(p.select("a", "b").join(truth, ["a", "b"], "left_semi"), "links"), refine=refine)
    return {tuple(x) for x in found.collect()}, made[-1]


def test_keys_with_the_same_nodes_make_their_pairs_once(spark, monkeypatch):
    rows = [(key, node, 9, key % 7) for key in range(60) for node in range(1, 21)]
    got, made = linked(spark, rows, {(3, 17), (5, 6)}, monkeypatch)
    assert got == {(3, 3), (17, 3), (5, 5), (6, 5)}
    assert made <= 20 * 19 / 2


def test_pairs_that_share_many_keys_are_made_about_once(spark, monkeypatch):
    # each key holds all of 16 nodes but its own one, so that no two keys have the same nodes
    rows = [(key, node, 9, 0) for key in range(16) for node in range(16) if node != key]
    got, made = linked(spark, rows, {(0, 15)}, monkeypatch)
    assert got == {(0, 0), (15, 0)}
    assert made < 3 * 16 * 15 / 2


def test_links_under_random_keys_equal_brute_force(spark, monkeypatch):
    r = random.Random(4)
    held = {key: r.sample(range(40), r.randint(1, 9)) for key in range(45)}
    held |= {100 + key: held[key] for key in range(0, 45, 3)}  # the same nodes again
    rows = [(key, node, 9, r.choice([-1, 0, 3])) for key, nodes in held.items() for node in nodes]
    both = {(a, b) for nodes in held.values() for a in nodes for b in nodes if a < b}
    true = {x for x in sorted(both) if r.random() < 0.06}
    monkeypatch.setattr(linking, "REFINED_NODES", 4)
    halves = lambda e: e.select((F.col("key") * 1000 + F.col("node") % 2).alias("key"), "node", "n", F.lit(-1).alias("pos")).unionByName(
        e.select((F.col("key") * 1000 + 10).alias("key"), "node", "n", F.lit(-1).alias("pos")))
    assert linked(spark, rows, true, monkeypatch, halves)[0] == components(true)
