"""Tree learners against plain brute force: growth rules, penalties, missing values, forests, blocks of trees."""

import itertools
import math
import tracemalloc

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from offblock.ml import explain as E
from offblock.ml import histogram as H
from offblock.ml.features import FeatureSpec

P = H.TreeParams


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(3)
    n = 600
    x = np.column_stack([r.integers(0, 8, n), r.integers(0, 3, n), np.round(r.normal(size=n), 1), r.integers(0, 2, n)]).astype(float)
    x[r.random(n) < 0.15, 0] = np.nan
    x[r.random(n) < 0.3, 2] = np.nan
    y = np.where(np.isnan(x[:, 0]), 9.0, x[:, 0]) * 2 + 5 * (x[:, 1] == 1) * (np.nan_to_num(x[:, 2]) > 0) + np.round(r.normal(size=n), 2)
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(i, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "id long, x array<double>, y double").repartition(parts)
    return df.select("id", array_to_vector("x").alias("features"), "y")


def goes_left(x, c, t, missing_left):
    return np.where(np.isnan(x[:, c]), missing_left, x[:, c] <= t)


def best(x, g, p, rows):
    """(gain, column, threshold, missing left) of the best split of some rows, by trying all."""
    def s(k):
        t = max(abs(g[k].sum()) - p.alpha, 0.0)
        return t * t / (len(k) + p.lam) if len(k) + p.lam > 0 else 0.0

    out = None
    for c in range(x.shape[1]):
        v = x[:, c]
        cuts = [*np.unique(v[~np.isnan(v)])[:-1], math.inf]
        for ml in (False, True):
            if ml and not np.isnan(v[rows]).any():
                continue
            for t in cuts:
                at = goes_left(x[rows], c, t, ml)
                a, b = rows[at], rows[~at]
                if min(len(a), len(b)) < max(1, p.child_rows, p.child_weight) or len(rows) < p.split_rows:
                    continue
                gain = 0.5 * (s(a) + s(b) - s(rows)) - p.gamma
                if gain > 1e-6 and (out is None or gain > out[0] + 1e-9):
                    out = (gain, c, t, ml)
    return out


def leaf(g, k, p):
    t = np.sign(g[k].sum()) * max(abs(g[k].sum()) - p.alpha, 0.0)
    return -t / (len(k) + p.lam) if len(k) else 0.0


def grown(x, g, p):
    """Predictions of one tree by the plain rules, and the number of its leaves."""
    every = np.arange(len(x))
    if p.growth == "leaf":
        leaves = [(every, 0)]
        while len(leaves) < p.leaves:
            options = [(b[0], -i, b) for i, (k, d) in enumerate(leaves) if d < p.depth and (b := best(x, g, p, k))]
            if not options:
                break
            _, i, (_, c, t, ml) = max(options, key=lambda o: o[0])
            k, d = leaves.pop(-i)
            at = goes_left(x[k], c, t, ml)
            leaves += [(k[at], d + 1), (k[~at], d + 1)]
        groups = [k for k, _ in leaves]
    elif p.growth == "symmetric":
        groups = [every]
        for _ in range(p.depth):
            found = None
            for c in range(x.shape[1]):
                v = x[:, c]
                for ml, t in itertools.product((False, True), [*np.unique(v[~np.isnan(v)])[:-1], math.inf]):
                    if ml and not np.isnan(v).any():
                        continue
                    parts = [(k[goes_left(x[k], c, t, ml)], k[~goes_left(x[k], c, t, ml)], k) for k in groups]
                    s = lambda k: g[k].sum() ** 2 / (len(k) + p.lam) if len(k) + p.lam > 0 else 0.0
                    gain = 0.5 * sum(s(a) + s(b) - s(k) for a, b, k in parts)
                    if gain > 1e-6 and (found is None or gain > found[0] + 1e-9):
                        found = (gain, parts)
            if found is None:
                break
            groups = [k for a, b, _ in found[1] for k in (a, b)]
    else:
        groups, todo = [], [(every, 0)]
        while todo:
            k, d = todo.pop()
            b = best(x, g, p, k) if d < p.depth else None
            if b is None:
                groups.append(k)
            else:
                at = goes_left(x[k], *b[1:])
                todo += [(k[at], d + 1), (k[~at], d + 1)]
    out = np.zeros(len(x))
    for k in groups:
        out[k] = leaf(g, k, p)
    return out, len(groups)


RULES = {
    "depth": P(rounds=3, depth=3, rate=0.5),
    "penalties": P(rounds=3, depth=3, rate=0.5, alpha=4.0, lam=2.0, gamma=30.0, child_weight=12),
    "leaf": P(growth="leaf", rounds=3, depth=6, leaves=7, rate=0.5, child_rows=15, lam=1.0),
    "symmetric": P(growth="symmetric", rounds=3, depth=3, rate=0.5, lam=3.0),
}


def test_boosting_equals_brute_force(spark, data):
    x, y = data
    models = H.fit_many(frame(spark, x, y), "y", list(RULES.values()))
    shapes = set()
    for name, p, m in zip(RULES, RULES.values(), models, strict=True):
        f = np.full(len(y), y.mean())
        for t in m.trees:
            want, n_leaves = grown(x, f - y, p)
            got = t["value"][H.walk(t, x)]
            assert np.allclose(got, p.rate * want, atol=1e-6), name
            used = np.unique(H.walk(t, x))
            assert len(used) <= n_leaves
            f = f + p.rate * want
        shapes.add(tuple(len(t["col"]) for t in m.trees) + (round(float(f.sum() + f @ f), 6),))
    assert len(shapes) == len(RULES)  # all different


def test_leafwise_goes_deeper_than_a_balanced_tree(spark):
    x = (np.arange(160.0) % 16)[:, None]
    y = 4.0 ** x[:, 0]
    m = H.fit_many(frame(spark, x, y), "y", [P(growth="leaf", rounds=1, depth=20, leaves=8, rate=1.0)])[0]
    t = m.trees[0]
    depth = {0: 0}
    for v in range(len(t["col"])):
        for c in (t["left"][v], t["right"][v]):
            if c >= 0:
                depth[int(c)] = depth[v] + 1
    assert (t["left"] < 0).sum() == 8 and max(depth.values()) > 3


def test_symmetric_levels_share_their_split(spark, data):
    x, y = data
    t = H.fit_many(frame(spark, x, y), "y", [P(growth="symmetric", rounds=1, depth=3)])[0].trees[0]
    level = {0: [0]}
    for d in range(3):
        assert len({(int(t["col"][v]), float(t["threshold"][v])) for v in level[d]}) == 1
        level[d + 1] = [int(c) for v in level[d] for c in (t["left"][v], t["right"][v])]
    assert len(level[3]) == 8


def test_every_setting_changes_the_fit(spark, data):
    x, y = data
    variants = {"depth": [{}, {"rows": 0.6}, {"columns": 0.5}, {"alpha": 5.0}, {"lam": 9.0}, {"gamma": 50.0}, {"child_weight": 60}, {"rate": 0.4}, {"depth": 2}, {"bins": 2}],
                "symmetric": [{}, {"temperature": 1.0}, {"strength": 9.0}, {"lam": 9.0}, {"bins": 2}],
                "leaf": [{}, {"leaves": 4}, {"child_rows": 90}]}
    params = [P(growth=g, **{"rounds": 2, "depth": 3, "rate": 0.5, **v}) for g, vs in variants.items() for v in vs]
    models = H.fit_many(frame(spark, x, y), "y", params)
    seen = {}
    for p, m in zip(params, models, strict=True):
        f = sum(t["value"][H.walk(t, x)] for t in m.trees)
        key = (p.growth, round(float(f @ f), 9))
        assert key not in seen, (p, seen[key])
        seen[key] = p


def test_models_do_not_depend_on_the_partitioning(spark, data, monkeypatch):
    x, y = data
    params = [P(rounds=7, depth=3, rows=0.7), P(growth="symmetric", rounds=7, depth=3, temperature=0.7, strength=1.0),
              P(forest=True, bootstrap=True, rounds=4, depth=6, node_columns="sqrt")]
    first = H.fit_many(frame(spark, x, y, 1), "y", params)
    monkeypatch.setattr(H, "BLOCK_ROWS", 50)
    monkeypatch.setattr(H, "HIST_BYTES", 20_000)  # many passes
    second = H.fit_many(frame(spark, x, y, 6), "y", params)
    for a, b in zip(first, second, strict=True):
        assert len(a.trees) == len(b.trees)
        for s, t in zip(a.trees, b.trees, strict=True):
            assert all(np.array_equal(s[k], t[k], equal_nan=True) for k in s)


def test_small_nodes_take_one_pass_a_level(spark, data, monkeypatch):
    x, y = data
    df = frame(spark, x, y)
    params = [P(forest=True, bootstrap=True, rounds=2, depth=5, node_columns="sqrt")]
    passes, run = [], H._pass
    monkeypatch.setattr(H, "_pass", lambda *a: (passes.append(1), run(*a)))
    monkeypatch.setattr(H, "HIST_BYTES", 4_000)  # one node of sums
    few = H.fit_many(df, "y", params)
    assert len(passes) <= 2 + 5
    monkeypatch.setattr(H, "SMALL_ROWS", 0)
    monkeypatch.setattr(H, "HIST_BYTES", 1 << 22)
    sums = H.fit_many(df, "y", params)
    for a, b in zip(few, sums, strict=True):
        for s, t in zip(a.trees, b.trees, strict=True):
            assert all(np.array_equal(s[c], t[c], equal_nan=True) for c in s)


def test_rows_of_symmetric_trees_end_where_the_links_lead():
    t = H.Tree()
    t.add(0, 0.0, 1.0)
    for v, (col, code, left) in enumerate([(0, 1, True), (1, 0, False), (1, 0, False)]):
        t.col[v], t.code[v], t.missing_left[v] = col, code, left
        t.left[v], t.right[v] = t.add(t.depth[v] + 1, 0.0, 1.0), t.add(t.depth[v] + 1, 0.0, 1.0)
    codes = np.array([[0, 1, 2, 3] * 3, [0] * 4 + [1] * 4 + [2] * 4], np.uint8)
    missing = np.array([3, 2])
    assert np.array_equal(H.place(t.arrays(), codes, missing, True), H.place(t.arrays(), codes, missing))


def test_missing_values_learn_a_side(spark, data):
    x, y = data
    m = H.fit_many(frame(spark, x, y), "y", [P(rounds=20, depth=4, rate=0.3)])[0]
    filled = np.where(np.isnan(x), -1e15, x)
    with_flags = np.column_stack([filled, np.isnan(x[:, 0]), np.isnan(x[:, 2])])
    n = H.fit_many(frame(spark, with_flags, y), "y", [P(rounds=20, depth=4, rate=0.3)])[0]
    assert H.squared_errors([m], frame(spark, x, y), "y")[0] <= H.squared_errors([n], frame(spark, with_flags, y), "y")[0] * 1.02
    # missing only at prediction: to the larger child, so defined
    odd = x.copy()
    odd[:, 3] = np.nan
    scores = m.transform(frame(spark, odd, y)).select("prediction").toPandas()["prediction"]
    assert np.isfinite(scores).all()


def test_forest_stops_small_nodes_and_averages(spark, data):
    x, y = data
    p = P(forest=True, bootstrap=False, rounds=2, depth=30, split_rows=40, child_rows=8)
    m = H.fit_many(frame(spark, x, y), "y", [p])[0]
    want, _ = grown(x, -y, p)
    got = sum(t["value"][H.walk(t, x)] for t in m.trees)
    assert np.allclose(got, want, atol=1e-6)
    drawn = H.fit_many(frame(spark, x, y), "y", [P(forest=True, bootstrap=True, rounds=3, depth=30, split_rows=40, child_rows=8, node_columns="sqrt")])[0]
    key = np.arange(5000, dtype=np.int64) * 7919
    counts = H.draw(P(bootstrap=True), 0, key)
    assert abs(counts.mean() - 1) < 0.05 and abs(counts.var() - 1) < 0.1
    for t in drawn.trees:
        inner = t["left"] >= 0
        assert (t["cover"][t["left"][inner]] >= 1).all() and len({tuple(t["col"]) for t in drawn.trees}) > 1


def test_save_load_and_blocks_of_trees(spark, data, tmp_path, monkeypatch):
    x, y = data
    df = frame(spark, x, y)
    m = H.fit_many(df, "y", [P(rounds=6, depth=3, rate=0.4)])[0]
    m.save(spark, str(tmp_path / "m"))
    again = H.HistogramModel.load(spark, str(tmp_path / "m"))
    plain = m.base + sum(t["value"][H.walk(t, x)] for t in m.trees)
    by_id = lambda d: d.orderBy("id").toPandas()
    assert np.allclose(by_id(again.transform(df))["prediction"], plain, atol=1e-12)
    spec = FeatureSpec("y", ["a", "b", "c", "d"], ["a", "b", "c", "d"], ["a", "b", "c", "d"], for_trees=True, native=True)
    whole = by_id(E.explain_trees(spark, m, m.transform(df), spec, ["id", "prediction"]))
    monkeypatch.setattr(H, "BLOCK_NODES", 20)
    monkeypatch.setattr(E, "BLOCK_LEAVES", 10)
    assert len(m.blocks()) > 2 and len(E.leaf_blocks(m)) > 2
    assert np.allclose(by_id(m.transform(df))["prediction"], plain, atol=1e-12)
    parts = by_id(E.explain_trees(spark, m, m.transform(df), spec, ["id", "prediction"]))
    cols = [E.attribution_column(c) for c in "abcd"]
    assert np.allclose(parts[cols], whole[cols], atol=1e-9)
    assert np.allclose(parts[cols].sum(axis=1) + parts["base_value"], plain, atol=1e-9)


def test_a_hundred_thousand_leaves(spark):
    """Attributions of a large ensemble add up to its predictions, block by block."""
    r = np.random.default_rng(1)
    depth, n_trees, p = 9, 200, 12
    n = (1 << depth) - 1
    inner = np.concatenate([np.arange(n), np.zeros(1 << depth, int)])
    left = np.concatenate([2 * np.arange(n) + 1, np.full(1 << depth, -1)]).astype(np.int32)
    cover = np.concatenate([2.0 ** (depth - np.floor(np.log2(np.arange(n) + 1))), np.ones(1 << depth)])
    m = H.HistogramModel(base=1.0)
    for _ in range(n_trees):
        m.trees.append({"col": np.where(left >= 0, r.integers(0, p, len(inner)), -1).astype(np.int32), "threshold": r.normal(size=len(inner)),
                        "missing_left": r.random(len(inner)) < 0.5, "left": left, "right": np.where(left >= 0, left + 1, -1).astype(np.int32),
                        "value": r.normal(size=len(inner)), "cover": cover, "gain": np.zeros(len(inner))})
    assert sum(int((t["left"] < 0).sum()) for t in m.trees) > 100_000 and len(E.leaf_blocks(m)) == 3
    x = r.normal(size=(6, p))
    x[0, :4] = np.nan
    names = [f"f{i}" for i in range(p)]
    spec = FeatureSpec("y", names, names, names, for_trees=True, native=True)
    got = E.explain_trees(spark, m, m.transform(frame(spark, x, np.zeros(6))), spec, ["id", "prediction"]).toPandas()
    total = got[[E.attribution_column(c) for c in names]].sum(axis=1) + got["base_value"]
    assert np.allclose(total, got["prediction"], atol=1e-8)


def test_odd_tables(spark):
    one = frame(spark, np.array([[1.0, np.nan]]), np.array([5.0]))
    assert H.fit_many(one, "y", [P(rounds=2)])[0].transform(one).first()["prediction"] == pytest.approx(5.0)
    same = frame(spark, np.ones((20, 2)), np.arange(20.0))
    for growth in ("depth", "leaf", "symmetric"):
        m = H.fit_many(same, "y", [P(growth=growth, rounds=2)])[0]
        assert m.transform(same).first()["prediction"] == pytest.approx(9.5) and all(len(t["col"]) == 1 for t in m.trees)
    with pytest.raises(ValueError):
        H.fit_many(same.where("y is null"), "y", [P()])
    some = same.selectExpr("id", "features", "CASE WHEN id > 3 THEN NULL ELSE y END AS y")
    assert H.fit_many(some, "y", [P(rounds=1)])[0].base == pytest.approx(1.5)


@pytest.mark.parametrize("alpha,lam,least", [(0.0, 0.0, 1), (0.7, 2.0, 3)])
def test_small_nodes_from_their_rows_alone(alpha, lam, least):
    """pick_by_rows finds what pick finds from the sums of all bins, ties, missing values and drawn inputs included."""
    rng = np.random.default_rng(5)
    layout = H.Layout([np.arange(b, dtype=float) for b in (0, 1, 6, 40)])
    missing, total = layout.sizes - 1, layout.total
    for drawn in ("all", "sqrt"):
        p = H.TreeParams(node_columns=drawn, alpha=alpha, lam=lam, child_rows=least, gamma=0.1 * least, split_rows=2 * least)
        size = rng.integers(1, 14, 300)
        of = np.repeat(np.arange(300), size)
        codes = np.stack([rng.integers(0, s, len(of)) for s in layout.sizes]).astype(np.uint8)
        codes[2, of % 3 == 0] = np.maximum(codes[2, of % 3 == 0], 1)
        codes[:, of % 7 == 0] = missing[:, None]
        g, h = rng.integers(-3, 4, len(of)).astype(float), rng.integers(1, 3, len(of)).astype(float)
        sums, allowed = np.zeros((3, 300, total)), np.ones((300, len(layout.col)), bool)
        for c in range(4):
            for x, s in zip((g, h, np.ones(len(of))), sums, strict=True):
                np.add.at(s, (of, layout.starts[c] + codes[c]), x)
        cols = H.node_inputs(p, 4, 0, range(300))
        if cols is None:
            cols = np.tile(np.arange(4), (300, 1))
        for v in range(300):
            allowed[v] = np.isin(layout.col, cols[v])
        got = H.pick_by_rows(of, g, h, codes[cols[of].T, np.arange(len(of))], cols, layout, p)
        split = 0
        for v, x in enumerate(H.pick(*sums, layout, p, allowed)):
            row = tuple(got[k][v] for k in ("gain", "col", "code", "missing_left", "gl", "hl", "nl"))
            want = (0.0, -1, -1, False, 0.0, 0.0, 0.0) if x is None else (x[0], layout.col[x[1]], layout.code[x[1]], x[2], *x[3])
            assert row == want, (drawn, v)
            split += x is not None
        assert split > 50


def test_blocks_are_read_one_at_a_time():
    import pyarrow as pa

    size, blocks = 1 << 20, 32
    batch = pa.RecordBatch.from_arrays([pa.array([size] * blocks, pa.int32()), pa.array([bytes([k]) * size for k in range(blocks)], pa.binary())],
                                       names=["n", "codes"])
    before, most = pa.total_allocated_bytes(), 0
    tracemalloc.start()
    for k, (n, codes) in enumerate(H.blocks_of(batch, "codes")):
        assert n == size and np.frombuffer(codes, np.uint8)[-1] == k
        most = max(most, tracemalloc.get_traced_memory()[1] + pa.total_allocated_bytes() - before)
        del codes
    tracemalloc.stop()
    assert most < 4 * size
