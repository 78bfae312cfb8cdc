"""Written and shuffled bytes of the near-dedup join and the search index: no leaf goes through a shuffle, a shard is a row group."""

import numpy as np
import pyarrow.parquet as pq

from offblock.llm import ego_join, k2_treap


def test_leaves_are_not_shuffled(spark, monkeypatch):
    r = np.random.default_rng(4)
    x = r.normal(size=(400, 8))
    x[200:] = x[:200] * 3 + r.normal(size=(200, 8)) * 0.01
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    monkeypatch.setattr(ego_join, "TILE", 16)
    monkeypatch.setattr(ego_join, "LEAF_BYTES", 1)  # 25 leaves or more
    monkeypatch.setattr(ego_join, "ROUND_BYTES", 3)
    plans, compare = [], ego_join.paired

    def paired(pairs, cut, *rest):
        table = type(cut)
        run = table.mapInArrow
        monkeypatch.setattr(table, "mapInArrow", lambda d, *a, **k: (plans.append(d._jdf.queryExecution().executedPlan().toString()), run(d, *a, **k))[1])
        return compare(pairs, cut, *rest)

    monkeypatch.setattr(ego_join, "paired", paired)
    got = {g.vec_id: (g.n_links, g.component_id) for g in ego_join.cosine_components(df).collect()}
    rounds = [p for p in plans if "data_b" in p]
    assert len(rounds) >= 8 and all("Exchange hashpartitioning" not in p and "SortMergeJoin" not in p for p in rounds)
    u = x.astype(np.float32).astype(float)
    u /= np.sqrt((u * u).sum(1, keepdims=True))
    hit = u @ u.T >= ego_join.COSINE
    np.fill_diagonal(hit, False)
    assert [got[i][0] for i in range(400)] == hit.sum(1).tolist()
    least = np.arange(400)
    while True:
        new = np.minimum(least, np.where(hit, least[None, :], 400).min(1))
        if (new == least).all():
            break
        least = new
    assert [got[i][1] for i in range(400)] == least.tolist()


def test_a_shard_is_a_row_group(spark, monkeypatch):
    monkeypatch.setattr(k2_treap, "SHARD_CELLS", 20)
    docs = spark.createDataFrame([(i, f"w{i % 7} w{i % 11} common t{i}") for i in range(200)], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, "w3 common")], "item_id long, text string")
    files, write = [], k2_treap.written
    monkeypatch.setattr(k2_treap, "written", lambda d, name, *a: (t := write(d, name, *a), files.extend(t.inputFiles()) if name == "index" else None)[0])
    assert k2_treap.ranked_search(docs, items).count() == 10
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in files]
    assert sum(m.num_rows for m in groups) >= 30
    assert all(m.row_group(k).num_rows == 1 for m in groups for k in range(m.num_row_groups))
    # the least and greatest values of all row groups would stay with the writer
    assert all(m.row_group(k).column(c).statistics is None for m in groups for k in range(m.num_row_groups) for c in range(m.num_columns))
