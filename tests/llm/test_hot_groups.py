"""Hot groups of lines and near copies, ids that are missing, and odd JSON values."""

import os
import random

import pytest

from offblock.llm import jaccard, language_id, line_dedup, linking, tool_calls
from offblock.session import scratch_path


def written_rows(monkeypatch, module, name):
    """Collects the row counts of the tables written under a name."""
    rows, write = [], linking.written

    def spy(df, what):
        out = write(df, what)
        if what == name:
            rows.append(out.count())
        return out

    monkeypatch.setattr(module, "written", spy)
    return rows


def passage_lines(r, n):
    passage = "".join(r.choice("abcdefgh ") for _ in range(31))
    return [passage + "".join(r.choice("abcdefgh") for _ in range(11)) for _ in range(n)]


def test_common_passage_does_not_make_all_pairs(spark, monkeypatch):
    pairs = {}
    for n in (300, 1200):
        lines = passage_lines(random.Random(n), n)
        df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string").repartition(3)
        with monkeypatch.context() as m:
            rows = written_rows(m, linking, "pairs")
            dropped = {x.doc_id for x in line_dedup.line_report(df).where("n_dropped > 0").collect()}
            pairs[n] = sum(rows)
        root = {}
        for i, a in enumerate(lines[:300] if n == 300 else []):
            root[i] = any(line_dedup.within(a, b, 2) for b in lines[:i])
        if n == 300:
            assert dropped == {i for i, alike in root.items() if alike}
    assert pairs[1200] < 0.2 * 1200 * 1199 / 2 and pairs[1200] < 10 * pairs[300]


@pytest.mark.parametrize("edits", [1, 2])
def test_alike_lines_share_a_key_after_every_halving(edits):
    r = random.Random(edits)
    for _ in range(150):
        a = "".join(r.choice("abc") for _ in range(r.choice([20, 39, 40, 43, 60])))
        b = list(a)
        for _ in range(edits):
            p, k = r.randrange(len(b)), r.randrange(3)
            b[p : p + (k > 0)] = [] if k == 1 else [r.choice("abx")]
        b = "".join(b)
        e = line_dedup.edits_of(min(len(a), len(b)))
        if not e or not line_dedup.within(a, b, e):
            continue
        at = []
        for line in (a, b):
            found = {}
            for key, state in line_dedup.first_states(len(line)):
                found.setdefault(key, []).append(state)
            at.append(found)
        for _ in range(3):
            for i, line in enumerate((a, b)):
                found = {}
                for key, states in at[i].items():
                    line_dedup.refined(line, key, states, found)
                at[i] = found
            assert at[0].keys() & at[1].keys()


def test_components_in_rounds_equal_those_of_one_task(spark, monkeypatch):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)]
    df = spark.createDataFrame(edges, "a long, b long")
    one = {(x.node, x.component) for x in linking.connected_components(df).collect()}
    monkeypatch.setattr(linking, "FEW_EDGES", -1)
    assert one == {(x.node, x.component) for x in linking.connected_components(df).collect()} and one


def test_range_bound_holds_with_counts_cut_off():
    import numpy as np
    import pyarrow as pa

    a = np.arange(0, 100_000, dtype=np.uint64)  # all in one range
    b = a[: 80_000]
    batch = pa.RecordBatch.from_pydict({"a": [1, 1], "b": [2, 3], "na": [len(a)] * 2, "nb": [len(b)] * 2,
                                        "ra": [jaccard.range_counts(a)] * 2, "rb": [jaccard.range_counts(b)] * 2})
    assert next(jaccard.overlap_filter([batch])).num_rows == 2


def test_rows_without_an_id_are_one_a_group(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near = text + " end"
    rows = [(None, text, "x"), (None, text, "x"), (None, "other words here", "y"), (None, "other words here", "y"), (7, near, "z"), (8, "quite unlike that", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(map(tuple, jaccard.keep_one_each(df).collect()), key=str)
    assert got == sorted([(7, near, "z"), (8, "quite unlike that", "z"), (None, "other words here", "y")], key=str)


def test_lines_of_rows_without_an_id(spark):
    df = spark.createDataFrame([(None, "same line here\nown line a"), (None, "same line here\nown line b"), (1, "same line here")], "doc_id long, text string")
    got = sorted(line_dedup.dedup_lines(df).select("text").toPandas().text)
    assert got == ["own line a", "own line b", "same line here"]


def test_language_stage_keeps_clashing_columns(spark, sf):
    from pyspark.sql import functions as F

    d = spark.read.parquet(f"{sf}/documents.parquet").select("*", F.lit("mine").alias("lang_pred"), F.lit(-5.0).alias("score"))
    out = language_id.keep_identified(d)
    assert out.columns == d.columns and [tuple(x) for x in out.select("lang_pred", "score").distinct().collect()] == [("mine", -5.0)]


@pytest.mark.parametrize("text", ["1e999", '"\\ud800"', '{"a": "\\udc00"}', "[" * 100_000 + "]" * 100_000, "NaN", '{"a": 1, "a": 2}', ""])
def test_odd_json_is_refused(text):
    with pytest.raises(ValueError):
        tool_calls.parse(text)


def test_schemas_of_odd_types_and_enums():
    assert tool_calls.faults(1, {"enum": [True]}) and tool_calls.faults(True, {"enum": [1]}) and not tool_calls.faults(1, {"enum": [1.0]})
    assert tool_calls.faults(1, {"type": "decimal"}) == ["$: not decimal"]
    deep, schema = [], {}
    schema["items"] = schema
    for _ in range(5000):
        deep = [deep]
    assert tool_calls.faults(deep, schema) == []
    assert tool_calls.faults({"b": 1, "c": "x"}, {"required": ["a"], "properties": {"c": {"type": "integer"}}, "additionalProperties": False}) == [
        "$.a: missing", "$.b: unknown", "$.c: not integer"]


def test_tables_on_the_way_are_deleted(spark):
    lines = passage_lines(random.Random(1), 80)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    folder = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    held = lambda: {x for x in os.listdir(folder) if x.split("-")[0] in ("entries", "pairs", "mixed", "links", "edges", "rest", "lines")}
    before = held()
    line_dedup.dropped_lines(df).count()
    assert not {x for x in held() - before if any(f.endswith(".parquet") for f in os.listdir(f"{folder}/{x}"))}
