"""Empty tables for operators 4, 5, 6, 7 and 10, and infinite components for operator 5."""

import pytest

from offblock.llm import ego_join, jaccard, line_dedup, packing, tool_calls


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, n_chars long")


def test_documents(no_docs):
    assert line_dedup.line_report(no_docs).collect() == []
    kept = jaccard.keep_one_each(line_dedup.dedup_lines(no_docs))
    assert kept.columns == no_docs.columns and kept.collect() == []
    assert packing.pack_documents(no_docs).collect() == []


def test_conversations(spark):
    assert tool_calls.op4_tool_calls(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).collect() == []


def test_embeddings(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert ego_join.cosine_components(spark.createDataFrame([], schema)).collect() == []
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, inf]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [nan, 1.0]), (5, [0.0, 0.0]), (6, None), (7, [1.0, None])]
    got = ego_join.cosine_components(spark.createDataFrame([(i, v, 0) for i, v in rows], schema)).collect()
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got} == {(i, int(i in (2, 3)), 2 if i == 3 else i, i != 3) for i in range(1, 8)}
