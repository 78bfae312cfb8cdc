"""Every row of conversations has its place in op4's result."""

import json

from offblock.llm import tool_calls


def test_every_row_of_every_role(spark):
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 3, "user", "c"), (2, 0, None, "no role"), (2, 1, "tool", None),
            (2, 2, "assistant", "no call"), (None, 0, "system", "x"), (None, 0, "user", "q"), (None, 1, "assistant", "r"), (None, 0, "user", "q"), (3, None, None, None),
            (4, 0, "user", "twice"), (4, 0, "user", "twice"), (4, 1, "assistant", "one"), (4, 1, "assistant", "two")]
    got = tool_calls.op4_tool_calls(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)).collect()
    said = [(r.conv_id, r.turn, json.loads(r.json)) for r in got if r.status == "message"]
    want = [(i, t, {"role": role, "status": "message", "content": text}) for i, t, role, text in rows if role not in ("user", "assistant")]
    assert sorted(map(str, ((i, t, sorted(x.items())) for i, t, x in said))) == sorted(map(str, ((i, t, sorted(x.items())) for i, t, x in want)))
    assert all(r.call_id is None and r.depth is None and not r.valid for r in got if r.status == "message")
    # a linked call stands for its result, too
    assert len(got) + sum(r.status == "linked" for r in got) == len(rows)


def test_no_row_of_the_table_is_lost(spark, sf):
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    got = {r.status: r["count"] for r in tool_calls.op4_tool_calls(table).groupBy("status").count().collect()}
    assert got.get("message", 0) == table.where("role is null or role not in ('user', 'assistant')").count() > 0
    assert sum(got.values()) + got.get("linked", 0) == table.count()
