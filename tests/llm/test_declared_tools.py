"""Tools that conversations declare themselves, through the registered query."""

import json

from sparkloom.llm import chat_format as C


def test_calls_are_checked_against_the_tools_of_their_conversation(spark, tmp_path):
    number = {"type": "object", "properties": {"n": {"type": "integer"}}, "required": ["n"]}
    call = lambda name, arguments: json.dumps({"tool_calls": [{"id": "x", "name": name, "arguments": arguments}]})
    rows = [
        (1, 0, "system", json.dumps({"tools": [{"name": "add", "parameters": number}, {"function": {"name": "go", "parameters": {"type": "object"}}}, {"name": "odd", "parameters": [1]}]})),
        (1, 1, "assistant", call("add", {"n": 3})),
        (1, 2, "assistant", call("add", {"n": "three"})),
        (1, 3, "assistant", call("go", {"far": True})),
        (1, 4, "assistant", call("odd", {})),
        (1, 5, "system", json.dumps({"tools": [{"name": "add", "parameters": {"required": ["never"]}}]})),
        (2, 0, "system", '{"tools": "none"}'),
        (2, 1, "assistant", call("add", {"n": 3})),
        (2, 2, "user", None),
        (3, 0, "system", json.dumps({"tools": [{"name": "free"}]})),
        (3, 1, "assistant", call("free", {"any": 1})),
        (None, 0, "assistant", call("add", {"n": 3})),
    ]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = C.query(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert {(r.conv_id, r.turn): r.n_valid for r in got if r.n_calls} == {(1, 1): 1, (1, 2): 0, (1, 3): 1, (1, 4): 0, (2, 1): 0, (3, 1): 1, (None, 0): 0}
