"""Tool calls linked, ordered, validated and written, on small logs with every odd case."""

import json

from presslake.llm.tool_links import Parameter, link_tool_calls, order_calls

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, needs array<string>, json string, v int"
RESULTS = "conv_id long, turn long, call_id string, content string, answer string"
SCHEMAS = {
    "find": [Parameter("q", "string"), Parameter("n", "integer", False, 1, 10), Parameter("mode", "string", False, choices=("a", "b"))],
    "sum": [Parameter("xs", "array"), Parameter("deep", "object", False), Parameter("flag", "boolean", False), Parameter("w", "number", False)],
}


def linked(spark, calls, results):
    made = spark.createDataFrame([(*c, "j", 1) for c in calls], CALLS)
    answers = spark.createDataFrame([(*r, "x") for r in results], RESULTS)
    return sorted(link_tool_calls(made, answers, SCHEMAS).collect(), key=repr)


def test_every_case(spark):
    calls = [
        (1, 0, "a", "find", '{"q": "é\\n\\"x\\"", "n": 3}', None), (1, 2, "b", "find", '{"n": 30, "mode": "c", "z": 1, "y": 2}', ["a", "gone"]),
        (1, 4, "c", "sum", '{"xs": [1, {"b": 1, "a": [null]}], "deep": {"z": {"y": 1, "x": 2}, "a": 1.5}, "flag": true, "w": 2}', ["b", "a"]),
        (1, 5, "twin", "find", '{"q": ""}', []), (1, 6, "twin", "find", '{"q": ""}', []),
        (2, 0, "a", "other", "not json", ["r2"]), (2, 1, "r1", "find", '{"q": 5}', ["r2"]), (2, 1, "r2", "find", "[1]", ["r1"]),
        (None, 0, None, None, None, None), (None, 0, "k", "find", '{"q": null}', ["k0"]), (None, 1, "k0", "find", '{"q": "x"}', [None]),
    ]
    results = [
        (1, 1, "a", "found é"), (1, 3, "a", "later"), (1, 1, "b", "early"), (1, 9, "none", "lost"), (2, 2, None, "lost too"), (None, 2, "k", None),
    ]
    rows = linked(spark, calls, results)
    assert len(rows) == len(calls) + 3
    by = {(r.conv_id, r.call_id): r for r in rows if r.status != "repeated"}
    assert [by[1, i].level for i in "abc"] == [0, 1, 2] and by[None, "k"].level == 1 and by[2, "r1"].level is None
    a = by[1, "a"]
    assert a.valid and a.status == "linked" and a.result_turn == 1
    assert a.json == json.dumps(
        {"arguments": {"n": 3, "q": 'é\n"x"'}, "id": "a", "name": "find", "result": "found é", "type": "function"},
        ensure_ascii=False, separators=(",", ":"), sort_keys=True,
    )
    assert by[1, "b"].faults == ["q: missing", "n: too large", "mode: not a choice", "result before its call"] or \
        set(by[1, "b"].faults) == {"unknown arguments y z", "q: missing", "n: too large", "mode: not a choice", "result before its call"}
    assert by[1, "c"].valid and by[1, "c"].status == "unanswered"
    assert json.loads(by[1, "c"].json)["arguments"]["xs"] == [1, {"a": [None], "b": 1}] and '"x":2,"y":1' in by[1, "c"].json
    assert all(r.faults == ["repeated identifier"] for r in rows if r.call_id == "twin")
    assert set(by[2, "a"].faults) == {"not a JSON object", "unknown tool", "ring of needs"}
    assert "ring of needs" in by[2, "r1"].faults and "q: not string" in by[2, "r1"].faults and "not a JSON object" in by[2, "r2"].faults
    assert "no identifier" in by[None, None].faults and by[None, "k"].status == "linked" and "q: missing" in by[None, "k"].faults
    assert [(r.call_id, r.result_turn, r.faults) for r in rows if r.status == "repeated"] == [("a", 3, ["repeated result"])]
    lone = [r for r in rows if r.status == "orphan"]
    assert sorted((r.call_id or "", r.result_turn) for r in lone) == [("", 2), ("none", 9)]
    assert all(json.loads(r.json)["type"] == "result" and not r.valid for r in lone)


def test_levels_by_doubling_are_those_of_the_rounds(spark):
    chain = [(1, i, f"c{i}", "find", "{}", [f"c{i - 1}"]) for i in range(40)] + [(2, 0, "a", "x", "{}", ["b"]), (2, 1, "b", "x", "{}", ["a"]), (2, 2, "d", "x", "{}", ["b"])]
    one = spark.createDataFrame([(*c, "j", 1) for c in [*chain, (None, 0, "k", "x", "{}", None), (None, 1, "l", "x", "{}", ["k"])]], CALLS)
    two = one.unionByName(spark.createDataFrame([(9, 2, "z", "x", "{}", ["y", "w"], "j", 1), (9, 1, "y", "x", "{}", ["w"], "j", 1), (9, 0, "w", "x", "{}", [], "j", 1)], CALLS))
    doubled = {(r.conv_id, r.call_id): r.level for r in order_calls(one).collect()}
    rounds = {(r.conv_id, r.call_id): r.level for r in order_calls(two).collect()}
    assert doubled[1, "c39"] == 39 and doubled[2, "d"] is None and doubled[None, "l"] == 1
    assert {k: v for k, v in rounds.items() if k[0] != 9} == doubled and [rounds[9, i] for i in "wyz"] == [0, 1, 2]


def test_empty_tables_and_long_texts(spark):
    assert linked(spark, [], []) == []
    assert [r.status for r in linked(spark, [], [(1, 1, "a", "x")])] == ["orphan"]
    long_text = json.dumps({"q": "y" * 300_000})
    row = linked(spark, [(1, 0, "a", "find", long_text, None)], [(1, 1, "a", "z" * 300_000)])[0]
    assert row.valid and len(row.json) > 600_000


def test_no_result_is_lost(spark):
    results = [(1, 1, "a", "part two"), (1, 1, "a", "part one"), (1, 1, "a", "part one"), (1, None, "b", None), (1, None, "b", None), (1, 2, "gone", "x"), (1, 2, "gone", "x")]
    rows = linked(spark, [(1, 0, "a", "find", '{"q": "x"}', None), (1, 0, "b", "find", '{"q": "x"}', None)], results)
    assert sorted((r.status, r.call_id, json.loads(r.json).get("result")) for r in rows if r.call_id != "b") == [
        ("linked", "a", "part one"), ("orphan", "gone", "x"), ("orphan", "gone", "x"), ("repeated", "a", "part one"), ("repeated", "a", "part two")]
    assert sorted(r.status for r in rows if r.call_id == "b") == ["linked", "repeated"]
