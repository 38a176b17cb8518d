import json

import pytest

from kpiwatch.llm import chat
from kpiwatch.llm.chat import Field

SCHEMAS = {"add": (Field("a", "long", 0, 9), Field("b", "double"), Field("note", "string", 1, 5, required=False)), "flag": (Field("on", "boolean"),)}
CALLS = "conv_id long, call_id string, turn long, name string, arguments string, after string, level int"
RESULTS = "conv_id long, call_id string, turn long, content string, status string"


def linked(spark, calls, results=()):
    c = spark.createDataFrame([(*r, 0) for r in calls], CALLS)
    r = spark.createDataFrame([(*x, "s") for x in results], RESULTS)
    return chat.link(c, r, SCHEMAS).collect()


@pytest.mark.parametrize(
    "name, arguments, fault",
    [
        ("add", '{"b":1.5,"a":3}', None),
        ("add", '{"a":3}', "missing b"),
        ("add", '{"a":"x","b":1}', "type of a"),
        ("add", '{"a":1.5,"b":1}', "type of a"),
        ("add", '{"a":10,"b":1}', "range of a"),
        ("add", '{"a":1,"b":1,"note":"too long"}', "range of note"),
        ("add", '{"a":1,"b":1,"z":2}', "unknown z"),
        ("flag", '{"on":true}', None),
        ("flag", '{"on":1}', "type of on"),
        ("none", "{}", "unknown tool"),
        ("add", "{a", "not an object"),
        ("add", None, "not an object"),
        (None, "{}", "unknown tool"),
    ],
)
def test_arguments_are_validated(spark, name, arguments, fault):
    (row,) = linked(spark, [(1, "x", 0, name, arguments, None)], [(1, "x", 1, "ok")])
    assert row.fault == fault and row.status == ("ok" if fault is None else "invalid")
    assert (row.json is None) == (fault is not None)


def test_canonical_json_is_sorted_and_escaped(spark):
    rows = linked(spark, [(1, 'i"d', 0, "add", '{"note":"é\\"","b":2,"a":1}', None)], [(1, 'i"d', 1, 'line\n"q" \\ é')])
    assert json.loads(rows[0].json) == {"arguments": {"a": 1, "b": 2.0, "note": 'é"'}, "id": 'i"d', "level": 0, "name": "add", "result": 'line\n"q" \\ é'}
    assert list(json.loads(rows[0].json)) == ["arguments", "id", "level", "name", "result"] and " " not in rows[0].json.replace(' \\\\ é', "").replace('\\"q\\" ', "")


def test_levels_follow_long_chains_and_find_cycles(spark):
    ok = '{"on":true}'
    calls = [(1, f"c{i}", i, "flag", ok, f"c{i - 1}" if i else None) for i in range(37)]
    calls += [(2, "a", 0, "flag", ok, "b"), (2, "b", 1, "flag", ok, "a"), (2, "d", 2, "flag", ok, "b"), (2, "e", 3, "flag", ok, "gone")]
    got = {(r.conv_id, r.call_id): (r.level, r.status) for r in linked(spark, calls, [(1, f"c{i}", i, "r") for i in range(37)])}
    assert [got[1, f"c{i}"] for i in range(37)] == [(i, "ok") for i in range(37)]
    assert got[2, "a"] == got[2, "b"] == got[2, "d"] == (None, "cycle")
    assert got[2, "e"] == (0, "no result")


def test_links_need_both_keys_and_take_the_earliest_result(spark):
    ok = '{"on":true}'
    rows = linked(spark, [(1, "x", 0, "flag", ok, None), (None, "x", 0, "flag", ok, None), (1, None, 3, "flag", ok, None), (1, "x", 0, "flag", ok, None)], [(1, "x", 5, "late"), (1, "x", 2, "b"), (1, "x", 2, "a"), (3, "x", 1, "lone"), (1, None, 1, "null id")])
    assert sorted((r.conv_id or 0, r.call_id or "", r.status) for r in rows) == [(0, "x", "no result"), (1, "", "no call"), (1, "", "no result"), (1, "x", "ok"), (1, "x", "ok"), (3, "x", "no call")]
    assert {json.loads(r.json)["result"] for r in rows if r.json} == {"a"}


def test_empty_tables(spark):
    assert linked(spark, []) == []
    calls, results = chat.calls_of(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert chat.link(calls, results, chat.REPLY).collect() == []


def test_conversations_against_plain_python(spark, small_dir):
    from kpiwatch.llm.queries import op1_tool_call_linking

    df = op1_tool_call_linking(spark, small_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    rows = spark.read.parquet(f"{small_dir}/conversations.parquet").collect()
    users = {(r.conv_id, r.turn): r.text for r in rows if r.role == "user"}
    replies = {(r.conv_id, r.turn): r.text for r in rows if r.role == "assistant"}
    want = {}
    for (c, t), text in users.items():
        level = 0
        while (c, t - 2 * (level + 1)) in users:
            level += 1
        n = len([w for w in text.replace("\n", " ").split(" ") if w])
        name = "short_reply" if n <= 20 else "long_reply"
        if n == 0 or n > 200:
            want[c, f"c{c}t{t}"] = ("invalid", level, None)
        elif (c, t + 1) not in replies:
            want[c, f"c{c}t{t}"] = ("no result", level, None)
        else:
            want[c, f"c{c}t{t}"] = ("ok", level, {"arguments": {"text": text, "turn": t, "words": n}, "id": f"c{c}t{t}", "level": level, "name": name, "result": replies[c, t + 1]})
    for c, t in replies:
        if (c, t - 1) not in users:
            want[c, f"c{c}t{t - 1}"] = ("no call", None, None)
    got = {(r.conv_id, r.call_id): (r.status, r.level, r.json and json.loads(r.json)) for r in df.collect()}
    assert got == want
