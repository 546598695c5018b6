import json
import random

import pytest
from paceline.llm import tool_calls
from paceline.llm.tool_calls import TURN_TOOLS, calls_of_turns, canonical, formatted, linked_calls, ordered_calls, parsed, violations

SCHEMA = {"type": "object", "required": ["q"], "additionalProperties": False,
          "properties": {"q": {"type": "string", "minLength": 1}, "n": {"type": "integer", "minimum": 1, "maximum": 5},
                         "tags": {"type": "array", "items": {"enum": ["a", "b"]}}}}


@pytest.fixture()
def frames(spark):
    def make(calls, results):
        return (
            spark.createDataFrame([(*c, "x") for c in calls], "conv_id long, turn long, call_id string, tool string, arguments string, content string"),
            spark.createDataFrame([(*r, "x") for r in results], "conv_id long, turn long, call_id string, content string, tool string"),
            spark.createDataFrame([("find", json.dumps(SCHEMA)), (None, "{}")], "tool string, schema string"),
        )

    return make


def test_status_of_each_identifier(frames):
    calls = [
        (1, 0, "a", "find", '{"q": "x", "n": 2.0}'), (1, 2, "b", "find", '{"n":9,"q":"${a}"}'), (1, 4, "c", "none", "{}"),
        (1, 5, "d", "find", "{broken"), (1, 6, "e", "find", '{"q":"late"}'), (1, 9, "f", "find", '{"q":"early"}'),
        (1, 1, "a", "find", '{"q":"second call"}'), (2, 0, "a", "find", '{"q":"other conversation"}'), (None, 0, "a", "find", "{}"),
        (1, 7, "g", "find", '{"q":"x","q":"y"}'), (1, 7, None, "find", "{}"), (1, 8, "h", None, '{"q":"x"}'), (1, 8, "i", "find", None),
    ]
    results = [(1, 1, "a", "one"), (1, 3, "a", "two"), (1, 3, "b", ""), (1, 8, "f", "before"), (1, 9, "lost", None), (2, 1, "a", "mine")]
    got = {(r.conv_id, r.call_id): r for r in linked_calls(*frames(calls, results)).collect()}
    assert len(got) == 11
    assert got[1, "a"].status == "ok" and got[1, "a"].content == "one" and got[1, "a"].arguments == '{"n":2,"q":"x"}'
    assert got[1, "b"].status == "bad arguments: $.n: is out of range" and got[1, "b"].needs == ["a"]
    assert got[1, "c"].status == "unknown tool" and got[1, "h"].status == "unknown tool"
    assert got[1, "d"].status.startswith("bad arguments: not JSON") and got[1, "d"].arguments == "{broken"
    assert "duplicate key" in got[1, "g"].status and got[1, "i"].status.startswith("bad arguments")
    assert got[1, "e"].status == "no result" and got[1, "f"].status == "result before call" and got[1, "lost"].status == "no call"
    assert got[2, "a"].content == "mine"


def test_conversations_are_ordered_and_canonical(frames):
    calls = [(1, 0, "z", "find", '{"q":"${y}"}'), (1, 1, "y", "find", '{"q":"é"}'), (1, 2, "p", "find", '{"q":"${r}"}'), (1, 3, "r", "find", '{"q":"${p}"}')]
    row = formatted(linked_calls(*frames(calls, [(1, 5, "y", "ok")]))).collect()
    assert len(row) == 1 and (row[0].calls, row[0].linked, row[0].cyclic) == (4, 1, 2)
    assert [c["id"] for c in json.loads(row[0].json)] == ["y", "z", "p", "r"]
    assert row[0].json == canonical(json.loads(row[0].json)) and "é" in row[0].json
    assert formatted(linked_calls(*frames([], []))).collect() == []


def test_long_conversations_are_written_in_parts(frames):
    calls = [(1, k, f"c{k}", "find", '{"q":"x"}') for k in range(95)] + [(2, 0, "a", "find", '{"q":"x"}')]
    parts = formatted(linked_calls(*frames(calls, [])), most_rows=20).collect()
    assert sorted((r.conv_id, r.part, r.calls) for r in parts) == [(1, 0, 20), (1, 1, 20), (1, 2, 20), (1, 3, 20), (1, 4, 15), (2, 0, 1)]


def test_turns_become_calls(spark):
    rows = [(1, 0, "system", "be brief", 1), (1, 1, "user", "hi", 1), (1, 2, "assistant", "hello", 1), (1, 3, "user", "", 1), (1, 4, "assistant", None, 1),
            (2, 0, "assistant", "first", 1), (3, 0, None, None, 1), (None, 0, "user", "lost", 1), (1, 1, "user", "hi", 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tool long")
    calls, results = calls_of_turns(turns)
    tools = spark.createDataFrame(TURN_TOOLS, "tool string, schema string")
    got = {(r.conv_id, r.call_id): r for r in linked_calls(calls, results, tools).collect()}
    assert {k: r.status for k, r in got.items()} == {
        (1, "t0"): "no result", (1, "t1"): "ok", (1, "t3"): "bad arguments: $.text: has a wrong length", (2, "t-1"): "no call",
        (3, "t0"): "bad arguments: $.text: has a wrong length"}
    assert got[1, "t3"].needs == ["t1"] and got[1, "t1"].content == "hello"


def test_schema_rules_and_order():
    assert violations({"q": "x", "n": 1, "tags": ["a"]}, SCHEMA) == []
    assert violations({"n": True, "tags": ["c"], "z": 1}, SCHEMA) == [
        "$.q: is missing", "$.z: is not known", "$.n: is not integer", "$.tags[0]: is none of the allowed values"]
    assert parsed("NaN")[1] and parsed(None)[1] and parsed("1e400")[1] and parsed('{"a":1}') == ({"a": 1}, None)


def brute(calls):
    """Order and cyclic calls of one conversation from (call, turn, needs), settled one by one."""
    at = {c: (t, c) for c, t, _ in calls}
    needs = {c: {x for x in n if x in at and x != c} for c, _, n in calls}
    key = {}
    while fresh := [c for c in at if c not in key and all(x in key for x in needs[c])]:
        for c in fresh:
            key[c] = max([(at[c], 0), *[(key[x][0], key[x][1] + 1) for x in needs[c]]])
    order = sorted(key, key=lambda c: (key[c], at[c])) + sorted((c for c in at if c not in key), key=at.get)
    return order, set(at) - set(key) | {c for c, _, n in calls if c in n}


@pytest.mark.parametrize("slab", [3, 7, 10_000])
def test_order_is_the_same_at_every_size(spark, monkeypatch, slab):
    """Slabs smaller and larger than the conversations: cycles, references back and ahead, also across slabs and parts."""
    rnd = random.Random(3)
    talks = {}
    for conv in range(14):
        n = rnd.choice([1, 4, 20, 60])
        ids = [f"c{k}" for k in range(n)]
        talks[conv] = [(c, rnd.randrange(n) if conv % 3 else k, [rnd.choice(ids) for _ in range(rnd.choice([0, 0, 1, 2]))] if rnd.random() < 0.3 + 0.1 * (conv % 2) else
                        [ids[k - 2]] if k > 1 else ["gone"]) for k, c in enumerate(ids)]
    talks[90] = [("a", 0, ["b"]), ("b", 50, ["a"])] + [(f"d{k:02d}", k, [f"d{k + 1:02d}"] if k < 40 else []) for k in range(1, 41)]
    talks[91] = [("a", 0, ["a"]), ("b", 1, ["a"])]
    rows = [(conv, c, t, None, "find", '{"q":"x"}', None, "ok", n, "extra") for conv, calls in talks.items() for c, t, n in calls]
    linked = spark.createDataFrame(rows, "conv_id long, call_id string, call_turn long, result_turn long, tool string, arguments string, content string, status string, needs array<string>, part string")
    linked = linked.drop("part")
    monkeypatch.setattr(tool_calls, "SLAB_CALLS", slab)
    monkeypatch.setattr(ordered_calls, "__defaults__", (slab,))
    found = {}
    for r in sorted(formatted(linked, most_rows=9).collect(), key=lambda r: (r.conv_id, r.part)):
        ids, cyclic = found.setdefault(r.conv_id, ([], []))
        assert r.calls == len(json.loads(r.json)) <= 9 and r.linked == r.calls
        ids += [c["id"] for c in json.loads(r.json)]
        cyclic.append(r.cyclic)
    assert set(found) == set(talks)
    for conv, calls in talks.items():
        order, cyclic = brute(calls)
        assert found[conv][0] == order and sum(found[conv][1]) == len(cyclic), conv
    assert sum(len(brute(c)[1]) for c in talks.values()) > 10


def test_calls_without_turns_are_cut_too(frames):
    calls = [(1, None, f"c{k:03d}", "find", '{"q":"${c099}"}') for k in range(100)]
    parts = formatted(linked_calls(*frames(calls, [])), most_rows=30).collect()
    assert sorted((r.part, r.calls, r.cyclic) for r in parts) == [(0, 30, 1), (1, 30, 0), (2, 30, 0), (3, 10, 0)]
    assert [json.loads(r.json)[0]["id"] for r in parts if r.part == 0] == ["c099"]
