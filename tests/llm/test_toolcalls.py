import json
import random

import pytest
from conftest import SF_SMALL

from flowprism.llm import toolcalls

CALLS = "conv long, turn long, call_id string, name string, arguments string, needs array<string>, block string, level string, result string"
RESULTS = "conv long, turn long, call_id string, content string, name string, r string"
SCHEMAS = {"f": {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}}, "additionalProperties": False}}


def test_canonical_json():
    text = toolcalls.canonical(json.loads('{"b": [1, 2.0, 1e30, 0.1, true, null, -0.0], "a": {"é": "\\u00e9\\n\\"", "\\ud83d\\ude00": 1, "z": 1.5e-9}}'))
    assert text == '{"a":{"z":1.5e-9,"é":"é\\n\\"","😀":1},"b":[1,2,1e+30,0.1,true,null,0]}'
    assert json.loads(text) == {"a": {"é": 'é\n"', "😀": 1, "z": 1.5e-9}, "b": [1, 2, 1e30, 0.1, True, None, 0]}
    with pytest.raises(ValueError):
        toolcalls.canonical(float("nan"))


def test_schema_violations():
    schema = {"type": "object", "required": ["a", "b"], "additionalProperties": False, "properties": {
        "a": {"type": "integer", "minimum": 1, "maximum": 3}, "b": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"type": "string", "minLength": 2}},
        "c": {"enum": [1, "x"]}, "d": {"type": ["null", "number"]}, "e": {"const": True}}}

    def bad(x):
        return toolcalls.violations(x, schema)
    assert bad({"a": 2, "b": ["xy"], "c": 1, "d": None, "e": True}) == []
    assert bad({"a": 2.0, "b": ["xy"]}) == []
    assert bad([]) == ["$ type"]
    assert bad({"a": 4, "b": []}) == ["$.a maximum", "$.b minItems"]
    assert bad({"a": True, "b": ["x", "yy", "zz"]}) == ["$.a type", "$.b maxItems", "$.b[0] minLength"]
    assert bad({"a": 1, "x": 1, "c": True, "d": "1", "e": 1}) == ["$.b required", "$.c enum", "$.d type", "$.e const", "$.x additionalProperties"]
    assert toolcalls.check_arguments("f", None, SCHEMAS) == (None, ["$ json"])
    assert toolcalls.check_arguments("f", '{"a": NaN}', SCHEMAS) == (None, ["$ json"])
    assert toolcalls.check_arguments(None, "{}", SCHEMAS) == ("{}", ["$ tool"])
    assert toolcalls.check_arguments("f", "[" * 100_000, SCHEMAS)[1] == ["$ json"]


def slow_order(calls):
    """Positions by the rule, for one conversation's (turn, id, needs): knots of overlapping late spans, ordered by level."""
    turn = {i: t for t, i, _ in calls}
    spans = sorted((t, turn[n]) for t, i, ns in calls for n in set(ns or ()) if n in turn and turn[n] >= t)
    knots = []
    for a, b in spans:
        if knots and a <= knots[-1][1]:
            knots[-1][1] = max(knots[-1][1], b)
        else:
            knots.append([a, b])
    at = {i: next((k[0] for k in knots if k[0] <= t <= k[1]), None) for t, i, _ in calls}
    level = {i: 0 for _, i, _ in calls if at[i] is None}
    for k in knots:
        here = {i: {n for n in ns or () if n in turn and at[n] == k[0]} for t, i, ns in calls if at[i] == k[0]}
        n = 0
        while here:
            ready = [i for i, ns in here.items() if not ns]
            if not ready:
                level.update({i: -1 for i in here})
                break
            level.update({i: n for i in ready})
            here = {i: ns - set(ready) for i, ns in here.items() if i not in ready}
            n += 1
    order = sorted(calls, key=lambda c: (c[0] if at[c[1]] is None else at[c[1]], level[c[1]] == -1, level[c[1]], c[0], c[1]))
    return {c[1]: p for p, c in enumerate(order)}, {i for i, v in level.items() if v == -1}


@pytest.mark.parametrize("turns, knot_limit", [(4096, 20_000), (7, 20_000), (7, 2)])
def test_order_against_the_rule(spark, monkeypatch, turns, knot_limit):
    monkeypatch.setattr(toolcalls, "TURNS", turns)
    r = random.Random(turns + knot_limit)
    calls, results = [], []
    for conv in range(12):
        n = r.choice([1, 5, 40])
        for t in range(n):
            needs = [f"c{r.randrange(max(0, t - 6), t)}"] if t and r.random() < 0.7 else []
            if r.random() < 0.12:
                needs.append(f"c{min(n - 1, t + r.randint(0, 4))}")
            if r.random() < 0.1:
                needs.append("unknown")
            calls.append((conv, t * 3, f"c{t}", "f", '{"a": 1}', needs or None, "x", "y", "z"))
            results.append((conv, t * 3 + 1, f"c{t}", "done", "x", "y"))
    got = toolcalls.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS, knot_limit).collect()
    assert len(got) == len(calls)
    loops = 0
    for conv in range(12):
        own = [(c[1], c[2], c[5]) for c in calls if c[0] == conv]
        want, cyclic = slow_order(own)
        loops += len(cyclic)
        here = {x.call_id: x for x in got if x.conv == conv}
        assert {i: x.position for i, x in here.items()} == want
        assert {i for i, x in here.items() if "cycle" in x.errors} == cyclic
        for t, i, needs in own:
            known = [n for n in needs or () if n in want]
            assert i in cyclic or all(want[n] < want[i] for n in known)
            assert ("unknown need" in here[i].errors) == any(n not in want for n in needs or ())
            assert json.loads(here[i].message) == {"arguments": {"a": 1}, "id": i, "name": "f", "position": want[i], "result": "done"}
    assert loops


def test_faults(spark):
    calls = [(1, 0, "a", "f", '{"a": 1}', [], "", "", ""), (1, 2, "b", "f", '{"a": -1}', ["a", "a"], "", "", ""), (1, 4, "c", "g", "{}", None, "", "", ""),
             (1, 6, "d", "f", "{", ["zz"], "", "", ""), (1, 8, "a", "f", '{"a": 2}', [], "", "", ""), (1, 8, "a", "f", '{"a": 2}', [], "", "", ""),
             (2, 0, "e", None, None, ["e"], None, None, None), (None, 0, "n", "f", "{}", [], "", "", ""), (1, None, "n", "f", "{}", [], "", "", ""), (1, 1, None, "f", "{}", [], "", "", "")]
    results = [(1, 1, "a", None, "", ""), (1, 9, "a", "late", "", ""), (1, 3, "b", "x", "", ""), (1, 5, "orphan", "y", "", ""), (3, 0, "a", "z", "", ""), (None, 1, "q", "", "", ""), (3, 1, None, "", "", "")]
    got = toolcalls.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS).collect()
    rows = sorted((x.conv, x.call_id, x.turn, x.result_turn, x.position, x.valid, tuple(x.errors)) for x in got if x.turn is not None)
    assert rows == [
        (1, "a", 0, 1, 0, False, ("repeated result",)), (1, "a", 8, None, None, False, ("repeated id",)), (1, "a", 8, None, None, False, ("repeated id",)),
        (1, "b", 2, 3, 1, False, ("$.a minimum",)), (1, "c", 4, None, 2, False, ("$ tool", "no result")),
        (1, "d", 6, None, 3, False, ("$ json", "no result", "unknown need")), (2, "e", 0, None, 0, False, ("$ json", "cycle", "no result"))]
    assert sorted((x.conv, x.call_id, x.result_turn, tuple(x.errors)) for x in got if x.turn is None) == [(1, "orphan", 5, ("no call",)), (3, "a", 0, ("no call",))]
    assert {x.call_id: x.message for x in got if x.turn is not None and x.position == 1} == {"b": '{"arguments":{"a":-1},"id":"b","name":"f","position":1,"result":"x"}'}
    assert next(x for x in got if x.call_id == "d").message is None


def test_empty_tables_and_long_arguments(spark):
    no_calls, no_results = spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS)
    assert toolcalls.link(no_calls, no_results, {}).count() == 0
    text = "x" * 300_000
    long = spark.createDataFrame([(1, 0, "a", "s", json.dumps({"q": text}), [], "", "", "")], CALLS)
    got = toolcalls.link(long, spark.createDataFrame([(1, 1, "a", text, "", "")], RESULTS), {"s": {}}).collect()
    assert got[0].valid and json.loads(got[0].message)["arguments"]["q"] == text


def test_query(spark):
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    got = toolcalls.query(spark, SF_SMALL).collect()
    assistant = {(r.conv_id, r.turn) for r in turns if r.role == "assistant"}
    user = {(r.conv_id, r.turn) for r in turns if r.role == "user" and r.turn}
    assert {(x.conv_id, x.turn) for x in got if x.turn is not None} == assistant
    assert {(x.conv_id, x.result_turn) for x in got if x.result_turn is not None} == user
    for x in got:
        if x.turn is not None:
            assert x.result_turn == (x.turn + 1 if (x.conv_id, x.turn + 1) in user else None)
    by = {}
    for x in got:
        if x.position is not None:
            by.setdefault(x.conv_id, []).append(x.position)
    assert all(sorted(p) == list(range(len(p))) for p in by.values())
    assert 0.3 < sum(x.valid for x in got) / len(got) < 1


def test_traffic_holds_every_turn_and_its_whole_text(spark):
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    text = {(r.conv_id, r.turn): (r.role, r.text) for r in turns.collect()}
    calls, _ = toolcalls.traffic(turns)
    calls = calls.collect()
    assert {x.name for x in calls} >= {"search", "summarise", "measure"}
    for x in calls:
        whole = json.loads(x.arguments if x.arguments.endswith("}") else x.arguments + "}")
        assert text[x.conv, x.turn][1] in (whole.get("text"), whole.get("query"))
    got = toolcalls.query(spark, SF_SMALL).collect()
    assert len({(x.conv_id, next(t for t in (x.turn, x.result_turn, x.context_turn) if t is not None)) for x in got}
               | {(x.conv_id, x.result_turn) for x in got if x.result_turn is not None}) == len(text)
    context = [x for x in got if x.context_turn is not None]
    assert {text[x.conv_id, x.context_turn][0] for x in context} == {"system", "user"}
    for x in context:
        role, own = text[x.conv_id, x.context_turn]
        assert json.loads(x.message) == {"role": role, "text": own} and not x.valid
    odd = spark.createDataFrame([(1, None, "user", "a"), (1, 3, None, "b"), (1, 0, "user", None), (1, 1, "assistant", "c"), (1, 2, "user", "d")],
                                "conv_id long, turn int, role string, text string")
    assert sorted(x.message for x in toolcalls.context(odd).collect()) == ['{"role":"user","text":""}', '{"role":"user","text":"a"}', '{"role":null,"text":"b"}']


def test_every_call_and_result_keeps_its_content(spark):
    calls = [(1, 0, "a", "f", '{"a": 1}', [], "", "", ""), (1, 4, "a", "f", '{"a": 2}', [], "", "", ""), (1, 6, "b", "f", '{"a": "cut', [], "", "", ""),
             (1, 8, "c", "f", None, [], "", "", ""), (None, 0, "n", "f", '{"a": 3}', [], "", "", ""), (1, None, "n", "f", "{", [], "", "", ""), (1, 1, None, "f", "{}", [], "", "", "")]
    results = [(1, 1, "a", "first", "", ""), (1, 2, "a", "retry", "", ""), (1, 2, "a", "retry", "", ""), (1, 3, "a", None, "", ""), (1, 7, "b", "answer", "", ""),
               (2, 3, "z", "alone", "", ""), (2, 3, "z", "alone", "", ""), (None, 1, "q", "p", "", ""), (3, None, "q", "r", "", ""), (3, 1, None, "s", "", "")]
    got = toolcalls.link_all(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS).collect()

    def rows(*errors):
        return sorted(((x.conv, x.turn, x.result_turn, x.message, x.raw) for x in got if tuple(x.errors) == errors), key=str)
    assert rows("repeated result") == [(1, 0, 1, '{"arguments":{"a":1},"id":"a","name":"f","position":0,"result":"first"}', None)]
    assert rows("later result") == [(1, None, 2, '{"id":"a","result":"retry"}', None)] * 2 + [(1, None, 3, '{"id":"a","result":null}', None), (2, None, 3, '{"id":"z","result":"alone"}', None)]
    assert rows("no call", "repeated result") == [(2, None, 3, '{"id":"z","result":"alone"}', None)]
    assert rows("repeated id") == [(1, 4, None, '{"arguments":{"a":2},"id":"a","name":"f","position":null,"result":null}', None)]
    assert rows("$ json") == [(1, 6, 7, None, '{"arguments":"{\\"a\\": \\"cut","id":"b","name":"f","position":1,"result":"answer"}')]
    assert rows("$ json", "no result") == [(1, 8, None, None, '{"arguments":null,"id":"c","name":"f","position":2,"result":null}')]
    assert rows("null key") == sorted([(None, 0, None, '{"arguments":{"a":3},"id":"n","name":"f","position":null,"result":null}', None), (None, None, 1, '{"id":"q","result":"p"}', None),
                                       (3, None, None, '{"id":"q","result":"r"}', None), (3, None, 1, '{"id":null,"result":"s"}', None)], key=str)
    assert rows("$ json", "null key")[0][4].startswith('{"arguments":"{",') and len(rows("$.a required", "null key")) == 1
    assert len(got) == 15  # the results of "a" and "b" are in their calls' rows


def test_arguments_that_have_no_plain_form():
    from flowprism.llm.toolcalls import check_arguments
    text, errors = check_arguments("f", '{"query":"\\ud800 x","\\udfff":1}', {"f": {"type": "object", "additionalProperties": False, "properties": {"query": {"type": "string"}}}})
    assert text == '{"query":"\\ud800 x","\\udfff":1}' and errors == ["$.\\udfff additionalProperties", "$ surrogate"]
    text.encode(), "".join(errors).encode()
    assert check_arguments("f", '{"q":"\\ud83d\\ude00 \\\\ud800"}', {"f": {}})[1] == []  # a pair, and a backslash before letters
    assert check_arguments("f", '{"a":{"q":1,"q":2}}', {"f": {}}) == (None, ["$ repeated key"])
    assert check_arguments("f", "9" * 6000, {"f": {}}) == ("9" * 6000, [])
