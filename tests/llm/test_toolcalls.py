import json
import random

import pytest

from shopgrain.llm import toolcalls as T

CALLS = "id string, seq long, name string, arguments string, waits_for string"
RESULTS = "id string, seq long, content string"
SCHEMAS = {"add": {"type": "object", "required": ["a"], "additionalProperties": False,
                   "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": ["number", "null"]},
                                  "c": {"type": "array", "items": {"enum": ["x", 1]}, "maxItems": 2},
                                  "d": {"type": "string", "minLength": 2}}}}


def test_violations():
    ok = lambda v: T.violations(v, SCHEMAS["add"])
    assert ok({"a": 1}) == [] and ok({"a": 2.0, "b": None, "c": ["x", 1], "d": "é中"}) == []
    assert ok([]) == ["$: not object"]
    assert ok({}) == ["$.a: missing"]
    assert ok({"a": True}) == ["$.a: not integer"]
    assert ok({"a": -1, "z": 0}) == ["$.a: below minimum", "$.z: not known"]
    assert ok({"a": 1, "c": ["x", 2, 1], "d": "é"}) == [
        "$.c: longer than maxItems", "$.c[1]: not in enum", "$.d: shorter than minLength"]


def test_canonical_json_is_one_spelling():
    one = '{"b": [1.0, 2.5, {"y": null, "x": true}], "a": "\\u00e9\\n"}'
    two = '{"a":"é\\n","b":[1,2.50,{"x":true,"y":null}]}'
    assert T.canonical(json.loads(one)) == T.canonical(json.loads(two)) == (
        '{"a":"é\\n","b":[1,2.5,{"x":true,"y":null}]}')
    assert json.loads(T.canonical(json.loads(one))) == json.loads(one)
    with pytest.raises(ValueError):
        T.canonical(float("nan"))


def slow_depths(calls):
    known = dict(calls)

    def depth(i):
        seen, n = set(), 0
        while (up := known[i]) is not None and up in known:
            if i in seen:
                return None
            seen.add(i)
            i, n = up, n + 1
        return n

    return {i: depth(i) for i in known}


@pytest.mark.parametrize("seed", [1, 2])
def test_depths_of_chains_stars_and_cycles(spark, seed):
    rng = random.Random(seed)
    calls = [("r", None), *[(f"s{i}", "r") for i in range(200)], *[(f"c{i}", f"c{i - 1}") for i in range(1, 150)]]
    calls += [("c0", None), ("x", "y"), ("y", "z"), ("z", "x"), ("tail", "x"), ("self", "self"), ("lost", "gone")]
    calls += [(f"t{i}", f"t{rng.randrange(i)}") for i in range(1, 100)] + [("t0", "lost")]
    rng.shuffle(calls)
    found = {r["id"]: r["depth"] for r in T.depths(spark.createDataFrame(calls, "id string, waits_for string")).collect()}
    assert found == slow_depths(calls)


def test_linked_calls(spark):
    calls = [
        ("1", 1, "add", '{"b":1.0,"a":1}', None), ("2", 3, "add", '{"a":"no"}', "1"),
        ("3", 4, "add", "not json", "2"), ("4", 5, "other", "{}", None), ("5", 6, "add", '{"a":1}', "9"),
        ("6", 7, "add", '{"a":1}', "7"), ("7", 8, "add", '{"a":1}', "6"), ("8", 9, "add", '{"a":1}', "1"),
        ("8", 9, "add", '{"a":1}', "1"), ("8", 2, "add", '{"a":3}', "1"), (None, 1, "add", "{}", None),
        ("n", None, None, None, None),
    ]
    results = [("1", 2, '{"z": 1, "y": 2}'), ("1", 5, "late"), ("2", 4, "plain"), ("3", 5, None), ("4", 6, "4"),
               ("5", 7, "5"), ("6", 8, "6"), ("7", 9, "7"), ("77", 1, "orphan"), (None, 1, "x")]
    frame = spark.createDataFrame(calls, CALLS).selectExpr("*", "'x' as result", "1 as depth", "2 as errors")
    found = {r["id"]: r for r in T.link(frame, spark.createDataFrame(results, RESULTS), SCHEMAS).collect()}
    assert set(found) == {"1", "2", "3", "4", "5", "6", "7", "8", "n"}
    assert found["1"]["json"] == '{"arguments":{"a":1,"b":1},"id":"1","name":"add","result":{"y":2,"z":1}}'
    status = {i: r["status"] for i, r in found.items()}
    assert status == {"1": "linked", "2": "invalid", "3": "invalid", "4": "invalid", "5": "dangling",
                      "6": "cycle", "7": "cycle", "8": "open", "n": "invalid"}
    assert (found["8"]["n_calls"], found["8"]["seq"], found["8"]["depth"]) == (3, 2, 1)
    assert (found["1"]["n_results"], found["3"]["depth"]) == (2, 2)
    assert found["3"]["errors"] == ["arguments are not JSON"] and found["4"]["errors"] == ["unknown tool"]


def test_no_row_is_missing(spark):
    calls = [(1, "a", 1, "add", '{"a":1}', None), (1, "a", 1, "add", '{"a":1}', None), (1, "a", 3, "add", '{"a":2}', None),
             (2, "a", 1, "add", '{"a":5}', "b"), (2, "b", 2, "add", '{"a":6}', None), (2, None, 4, "add", "{}", None),
             (None, "a", 1, "other", None, None)]
    results = [(1, "a", 2, "one"), (1, "a", 2, "one"), (1, "a", 5, "late"), (2, "b", 3, "two"), (2, "c", 3, "lost"),
               (2, None, 9, "x"), (3, "b", 3, "elsewhere")]
    frames = (spark.createDataFrame(calls, "conv_id long, " + CALLS), spark.createDataFrame(results, "conv_id long, " + RESULTS))
    found = T.link(*frames, SCHEMAS, conversation="conv_id", unlinked=True).collect()
    assert sorted(str((r["conv_id"], r["id"], r["seq"], r["status"])) for r in found) == sorted(map(str, [
        (1, "a", 1, "linked"), (1, "a", 1, "duplicate"), (1, "a", 3, "duplicate"), (2, "a", 1, "open"),
        (2, "b", 2, "linked"), (2, None, 4, "nameless call"), (None, "a", 1, "invalid"),
        (1, "a", 2, "repeated result"), (1, "a", 5, "repeated result"), (2, "c", 3, "unmatched result"),
        (2, None, 9, "nameless result"), (3, "b", 3, "unmatched result")]))
    by = {(r["conv_id"], r["id"], r["status"]): r for r in found}
    assert by[2, "a", "open"]["depth"] == 1 and by[2, "b", "linked"]["depth"] == 0
    assert json.loads(by[3, "b", "unmatched result"]["json"])["result"] == "elsewhere"
    linked = T.link(*frames, SCHEMAS, conversation="conv_id").collect()
    assert len(linked) == 4


def test_empty_tables(spark):
    calls, results = spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS)
    assert T.link(calls, results, SCHEMAS).collect() == []


def test_query_against_plain_python(spark):
    from shopgrain.llm.catalogue import QUERIES, TOOLS

    folder = "/root/testdata/sf0.001"
    turns = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    calls = {f"call-{c}-{t}": (c, t, role, text) for c, t, role, text in turns if role != "assistant"}
    answers = {f"call-{c}-{t - 1}": text for c, t, role, text in turns if role == "assistant"}
    found = QUERIES["op5_tool_calls"](spark, folder).collect()
    assert {r["id"] for r in found} == set(calls) and len(found) == len(calls)
    depth = slow_depths([(i, f"call-{c}-{t - 2}" if t >= 2 else None) for i, (c, t, *_) in calls.items()])
    for row in found:
        c, t, role, text = calls[row["id"]]
        name = "ask" if role == "user" else "setup"
        arguments = {"text": text} | ({"turn": t} if name == "ask" else {})
        assert row["errors"] == T.violations(arguments, TOOLS[name])
        expected = {"arguments": arguments, "id": row["id"], "name": name, "result": answers.get(row["id"])}
        assert json.loads(row["json"]) == expected
        assert row["json"] == json.dumps(expected, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert row["depth"] == depth[row["id"]]
