"""Linking, levels, validation and canonical JSON on small graphs."""

from __future__ import annotations

import json
import random

from caselens.llm import tools

CALLS = "conv_id long, call_id string, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id long, call_id string, content string"
SCHEMAS = {"f": {"a": ("integer", True), "b": ("number", False), "s": ("string", False), "o": ("object", False), "l": ("array", False),
                 "t": ("boolean", False)}}


def link(spark, calls, results=()):
    rows = tools.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(list(results), RESULTS), SCHEMAS).collect()
    return {(r["conv_id"], r["call_id"]): r for r in rows}


def test_links_validates_and_writes(spark):
    calls = [
        (1, "x", "f", '{"b": 1.50, "a": 1, "s": "q\\u00e9\\n\\"/"}', None),
        (1, "y", "f", '{"a": "1", "z": 0, "t": 1}', ["x", "gone"]),
        (1, "w", "f", "[1]", []), (1, "v", "f", "no json", ["w", "y"]), (1, "u", None, None, None), (1, "q", "g", "{}", None),
        (2, "x", "f", '{"o": {"k": [1, {"b": 2, "a": 1}]}, "l": [], "t": true, "a": 5}', ["x"]),
        (3, "x", "f", '{"a": 2}', None), (3, "x", "f", '{"a": 1}', None), (None, "n", "f", '{"a": 1}', None),
    ]
    results = [(1, "x", "fine"), (1, "x", "extra"), (1, "none", None), (2, "y", "orphan"), (None, "n", "é")]
    got = link(spark, calls, results)
    assert got[1, "x"]["status"] == "answered" and got[1, "x"]["repeats"] == 1 and got[1, "x"]["errors"] == ""
    assert got[1, "x"]["json"] == (
        '{"arguments":{"a":1,"b":1.5,"s":"qé\\n\\"/"},"content":"extra","errors":[],"id":"x","level":0,"name":"f"}')
    assert got[1, "y"]["errors"] == "a is no integer;t is no boolean;unknown z" and got[1, "y"]["level"] == 1
    assert got[1, "w"]["errors"] == got[1, "v"]["errors"] == "no JSON object" and got[1, "v"]["level"] == 2
    assert got[1, "q"]["errors"] == "unknown tool g" and got[1, "none"]["status"] == "orphan" and got[1, "none"]["level"] is None
    assert got[2, "x"]["level"] is None and got[2, "x"]["errors"] == "cycle"
    assert got[3, "x"]["repeats"] == 1 and '"a":1' in got[3, "x"]["json"]
    assert got[None, "n"]["status"] == "answered"
    for r in got.values():
        json.loads(r["json"])
    assert link(spark, []) == {}


def longest(deps):
    level, state = {}, {}

    def visit(n):
        if state.get(n) == 1:
            return None
        if n not in level:
            state[n] = 1
            below = [visit(d) for d in deps[n]]
            level[n] = None if None in below else 1 + max(below, default=-1)
            state[n] = 2
        return level[n]

    return {n: visit(n) for n in deps}


def test_levels_are_the_longest_ways(spark):
    rng = random.Random(6)
    deps = {f"c{i}": [f"c{j}" for j in {rng.randrange(i) for _ in range(rng.choice([0, 1, 1, 1, 2, 3]))}] if i else [] for i in range(120)}
    deps |= {f"d{i}": [f"d{i - 1}"] if i else [] for i in range(200)}
    deps |= {"r0": ["r2"], "r1": ["r0"], "r2": ["r1"], "after": ["r0"], "both": ["r1", "c3"]}
    got = link(spark, [(5, n, "f", '{"a": 1}', d) for n, d in deps.items()])
    want = longest(deps) | dict.fromkeys(["r0", "r1", "r2", "after", "both"])
    assert {n: got[5, n]["level"] for n in deps} == want


def test_a_null_conversation_has_levels_too(spark):
    deps = {"a": None, "b": ["a"], "c": ["b"], "d": ["a", "c"], "e": ["d"], "x": ["y"], "y": ["x"]}
    calls = [(conv, n, "f", '{"a": 1}', d) for conv in (None, 7) for n, d in deps.items()]
    got = link(spark, calls, [(None, "e", "done")])
    for conv in (None, 7):
        assert [got[conv, n]["level"] for n in deps] == [0, 1, 2, 3, 4, None, None]
        assert [got[conv, n]["errors"] for n in deps] == ["", "", "", "", "", "cycle", "cycle"]
    assert got[None, "e"]["status"] == "answered" and got[7, "e"]["status"] == "unanswered" and len(got) == 2 * len(deps)
