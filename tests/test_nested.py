import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeworks.operators import nested

name = st.text("ab \"{}[]'", max_size=4)
entry = st.one_of(st.none(), name, st.builds(lambda n: {"name": n, "default": [1, {"x": None}]}, name), st.just(3))
entries = st.one_of(st.none(), st.lists(entry, max_size=4), name, st.lists(st.one_of(st.none(), name), max_size=3).map(json.dumps))


def keyed(child):
    item = st.one_of(st.none(), st.builds(lambda e: {child: e, "other": {"deep": [[1]]}}, entries), st.just({}))
    return st.one_of(st.none(), st.dictionaries(name, item, max_size=3), st.lists(st.one_of(st.none(), st.builds(lambda n, e: {"name": n, child: e}, name, entries)), max_size=3))


body = st.one_of(st.none(), st.just(" "), st.just('{"actions": {}}x'), st.just('{"a": NaN}'), st.builds(lambda a, m: json.dumps({"actions": a, "models": m}), keyed("automl_default_parameters"), keyed("actions")))


def brute(text):
    try:
        doc = json.loads(text, parse_constant=lambda _: 1 / 0)
    except Exception:
        return
    if not isinstance(doc, dict):
        return
    for level, child in (("actions", "automl_default_parameters"), ("models", "actions")):
        x = doc.get(level)
        pairs = list(x.items()) if isinstance(x, dict) else [(y["name"], y) for y in x if isinstance(y, dict)] if isinstance(x, list) else []
        for parent, v in pairs:
            if not isinstance(v, dict):
                continue
            got = v.get(child)
            if isinstance(got, str):
                try:
                    inner = json.loads(got)
                    got = inner if isinstance(inner, list) else [got]
                except ValueError:
                    got = [got]
            for i, e in enumerate(got or []):
                n = e.get("name") if isinstance(e, dict) else e
                if isinstance(n, str) and n.strip():
                    yield parent, i, n


@settings(max_examples=6, deadline=None)
@given(st.lists(body, min_size=1, max_size=40))
def test_children_equal_a_plain_walk(spark, bodies):
    rows = [(i, b, "clash") for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "manifest_id long, body string, nested string")
    got = {(r["manifest_id"], r["parent_name"], r["pos"], r["child_name"]) for r in nested.manifest_children(df).where("child_name is not null").collect()}
    assert got == {(i, *x) for i, b in enumerate(bodies) if b for x in brute(b)}


def test_links_of_three_levels(spark):
    schema = "k int, doc struct<a:array<struct<n:string,b:array<struct<v:int,c:array<int>>>>>>"
    rows = [
        (1, {"a": [{"n": "x", "b": [{"v": 1, "c": [7, 8]}, {"v": 2, "c": []}]}, {"n": "y", "b": None}]}),
        (2, {"a": []}),
        (3, None),
        (4, {"a": [{"n": None, "b": [{"v": None, "c": [None, 9]}]}, None]}),
    ]
    df = spark.createDataFrame(rows, schema)
    flat = nested.flatten(df, ["k"], "doc", ["a", "[]", "b", "[]", "c", "[]"], carry={"n": (0, "n"), "v": (1, "v")})
    got = sorted(map(tuple, flat.collect()), key=str)
    assert got == sorted([(1, 0, 0, 0, "x", 1, 7), (1, 0, 0, 1, "x", 1, 8), (4, 0, 0, 0, None, None, None), (4, 0, 0, 1, None, None, 9)], key=str)


def test_clashing_names_are_refused(spark):
    df = spark.createDataFrame([(1, [2])], "value int, xs array<int>")
    with pytest.raises(ValueError):
        nested.flatten(df, ["value"], "xs", ["[]"])


def test_empty(spark):
    assert nested.manifest_children(spark.createDataFrame([], "manifest_id long, body string")).count() == 0


@pytest.mark.parametrize("text, ok", [('{"a":1}', True), ("{'a':1}", False), ('{"a":1,}', False), ('{"a":NaN}', False), ('{"a":-Infinity}', False), ('{"a":1}{"a":1}', False), ('{"a":"\n"}', False), ("﻿{}", False), ('{"a":' + "9" * 5000 + "}", True)])
def test_strict_json(text, ok):
    if ok:
        nested.strict_json(text)
    else:
        with pytest.raises(ValueError):
            nested.strict_json(text)
