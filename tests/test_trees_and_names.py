"""Nested JSON unfolded level by level, and names that contain a text, against brute force."""

import json
import random

import pytest

from driftline.operators import contain, unfold


def flatten(tree, path=""):
    if isinstance(tree, str):
        return {path: tree}
    out = {}
    steps = [(f"{path}.{k}" if path else k, v) for k, v in tree.items()] if isinstance(tree, dict) else [(f"{path}[{i}]", v) for i, v in enumerate(tree)] if isinstance(tree, list) else []
    for p, v in steps:
        out |= flatten(v, p)
    return out


def a_tree(deal, depth):
    kind = deal.random()
    if not depth or kind < 0.3:
        return deal.choice(["x", "", 'ü"\\\n\t', "a.b", 1, 1.50, True, None, "{}", "[1]", " "])
    if kind < 0.65:
        return {deal.choice(["a", "b", "", "a.b", "c[0]", "é", " "]): a_tree(deal, depth - 1) for _ in range(deal.randint(0, 3))}
    return [a_tree(deal, depth - 1) for _ in range(deal.randint(0, 3))]


ODD = [None, '"top"', "5", ' {"a" : "x"} ', '{"a.b":"1","a":{"b":"2"}}', '{"a":{"b":"2"},"a.b":"1"}', '{"a":"1","a":"2"}', "[]", "{}", "[" * 60 + '"deep"' + "]" * 60]


def test_leaves(spark):
    deal = random.Random(2)
    docs = [json.dumps(a_tree(deal, 6), ensure_ascii=deal.random() < 0.5) for _ in range(200)] + ODD
    before = spark.conf.get("spark.sql.variant.allowDuplicateKeys", None)
    rows = unfold.leaves(spark.createDataFrame([(i, d, "same") for i, d in enumerate(docs)], "i int, value string, more string"), "value")
    got: dict = {}
    for r in rows.collect():
        got.setdefault(r.i, {})[r.path] = r.text
    assert rows.columns == ["i", "more", "path", "text"] and spark.conf.get("spark.sql.variant.allowDuplicateKeys", None) == before
    for i, d in enumerate(docs):
        assert got.get(i, {}) == (flatten(json.loads(d)) if d else {}), d
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bad", ["{", '{"a":1} x', "", "nope", '{"a":1},{"b":2}'])
def test_what_is_not_json_is_an_error(spark, bad):
    with pytest.raises(Exception, match="not JSON|MALFORMED"):
        unfold.leaves(spark.createDataFrame([(1, bad)], "i int, value string"), "value")


def test_first_names(spark):
    deal = random.Random(3)
    word = lambda most: "".join(deal.choice("abc") for _ in range(deal.randint(0, most)))
    names = [(i % 290, n) for i, n in enumerate([*(word(12) for _ in range(300)), "", None])]
    texts = [*(word(7) for _ in range(300)), None, "zzzz", "", "abcabcabcabcabc", "a.c", "%"]
    got = contain.first_names(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), spark.createDataFrame(names, "o int, n string"), "t", "n", ["o"], "hit")
    want = {i: min(((o, n) for o, n in names if n and t is not None and t in n), default=(0, None))[1] for i, t in enumerate(texts)}
    assert {r.i: r.hit for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = spark.createDataFrame([], "o int, n string")
    assert {r.hit for r in contain.first_names(got.select("i", "t"), none, "t", "n", ["o"], "hit").collect()} == {None}
