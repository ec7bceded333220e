"""Nested JSON at paths such as a.b[0].c: parsing paths and setting texts; order of keys is kept. ``operators.unfold`` reads the leaves."""

from __future__ import annotations

import json
import re
import uuid

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STEP = re.compile(r"\[(\d+)\]|([^.\[\]]+)")


def parse_path(path: str) -> list[str | int]:
    return [int(i) if i else name for i, name in _STEP.findall(path)]


def set_path(tree, path: str, text: str) -> bool:
    """Set an existing place; whether there was one."""
    steps = parse_path(path)
    for step in steps[:-1]:
        tree = _child(tree, step)
        if tree is None:
            return False
    if not steps or _child(tree, steps[-1], missing := object()) is missing:
        return False
    tree[steps[-1]] = text
    return True


def _child(node, step, default=None):
    if isinstance(step, int):
        return node[step] if isinstance(node, list) and step < len(node) else default
    return node.get(step, default) if isinstance(node, dict) else default


_UPDATED = T.StructType([T.StructField("value", T.StringType()), T.StructField("applied", T.LongType())])


def _updated(texts: pd.Series, updates: pd.Series, put) -> pd.DataFrame:
    """put(tree, key, text) tells whether it set the text."""

    def one(t, u):
        if t is None:
            return None, 0
        tree = json.loads(t)
        n = sum(put(tree, key, text) for key, text in dict(u if u is not None else {}).items())
        return json.dumps(tree, ensure_ascii=False, separators=(",", ":")), n

    return pd.DataFrame([one(t, u) for t, u in zip(texts, updates, strict=True)], columns=["value", "applied"])


@F.pandas_udf(_UPDATED)
def json_with(texts: pd.Series, updates: pd.Series) -> pd.DataFrame:
    """struct<value,applied>: JSON texts with their map of path to text put in, where the paths exist, and how many were."""
    return _updated(texts, updates, set_path)


def _set_field(tree, key: str, text: str) -> bool:
    if key not in tree:
        return False
    tree[key] = text
    return True


@F.pandas_udf(_UPDATED)
def json_with_fields(texts: pd.Series, updates: pd.Series) -> pd.DataFrame:
    """struct<value,applied>: JSON objects with their map of key to text put in, where the keys exist; keys are no paths."""
    return _updated(texts, updates, _set_field)


def indented(c, spaces: int):
    """JSON texts laid out in lines; null for null."""

    @F.pandas_udf(T.StringType())
    def laid_out(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else json.dumps(json.loads(t), ensure_ascii=False, indent=spaces))

    return laid_out(c)


@F.pandas_udf(T.StructType([T.StructField("head", T.StringType()), T.StructField("tail", T.StringType())]))
def json_around_data(texts: pd.Series) -> pd.DataFrame:
    """struct<head,tail>: JSON objects laid out in lines, up to the first record of their ``data`` and from its end."""
    rows = []
    for t in texts:
        mark = uuid.uuid4().hex
        rows.append(json.dumps(json.loads(t) | {"data": [mark]}, ensure_ascii=False, indent=1).split(f'\n  "{mark}"\n ') if t is not None else (None, None))
    return pd.DataFrame(rows, columns=["head", "tail"])


@F.pandas_udf(T.StringType())
def json_in_data(records: pd.Series) -> pd.Series:
    """JSON records laid out as they stand in a ``data`` list."""
    return records.map(lambda r: None if r is None else "  " + json.dumps(json.loads(r), ensure_ascii=False, indent=1).replace("\n", "\n  "))
