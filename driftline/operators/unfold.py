"""Nested JSON unfolded level by level, in DataFrame functions only, to any depth."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.shared import settings, written

_FAIL = {"mode": "FAILFAST"}
#: Of a key that an object has twice the last value counts, as with Python's reader.
_HELD = {"spark.sql.variant.allowDuplicateKeys": "true"}
_OWN = ("_leaf_doc", "_leaf_path", "_leaf_at", "_leaf_raw", "_leaf_kind")


def _members(raw: Column, kind: Column) -> Column:
    """array<struct<step,raw,kind>> of an object or a list, in order: the path's next step, the text of a string or the JSON text of anything else, and its kind.

    Read twice: as texts, which keep what is nested as it stands with its order, and as variants, which know what each is.
    """
    texts, kinds = F.from_json(raw, "map<string,string>", _FAIL), F.from_json(raw, "map<string,variant>", _FAIL)
    fields = F.zip_with(F.map_entries(texts), F.map_entries(kinds), lambda t, v: F.struct(t["key"].alias("step"), t["value"].alias("raw"), _kind(v["value"]).alias("kind")))
    listed, of_list = F.from_json(raw, "array<string>", _FAIL), F.from_json(raw, "array<variant>", _FAIL)
    places = F.transform(F.arrays_zip(listed.alias("t"), of_list.alias("v")), lambda x, i: F.struct(F.concat(F.lit("["), i.cast("string"), F.lit("]")).alias("step"), x["t"].alias("raw"), _kind(x["v"]).alias("kind")))
    return F.when(kind == "{", fields).otherwise(places)


def _kind(v: Column) -> Column:
    """{ for an object, [ for a list, " for a string, else null."""
    kind = F.schema_of_variant(v)
    return F.when(F.startswith(kind, F.lit("OBJECT")), "{").when(F.startswith(kind, F.lit("ARRAY")), "[").when(kind == "STRING", '"')


def _levels(df: DataFrame, value: str, keep: list[str]) -> list[DataFrame]:
    """The string leaves of each level, written."""
    doc, path, at, raw, kind = _OWN
    one = F.json_array_length(F.concat(F.lit("["), F.col(value), F.lit("]"))) == 1  # the variant's reader ignores what follows a value
    whole = F.when(one, F.parse_json(F.col(value))).otherwise(F.raise_error(F.concat(F.lit("not JSON: "), F.substring(value, 1, 80))).cast("variant"))
    text = F.when(_kind(whole) == '"', F.variant_get(whole, "$", "string")).otherwise(F.col(value))
    first = df.filter(F.col(value).isNotNull()).select(*keep, F.monotonically_increasing_id().alias(doc), F.lit("").alias(path), F.array().cast("array<int>").alias(at), text.alias(raw), _kind(whole).alias(kind))
    level = written(first.filter(F.col(kind).isNotNull()), "unfold")
    found = [level.filter(F.col(kind) == '"')]
    while not (inner := level.filter(F.col(kind) != '"')).isEmpty():
        step = F.col("_leaf_m.step")
        under = F.when((F.col(path) == "") | F.col("_leaf_of_list"), F.concat(path, step)).otherwise(F.concat(path, F.lit("."), step))
        each = inner.select(*keep, doc, path, at, (F.col(kind) == "[").alias("_leaf_of_list"), F.posexplode(_members(F.col(raw), F.col(kind))).alias("_leaf_i", "_leaf_m"))
        level = written(each.select(*keep, doc, under.alias(path), F.concat(at, F.array(F.col("_leaf_i"))).alias(at), F.col("_leaf_m.raw").alias(raw), F.col("_leaf_m.kind").alias(kind)).filter(F.col(kind).isNotNull()), "unfold")
        found.append(level.filter(F.col(kind) == '"'))
    return found


def leaves(df: DataFrame, value: str) -> DataFrame:
    """df's other columns with path and text: a row for each string leaf of the JSON text in ``value``, at paths such as a.b[0].c.

    Each round unfolds one level of all documents and writes what it finds, so the number of rounds is the depth of the deepest. A path that a
    document has twice has the last text in its order. A null value has no leaves; what isn't JSON is an error.
    """
    keep = [c for c in df.columns if c != value]
    if taken := {c.lower() for c in keep} & {*_OWN, "path", "text"}:
        raise ValueError(f"the table has {', '.join(sorted(taken))} already")
    doc, path, at, raw, kind = _OWN
    with settings(df.sparkSession, _HELD):
        found = _levels(df, value, keep)
    every = reduce(DataFrame.unionAll, found)
    last = every.groupBy(doc, path).agg(F.max_by(F.struct(*keep, raw), at).alias("_leaf_last"))
    return last.select(*[F.col("_leaf_last")[c].alias(c) for c in keep], F.col(path).alias("path"), F.col("_leaf_last")[raw].alias("text"))
