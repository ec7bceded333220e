"""Documents rebuilt from items: script lines, flat JSON, nested JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.jsontree import json_with, json_with_fields
from driftline.functions.script import build_line
from driftline.functions.text import best_text
from driftline.operators.diff import last_wins

_NONE = "map<string,string>"


def line_texts(items: DataFrame) -> DataFrame:
    """(file, line, texts): each line's texts by field, the last of a field."""
    rows = items.withColumn("t", best_text(F.col("cn"), F.col("existing_cn")))
    one = last_wins(rows, ["file", "line", "field"], "ord", "t")
    return one.groupBy("file", "line").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "t")))).alias("texts"))


def rebuilt_lines(lines: DataFrame, items: DataFrame) -> DataFrame:
    """(file, line, text): all lines, those with texts rebuilt. ``sinks.files.write_streamed`` makes files of them."""
    joined = lines.join(line_texts(items), ["file", "line"], "left")
    text = F.when(F.col("texts").isNotNull(), build_line(F.col("text"), F.col("texts"))).otherwise(F.col("text"))
    return joined.select("file", "line", text.alias("text"))


def apply_generic(files: DataFrame, items: DataFrame) -> DataFrame:
    """(file, value, applied): flat JSON with the texts of the items put in, where the key is there and the text isn't empty; how many were."""
    texts = items.withColumn("t", best_text(F.col("cn"), F.col("existing_cn"))).filter("t <> ''")
    got = last_wins(texts, ["file", "field"], "ord", "t").groupBy("file").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "t")))).alias("u"))
    return files.join(got, "file", "left").select("file", json_with_fields("value", F.coalesce("u", F.create_map().cast(_NONE))).alias("x")).select("file", "x.*")


def apply_localization(files: DataFrame, items: DataFrame) -> DataFrame:
    """(file, value, applied): nested JSON with the texts of the items set at existing paths; how many were."""
    texts = items.withColumn("t", best_text(F.col("cn"), F.col("existing_cn"))).filter("t <> ''")
    got = last_wins(texts, ["file", "field"], "ord", "t").groupBy("file").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "t")))).alias("u"))
    return files.join(got, "file", "left").select("file", json_with("value", F.coalesce("u", F.create_map().cast(_NONE))).alias("x")).select("file", "x.*")
