"""Script files: a row a line, a row an item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions import script
from driftline.functions.text import lines, stem
from driftline.sources import splits


def read_lines(spark: SparkSession, folder: str, pattern: str = "adv_*.txt") -> DataFrame:
    """(file, line, text), lines from 1; files of any size, read by splits."""
    return splits.read_lines(spark, folder, pattern).select("file", "line", "text")


def numbered(files: DataFrame) -> DataFrame:
    """The same of texts (file, value) that are in a table."""
    return files.select("file", F.posexplode(lines(F.col("value"))).alias("pos", "text")).select("file", (F.col("pos") + 1).alias("line"), "text")


def items(rows: DataFrame) -> DataFrame:
    """(file, line, text) -> (file, line, command, field, jp, seq): the text, the name or the choices of command lines."""
    parsed = rows.filter(script.is_command(F.col("text"))).select("file", "line", script.command(F.col("text")).alias("command"), script.body(F.col("text")).alias("body"))
    parsed = parsed.withColumn("kv", script.pairs(F.col("body")))
    text, name = script.value(F.col("kv"), "text"), script.value(F.col("kv"), "name")
    spoken = F.col("command").isin("message", "narration", "title")

    def entry(field, jp):
        return F.struct(field.alias("field"), jp.alias("jp"))

    plain = F.array_compact(F.array(F.when(spoken & text.isNotNull(), entry(F.lit("text"), text)), F.when((F.col("command") == "message") & name.isNotNull(), entry(F.lit("name"), name))))
    listed = F.transform(script.choices(F.col("body")), lambda t, i: entry(F.concat(F.lit("text["), i.cast("string"), F.lit("]")), t))
    found = F.when(F.col("command") == "choicegroup", listed).otherwise(plain)
    out = parsed.select("file", "line", F.when(F.col("command") == "choicegroup", F.lit("choice")).otherwise(F.col("command")).alias("command"), F.posexplode(found).alias("seq", "e"))
    return out.select("file", "line", "command", "e.field", "e.jp", "seq")


def script_items(spark: SparkSession, folder: str, pattern: str = "adv_*.txt") -> DataFrame:
    """Items with uid and context, in the order of file, line, seq."""
    return with_uids(items(read_lines(spark, folder, pattern)))


def with_uids(found: DataFrame) -> DataFrame:
    """Items (file, line, field, ...) with uid and file_context."""
    name = stem(F.col("file"))
    return found.withColumn("uid", F.concat_ws(":", name, F.col("line").cast("string"), "field")).withColumn("file_context", F.when(F.col("field") == "text", script.context_of(name)))
