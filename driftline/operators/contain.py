"""Which name contains a text: a join on substrings by an index of n-grams, without a nested loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of a gram. Texts up to this length are grams themselves.
GRAM = 3


def grams(text: Column, n: int) -> Column:
    """The distinct substrings of n letters."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n))))


def first_names(texts: DataFrame, names: DataFrame, text_col: str, name_col: str, order: list[str], out: str) -> DataFrame:
    """texts with ``out``: of the non-empty names that contain the text, the first in order (ties: the least name), else null.

    The index has each name under its distinct grams of up to GRAM letters. A text that is no longer is looked up there. A longer
    one is looked up by the rarest of its own grams, so that few names are compared with it; a gram that no name has ends the matter. Each distinct text is
    looked up once. A null text has no name, an empty one the first of all.
    """
    held = names.filter(F.col(name_col) != "").select(F.struct(*order, name_col).alias("o"), F.col(name_col).alias("n")).distinct()
    of_length = [F.when(F.length("n") >= k, grams(F.col("n"), k)).otherwise(F.array().cast("array<string>")) for k in range(1, GRAM + 1)]
    whole = F.concat(F.array(F.lit("")), *of_length)
    least = held.select("o", F.explode(whole).alias("g")).groupBy("g").agg(F.min("o").alias("o"))
    wanted = texts.select(F.col(text_col).alias("t")).filter("t IS NOT NULL").distinct()
    short = wanted.filter(F.length("t") <= GRAM).join(least, F.col("t") == F.col("g")).select("t", "o")

    index = held.filter(F.length("n") >= GRAM).select("o", "n", F.explode(grams(F.col("n"), GRAM)).alias("g"))
    counts = index.groupBy("g").agg(F.count(F.lit(1)).alias("c"))
    own = wanted.filter(F.length("t") > GRAM).select("t", F.explode(grams(F.col("t"), GRAM)).alias("g"))
    rarest = own.join(counts, "g", "left").groupBy("t").agg(F.min_by("g", F.struct(F.coalesce("c", F.lit(0)), "g")).alias("g"))
    long = rarest.join(index, "g").filter(F.contains("n", "t")).groupBy("t").agg(F.min("o").alias("o"))

    found = short.unionAll(long).select(F.col("t").alias("_contained"), F.col("o")[name_col].alias(out))
    return texts.join(found, F.col(text_col) == F.col("_contained"), "left").drop("_contained")
