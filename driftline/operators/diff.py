"""The diff: items against two earlier packages and a snapshot, classified new, existing or changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.text import best_text, first_containing, no_text, normalise_source


def add_missing(primary: DataFrame, fallback: DataFrame, key: str = "uid") -> DataFrame:
    """The primary's rows and those of the fallback whose key it lacks (rule by absence)."""
    return primary.unionByName(fallback.join(primary.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def last_wins(rows: DataFrame, keys: list[str], order: str, *values: str) -> DataFrame:
    """One row a key, the last in order."""
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(order)).alias("_v"))
    return picked.select(*keys, *[F.col("_v")[v].alias(v) for v in values])


def status(existing: Column, old: Column, current: Column, tags: str = "r|em", normalised: bool = True) -> Column:
    """changed: there is a translation of another source; existing: there is one; else new. A null old source changes nothing."""
    differs = (normalise_source(old, tags) != normalise_source(current, tags)) if normalised else (old != current)
    return F.when(~no_text(existing) & F.coalesce(differs, F.lit(False)), F.lit("changed")).when(~no_text(existing), F.lit("existing")).otherwise(F.lit("new"))


def with_speaker(items: DataFrame) -> DataFrame:
    """Text rows get the name of their line's message; a window beats a self join."""
    line = Window.partitionBy("file", "line")
    name = F.max(F.when((F.col("field") == "name") & (F.col("command") == "message"), F.col("jp"))).over(line)
    return items.withColumn("speaker", F.when(F.col("field") == "text", name))


def with_names(items: DataFrame, names: dict[str, str], user: str = "{user}") -> DataFrame:
    """Names are never pending: each is what a package has, else the first known name that contains it, else itself; so is the user's place."""
    is_name = F.col("field") == "name"
    named = best_text(F.col("existing_cn"), first_containing(F.col("jp"), names), F.col("jp"))
    known = F.when(F.col("jp") == user, F.col("jp")).when(is_name, named).otherwise(F.col("existing_cn"))
    return items.withColumn("existing_cn", known).withColumn("status", F.when(is_name | (F.col("jp") == user), F.lit("existing")).otherwise(F.col("status")))


def snapshot_status(items: DataFrame, snapshot: DataFrame) -> DataFrame:
    """items (uid, jp, existing_cn) with their status against the sources of a snapshot (uid, jp)."""
    joined = items.join(snapshot.select("uid", F.col("jp").alias("_old")), "uid", "left")
    return joined.withColumn("status", status(F.col("existing_cn"), F.col("_old"), F.col("jp"), normalised=False)).drop("_old")


def snapshot_rows(items: DataFrame) -> DataFrame:
    """What a build puts into the snapshot: the sources of items with a result. ``sinks.buckets`` keeps them."""
    return items.filter(~no_text(F.col("cn"))).select("uid", "jp")


def snapshot_upsert(old: DataFrame, items: DataFrame) -> DataFrame:
    """The snapshot after a build, as one table: new sources replace older ones."""
    new = snapshot_rows(items)
    return old.select("uid", "jp").join(new, "uid", "left_anti").unionByName(new)


def resource_diff(items: DataFrame, primary: DataFrame, fallback: DataFrame, names: dict[str, str]) -> DataFrame:
    """Script items (file, line, field, jp, ...) against both packages' items, whose jp is the wrapped text."""
    from driftline.functions.wrapper import prior

    keys = ["file", "line", "field"]

    def side(p: DataFrame, name: str) -> DataFrame:
        return last_wins(p, keys, "seq", "jp").withColumnRenamed("jp", name)

    joined = items.join(side(primary, "_p"), keys, "left").join(side(fallback, "_f"), keys, "left")
    # names have no plain translation in packages: only wrapped texts and choices are read
    joined = joined.withColumn("_1", prior(F.col("field"), F.coalesce("_p", F.lit("")), F.col("jp"))).withColumn("_2", prior(F.col("field"), F.coalesce("_f", F.lit("")), F.col("jp")))
    use = F.when((F.col("_1.dst") == "") & F.col("_f").isNotNull(), F.col("_2")).otherwise(F.col("_1"))
    out = joined.withColumn("_u", use).withColumn("existing_cn", F.col("_u.dst")).withColumn("status", status(F.col("_u.dst"), F.col("_u.src"), F.col("jp")))
    out = out.drop("_p", "_f", "_1", "_2", "_u").withColumn("category", F.lit("resource"))
    return with_names(with_speaker(out), names)
