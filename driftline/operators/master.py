"""Record tables: four-level lookup of earlier translations by place and by id, and rebuilding of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.jsontree import json_around_data, json_in_data
from driftline.functions.text import SOURCE_CLASS, best_text, contains_source
from driftline.operators.diff import last_wins, snapshot_status

_NO_ID = ("null", '""', "0", "false", "[]", "{}")  # JSON texts of ids that count as none


def record_fields(rows: DataFrame, char_class: str = SOURCE_CLASS) -> DataFrame:
    """(table, rec_idx, rec) -> a row for each top-level text of two characters or more with source text."""
    has = F.coalesce(F.col("rec")["id"], F.lit('""'))
    each = rows.select("table", "rec_idx", has.alias("id"), (~has.isin(*_NO_ID)).alias("has_id"), F.explode("rec").alias("field", "_json"))
    each = each.filter(F.startswith("_json", F.lit('"'))).withColumn("jp", F.from_json(F.concat(F.lit('{"v":'), "_json", F.lit("}")), "v string")["v"])
    each = each.filter((F.length("jp") >= 2) & contains_source(F.col("jp"), char_class)).drop("_json")
    shown = F.when(F.col("has_id"), F.regexp_replace("id", '^"|"$', "")).otherwise(F.concat(F.lit("_idx"), F.col("rec_idx").cast("string")))
    return each.withColumn("uid", F.concat_ws(":", F.lit("master"), "table", F.col("rec_idx").cast("string"), shown, "field"))


def lookup(fields: DataFrame, primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """existing_cn by priority: primary by place, fallback by place, primary by id, fallback by id.

    A level answers if its record has the field, even an empty one; by place the ids must agree unless there is none. Of
    records that share an id the last counts.
    """
    out = fields
    for name, package in (("p", primary), ("f", fallback)):
        by_place = package.select("table", "rec_idx", F.col("rec").alias(f"_{name}_place"))
        ids = package.withColumn("id", F.coalesce(F.col("rec")["id"], F.lit('""')))
        by_id = last_wins(ids, ["table", "id"], "rec_idx", "rec").withColumnRenamed("rec", f"_{name}_id")
        out = out.join(by_place, ["table", "rec_idx"], "left").join(by_id, ["table", "id"], "left")

    def holds(rec: str):
        return F.coalesce(F.map_contains_key(F.col(rec), F.col("field")), F.lit(False))

    def at_place(rec: str):
        return holds(rec) & (~F.col("has_id") | F.col(rec)["id"].eqNullSafe(F.col("id")))

    found = F.when(at_place("_p_place"), F.col("_p_place")[F.col("field")]).when(at_place("_f_place"), F.col("_f_place")[F.col("field")])
    found = found.when(F.col("has_id") & holds("_p_id"), F.col("_p_id")[F.col("field")]).when(F.col("has_id") & holds("_f_id"), F.col("_f_id")[F.col("field")])
    text = F.when(F.startswith(found, F.lit('"')), F.from_json(F.concat(F.lit('{"v":'), found, F.lit("}")), "v string")["v"]).otherwise(F.when(found.isin(*_NO_ID), F.lit("")).otherwise(found))
    return out.withColumn("existing_cn", F.coalesce(text, F.lit(""))).drop("_p_place", "_f_place", "_p_id", "_f_id")


def master_items(rows: DataFrame, primary: DataFrame, fallback: DataFrame, snapshot: DataFrame, char_class: str = SOURCE_CLASS) -> DataFrame:
    found = snapshot_status(lookup(record_fields(rows, char_class), primary, fallback), snapshot)
    return found.select("uid", F.lit("master").alias("category"), F.concat("table", F.lit(".json")).alias("file"), F.col("id").alias("record_id"), "field", "jp", "existing_cn", "status", "rec_idx")


def apply_updates(records: DataFrame, items: DataFrame, check_id: bool = True) -> DataFrame:
    """records (table, rec_idx, rec) with the items' texts put in, also as new fields; plus ``applied``, the number of fields set.

    An item goes to the record at its place if that has its id or the item has none, else to the last record with its id.
    check_id=False takes the record at its place whatever its id.
    """
    texts = items.select("table", "rec_idx", "record_id", "field", best_text(F.col("cn"), F.col("existing_cn")).alias("t")).filter("t <> ''")
    json_text = F.to_json(F.struct(F.col("t").alias("v")))
    texts = texts.withColumn("t", F.substring(json_text, F.lit(6), F.length(json_text) - 6))
    own = records.select("table", "rec_idx", F.coalesce(F.col("rec")["id"], F.lit('""')).alias("_id"))
    by_id = own.filter(~F.col("_id").isin(*_NO_ID)).groupBy("table", F.col("_id").alias("record_id")).agg(F.max("rec_idx").alias("_last"))
    found = texts.join(own, ["table", "rec_idx"], "left").join(by_id, ["table", "record_id"], "left")
    agrees = F.col("_id").isNotNull() & (F.lit(not check_id) | F.col("record_id").isin(*_NO_ID) | (F.col("record_id") == F.col("_id")))
    aimed = found.withColumn("to", F.when(agrees, F.col("rec_idx")).otherwise(F.col("_last"))).filter("to IS NOT NULL")
    one = last_wins(aimed, ["table", "to", "field"], "rec_idx", "t")
    updates = one.groupBy("table", F.col("to").alias("rec_idx")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "t")))).alias("_u"))
    out = records.join(updates, ["table", "rec_idx"], "left").withColumn("_u", F.coalesce("_u", F.create_map().cast("map<string,string>")))
    merged = F.transform_values("rec", lambda k, v: F.coalesce(F.try_element_at(F.col("_u"), k), v))
    added = F.map_filter("_u", lambda k, v: ~F.map_contains_key(F.col("rec"), k))
    return out.withColumn("applied", F.size("_u")).withColumn("rec", F.map_concat(merged, added)).drop("_u")


def _record_json(rec: Column, raw: bool) -> Column:
    """A map as a JSON object; raw: its values are JSON texts already."""

    def quoted(c: Column) -> Column:
        text = F.to_json(F.struct(c.alias("v")))
        return F.substring(text, F.lit(6), F.length(text) - 6)

    fields = F.transform(F.map_entries(rec), lambda e: F.concat(quoted(e["key"]), F.lit(":"), e["value"] if raw else quoted(e["value"])))
    return F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}"))


def package_pieces(files: DataFrame, items: DataFrame, check_id: bool = True) -> DataFrame:
    """(table, part, place, piece, applied): heads, records and tails of the files (table, value) that items change, and of tables that had none.

    ``JOINTS`` go between them; ``sinks.files.write_streamed`` makes files of them, laid out in lines, without holding a table whole.
    """
    from driftline.sources.documents import package_rows

    touched = files.join(items.select("table").distinct(), "table", "left_semi")
    records = apply_updates(package_rows(touched.withColumnRenamed("table", "path")), items, check_id)
    fresh = new_table(items.join(files.select("table"), "table", "left_anti")).withColumn("applied", F.size("fields"))
    whole = F.concat(F.lit('{"id":'), F.col("record_id"), F.when(F.size("fields") > 0, F.concat(F.lit(","), F.substring(_record_json(F.col("fields"), False), F.lit(2), F.lit(2**31 - 1)))).otherwise(F.lit("}")))
    pieces = records.select("table", F.col("rec_idx").cast("long").alias("place"), _record_json(F.col("rec"), True).alias("r"), "applied")
    pieces = pieces.unionByName(fresh.select("table", F.col("first").cast("long").alias("place"), whole.alias("r"), "applied"))
    own = touched.join(records.select("table").distinct(), "table", "left_semi").select("table", "value")
    own = own.unionByName(fresh.select("table").distinct().withColumn("value", F.lit('{"rules":{"primaryKeys":["id"]},"data":[]}')))
    ends = own.select("table", json_around_data("value").alias("x"))
    around = ends.select("table", F.explode(F.array(F.struct(F.lit(0).alias("part"), F.col("x.head").alias("piece")), F.struct(F.lit(2).alias("part"), F.col("x.tail").alias("piece")))).alias("e"))
    nothing = F.lit(None).cast("long").alias("place")
    return pieces.select("table", F.lit(1).alias("part"), "place", json_in_data("r").alias("piece"), "applied").unionByName(around.select("table", "e.part", nothing, "e.piece", F.lit(0).alias("applied")))


#: Between the parts of a package file: before the first record, between two, after the last.
JOINTS = {"first": "\n", "between": ",\n", "last": "\n "}


def new_table(items: DataFrame) -> DataFrame:
    """(table, record_id, fields, first): records of a table that no package has; items without text or id are left out."""
    text = best_text(F.col("cn"), F.col("existing_cn"))
    kept = items.withColumn("t", text).filter((F.col("t") != "") & ~F.col("record_id").isin(*_NO_ID))
    one = last_wins(kept, ["table", "record_id", "field"], "rec_idx", "t")
    found = one.groupBy("table", "record_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "t")))).alias("fields"))
    return found.join(kept.groupBy("table", "record_id").agg(F.min("rec_idx").alias("first")), ["table", "record_id"])
