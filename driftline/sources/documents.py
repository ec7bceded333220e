"""YAML tables, their JSON translations, flat and nested JSON, snapshots, checkpoints and item files."""

from __future__ import annotations

import json

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.text import KANA_CLASS, SOURCE_CLASS, contains_source, looks_like_source, stem
from driftline.operators.unfold import leaves
from driftline.schema import ITEM, MASTER_RECORD
from driftline.shared import written
from driftline.sources import splits


def exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def whole_files(spark: SparkSession, folder: str, pattern: str, recursive: bool = False) -> DataFrame:
    """(path, value); no rows where the folder is missing. A pattern that is a name, unless recursive, is read by itself: Spark's driver would list all below the folder."""
    if not recursive and not set("*?[]{}\\") & set(pattern):
        folder = f"{folder}/{pattern}"
    if not exists(spark, folder):
        return spark.createDataFrame([], "path string, value string")
    found = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).text(folder, wholetext=True)
    return found.select(F.col("_metadata.file_path").alias("path"), "value")


def _loader():
    """YAML 1.2's scalars: only true and false are booleans, no octal by a leading zero, no sexagesimal, no dates."""
    import re

    import yaml

    class Loader(getattr(yaml, "CSafeLoader", yaml.SafeLoader)):
        yaml_implicit_resolvers = {k: [(t, r) for t, r in v if t.rsplit(":", 1)[1] not in ("bool", "int", "timestamp")] for k, v in yaml.SafeLoader.yaml_implicit_resolvers.items()}

    Loader.add_implicit_resolver("tag:yaml.org,2002:bool", re.compile("^(?:true|True|TRUE|false|False|FALSE)$"), list("tTfF"))
    Loader.add_implicit_resolver("tag:yaml.org,2002:int", re.compile("^(?:[-+]?(?:0|[1-9][0-9]*)|0o[0-7]+|0x[0-9a-fA-F]+)$"), list("-+0123456789"))
    return Loader


def table_rows(files: DataFrame) -> DataFrame:
    """YAML files (path, value) -> (table, rec_idx, rec): each record's fields as JSON texts. Files that aren't YAML or hold no list are skipped."""

    def run(batches):
        import yaml

        loader = _loader()
        for batch in batches:
            out = []
            for path, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    records = yaml.load(value, loader)  # noqa: S506  a safe loader
                except yaml.YAMLError:
                    continue
                name = path.rsplit("/", 1)[-1].removesuffix(".yaml")
                out += [(name, i, list({str(k): json.dumps(v, ensure_ascii=False, default=str) for k, v in r.items()}.items())) for i, r in enumerate(records if isinstance(records, list) else []) if isinstance(r, dict)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out]), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.map_(pa.string(), pa.string()))], names=["table", "rec_idx", "rec"])

    return files.mapInArrow(run, f"table string, rec_idx int, rec {MASTER_RECORD}")


def read_tables(spark: SparkSession, folder: str, pattern: str = "*.yaml") -> DataFrame:
    """The rows of ``table_rows`` for a folder's files, which are read by splits and parsed record by record.

    A record begins with a dash at the start of a line. Files that can't be read so (another form than a list, anchors that
    reach over records, several documents) are read whole, as ``table_rows`` reads them.
    """
    if not exists(spark, folder):
        return table_rows(whole_files(spark, folder, pattern))
    lines = splits.read_lines(spark, folder, pattern, mark=F.col("text").rlike(r"^-(?:\s|\z)"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), "\n")
    records = lines.groupBy("path", "marks").agg(joined.alias("value"))  # a row a record

    def run(frames):
        import yaml

        loader = _loader()
        for frame in frames:
            out = []
            for path, marks, value in frame[["path", "marks", "value"]].itertuples(index=False):
                rec, whole = None, False
                rows = value.split("\n")
                if marks == 0:  # what is before the first record
                    whole = any(r.strip() and not r.startswith("#") and (r.strip() != "---") for r in rows) or sum(r.strip() == "---" for r in rows) > 1
                elif any(r.startswith(("---", "...", "%")) for r in rows):
                    whole = True
                else:
                    try:
                        got = yaml.load(value, loader)  # noqa: S506  a safe loader
                        whole = not isinstance(got, list) or len(got) != 1
                        rec = None if whole or not isinstance(got[0], dict) else {str(k): json.dumps(v, ensure_ascii=False, default=str) for k, v in got[0].items()}
                    except yaml.YAMLError:
                        whole = True
                out.append((path, marks - 1, rec, whole))
            yield pd.DataFrame(out, columns=["path", "rec_idx", "rec", "whole"])

    parsed = written(records.mapInPandas(run, f"path string, rec_idx int, rec {MASTER_RECORD}, whole boolean"), "records")
    others = parsed.filter("whole").select("path").distinct()
    name = F.regexp_replace("path", r"\.yaml\z", "")
    kept = parsed.filter("rec IS NOT NULL").join(others, "path", "left_anti").select(name.alias("table"), "rec_idx", "rec")
    decoded = F.url_decode(F.replace(F.element_at(F.split("path", "/"), -1), F.lit("+"), F.lit("%2B")))
    rest = whole_files(spark, folder, pattern).withColumn("path", decoded).join(others, "path", "left_semi")
    return kept.unionByName(table_rows(rest))


def package_rows(files: DataFrame) -> DataFrame:
    """JSON translations (path, value), {rules, data: [record]} -> (table, rec_idx, rec): each record's fields as JSON texts, in their order.

    A file that isn't a JSON object with a list of objects is an error: without it, all items of its table would look new. A file without ``data`` has no records.
    """

    def run(batches):
        for batch in batches:
            out = []
            for table, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    records = json.loads(value).get("data", [])
                    out += [(table, i, [(k, json.dumps(v, ensure_ascii=False)) for k, v in r.items()]) for i, r in enumerate(records)]
                except (AttributeError, TypeError, ValueError) as e:
                    raise ValueError(f"{table}: not a JSON object with a list of records ({e})") from e
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out]), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.map_(pa.string(), pa.string()))], names=["table", "rec_idx", "rec"])

    return files.select(stem(F.col("path")).alias("table"), "value").mapInArrow(run, f"table string, rec_idx int, rec {MASTER_RECORD}")


def generic_items(files: DataFrame, char_class: str = SOURCE_CLASS) -> DataFrame:
    """Flat JSON (rel, value): a row for each text whose key is source text; the key is the source. Other values are left out; broken JSON is an error."""
    each = files.select("rel", F.explode(F.from_json("value", "map<string,variant>", {"mode": "FAILFAST"})).alias("field", "_v"))
    each = each.filter(contains_source(F.col("field"), char_class) & (F.schema_of_variant("_v") == "STRING")).withColumn("existing_cn", F.variant_get("_v", "$", "string"))
    return each.select(F.concat_ws(":", F.lit("generic"), "rel", "field").alias("uid"), F.lit("generic").alias("category"), F.col("rel").alias("file"), "field", F.col("field").alias("jp"), "existing_cn", F.lit("existing").alias("status"))


def localization_items(files: DataFrame, char_class: str = SOURCE_CLASS, kana: str = KANA_CLASS) -> DataFrame:
    """Nested JSON (file, value): a row for each string leaf with source text; new if it still looks like source, else existing."""
    each = leaves(files.select("file", "value"), "value").filter(contains_source(F.col("text"), char_class))
    text = F.col("text")
    return each.select(F.concat_ws(":", F.lit("localization"), "path").alias("uid"), F.lit("localization").alias("category"), "file", F.col("path").alias("field"), text.alias("jp"), text.alias("existing_cn"), F.when(looks_like_source(text, kana), F.lit("new")).otherwise(F.lit("existing")).alias("status"))


def read_map(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """A JSON object file as two columns; no rows where it is missing. For snapshots, old checkpoints and logs."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"{key} string, {value} string")
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias(key, value))


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Items from Parquet or JSON. A JSON file that has an item a line is read by splits, any other as a whole."""
    if not path.endswith(".json"):
        return spark.read.schema(ITEM).parquet(path)
    line = F.regexp_replace(F.trim("value"), r",\s*\z", "")
    lines = spark.read.text(path).select(line.alias("value")).filter("value <> ''")
    one = F.startswith("value", F.lit("{")) & (F.coalesce(F.json_array_length(F.concat(F.lit("["), "value", F.lit("]"))), F.lit(0)) == 1)
    opens = F.col("value").isin("[", "[]")
    n_other, n_opens = lines.agg(F.count_if(~one & ~opens & (F.col("value") != "]")), F.count_if(opens)).first()
    if n_other or n_opens > 1:
        return spark.read.schema(ITEM).option("multiLine", True).json(path)
    return lines.filter(F.startswith("value", F.lit("{"))).select(F.from_json("value", ITEM).alias("item")).select("item.*")
