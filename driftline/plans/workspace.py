"""The stages over files made from the star-schema tables: scripts of conversations, record tables of parts, flat JSON of customers, nested JSON of suppliers, and a service of our own."""

from __future__ import annotations

import contextlib
import io
import json
import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline import app
from driftline.backend import EchoBackend
from driftline.config import LLM_DEFAULTS, PATHS, load_config
from driftline.operators.unfold import leaves
from driftline.shared import measured_broadcasts, scratch
from driftline.sinks import buckets, files, tables
from driftline.sources import documents, manifest, scripts, web
from driftline.streaming.arrivals import Arrivals

NEST = "{{{{{{{{x}}}}}}}}"
NAMES = {"k": "", "u": "the user"}
SIGN = "か"  # a letter of the source script
LOCAL = app.LOCAL


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _json(**columns: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in columns.items()]))


def _lay(rows: DataFrame, name: Column, piece: Column, order: str, between: str, folder: str, before: str = "", after: str = "") -> None:
    """Write files: the pieces of each name in order, streamed."""
    pieces = rows.select(name.alias("file"), F.lit(files.PIECE).alias("part"), F.col(order).cast("long").alias("o"), piece.alias("piece"))
    if before or after:
        ends = F.explode(F.array(*[F.struct(F.lit(k).alias("part"), F.lit(t).alias("piece")) for k, t in ((files.HEAD, before), (files.TAIL, after))]))
        names = pieces.select("file").distinct().select("file", ends.alias("e"))
        pieces = pieces.unionByName(names.select("file", "e.part", F.lit(None).cast("long").alias("o"), "e.piece"))
    files.write_streamed(pieces, folder, ["o"], between=between)


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    """conv, line, role, jp and the file of each turn."""
    c = _table(spark, sf, "conversations")
    from pyspark.sql import Window

    line = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    stem = F.concat(F.when(F.col("conv_id") % 2 == 0, F.lit("adv_dear_hski_")).otherwise(F.lit("adv_event_")), F.col("conv_id").cast("string"), F.lit(".txt"))
    return c.select("conv_id", line.alias("line"), F.coalesce("role", F.lit("")).alias("role"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("jp"), stem.alias("file"))


def lay(spark: SparkSession, sf: str) -> dict:
    """Write all files into a new folder; the configuration of a run there."""
    root = scratch(spark, "workspace")
    paths = {k: f"{root}/{p}" for k, p in PATHS.items()}
    one, two, held = paths["primary"], paths["fallback"], f"{LOCAL}/resource"
    turns = _turns(spark, sf)
    name, jp, line = F.col("role"), F.col("jp"), F.col("line").cast("string")

    def message(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    def script(rows: DataFrame, text: Column, folder: str) -> None:
        _lay(rows, F.col("file"), text, "line", "\n", folder)

    script(turns, message("[message clip=", NEST, " name=", name, " text=", jp, " ]"), f"{paths['scripts']}/{app.SCRIPTS}")
    old = F.when(F.col("line") % 2 == 0, jp).otherwise(F.concat(jp, F.lit("x")))
    wrapped = F.when(F.col("line") % 4 == 0, jp).otherwise(message("<r\\=", old, " >P", line, "</r>"))
    script(turns.filter("conv_id % 3 = 0"), message("[message name=", name, " text=", wrapped, "]"), f"{one}/{held}")
    script(turns.filter("conv_id % 5 = 0"), message("[message name=", name, " text=<r\\=", jp, " >F", line, "</r>]"), f"{two}/{held}")

    part = _table(spark, sf, "part").withColumn("key", F.concat(F.lit("k"), F.col("p_partkey").cast("string"))).withColumn("jp", F.concat(F.lit(SIGN), "p_name")).withColumn("table", F.concat(F.lit("P"), F.regexp_extract("p_brand", "([0-9]+)", 1)))
    record = F.concat(F.lit("- "), _json(id=F.col("key"), name=F.col("jp"), kind=F.col("p_type")))
    _lay(part, F.concat("table", F.lit(".yaml")), record, "p_partkey", "\n", paths["tables"])
    for folder, every, sign in ((one, 2, "P"), (two, 3, "F")):
        some = part.filter(F.col("p_partkey") % every == 0)
        record = _json(kind=F.col("p_type"), id=F.col("key"), name=F.concat(F.lit(sign), "p_brand"), size=F.col("p_size"))
        _lay(some, F.concat("table", F.lit(".json")), record, "p_partkey", ", ", f"{folder}/{LOCAL}/masterTrans", '{"rules": {"primaryKeys": ["id"]}, "data": [', "]}")
    rows = documents.read_tables(spark, paths["tables"])
    keys = rows.select(F.concat_ws(":", F.lit("master"), "table", F.col("rec_idx").cast("string"), F.from_json(F.concat(F.lit('{"v":'), F.col("rec")["id"], F.lit("}")), "v string")["v"], F.lit("name")).alias("uid"), F.regexp_extract(F.col("rec")["id"], "k([0-9]+)", 1).cast("long").alias("p_partkey"))
    seen = part.drop("table").join(keys, "p_partkey").filter("p_partkey % 4 = 0")
    with measured_broadcasts(spark):
        buckets.update_snapshot(spark, f"{paths['work']}/snapshot", seen.select("uid", F.when(F.col("p_partkey") % 8 == 0, F.concat("jp", F.lit("old"))).otherwise(F.col("jp")).alias("jp")))

    customer = _table(spark, sf, "customer").withColumn("file", F.concat(F.lit("n"), F.col("c_nationkey").cast("string"), F.lit(".json")))
    for folder, keep, sign in ((one, "c_nationkey % 5 <> 0", "G"), (two, "c_nationkey % 2 = 0", "F")):
        pair = F.concat(F.lit('"'), F.lit(SIGN), "c_name", F.lit('": "'), F.lit(sign), F.col("c_custkey").cast("string"), F.lit('"'))
        _lay(customer.filter(keep), F.col("file"), pair, "c_custkey", ", ", f"{folder}/{LOCAL}/genericTrans", "{", ', "plain": "x", "かず": 5}')

    supplier = _table(spark, sf, "supplier")
    text = F.concat(F.when(F.col("s_suppkey") % 2 == 0, F.lit(SIGN)).otherwise(F.lit("漢")), "s_name")
    pair = F.concat(F.lit('"k'), F.col("s_suppkey").cast("string"), F.lit('": "'), text, F.lit('"'))
    _lay(supplier, F.lit("localization.json"), pair, "s_suppkey", ", ", f"{one}/{LOCAL}", '{"n": 1, "s": {', "}}")
    _lay(supplier.filter("s_suppkey % 10 = 0"), F.lit("localization.json"), pair, "s_suppkey", "}, {", f"{two}/{LOCAL}", '{"t": [{', "}]}")
    return {"llm": LLM_DEFAULTS | {"backend": "echo", "skip_changed": False}, "paths": paths, "packages": {"use_fallback": True}, "manifest": manifest.ManifestOptions(), "names": NAMES}


def stage_extract(spark: SparkSession, sf: str) -> DataFrame:
    """All items of the four sources with what the packages and the snapshot say."""
    found = app.extract(spark, lay(spark, sf))
    return found.select("uid", "category", "file", "field", "jp", "existing_cn", "status", "speaker", F.col("file_context.character").alias("character"))


def _translated(spark: SparkSession, sf: str) -> tuple[dict, dict]:
    cfg = lay(spark, sf)
    app.extract(spark, cfg)
    return cfg, app.translate(spark, cfg, waits=(), report=lambda said: None)  # the configured backend, which echoes


def stage_translate(spark: SparkSession, sf: str) -> DataFrame:
    cfg, _ = _translated(spark, sf)
    return documents.read_items(spark, f"{cfg['paths']['work']}/translated").select("uid", "cn")


class Unsteady(EchoBackend):
    """Errors without a message for prompts about tables."""

    def translate(self, prompt: str) -> str:
        if "[master:" in prompt:
            raise RuntimeError
        return super().translate(prompt)


def stage_translate_again(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and the last line of progress of a run in which the tables' batches fail, of one after it, whose pending items are theirs, and of one with nothing left."""
    cfg, out = lay(spark, sf), []
    app.extract(spark, cfg)
    for run, kind in enumerate((Unsteady, EchoBackend, EchoBackend)):
        said = [""]
        did = app.translate(spark, cfg, kind, waits=(), report=said.append)
        kept = files.exists(f"{cfg['paths']['work']}/checkpoint")
        out.append((run, *(did[c] for c in ("n_eligible", "n_skipped", "n_pending", "n_answered", "n_batches", "n_failed_batches")), kept, said[-1].split(" | ")[0]))
    return spark.createDataFrame(out, "run int, n_eligible long, n_skipped long, n_pending long, n_answered long, n_batches long, n_failed_batches long, checkpoint_kept boolean, said string")


def stage_build(spark: SparkSession, sf: str) -> DataFrame:
    """What the built package's files hold, read back."""
    cfg, _ = _translated(spark, sf)
    app.build(spark, cfg)
    top = f"{cfg['paths']['output']}/package"
    lines = scripts.read_lines(spark, f"{top}/{LOCAL}/resource").select(F.lit("script").alias("kind"), "file", F.col("line").alias("place"), F.lit("").alias("key"), F.col("text").alias("value"))
    records = documents.package_rows(documents.whole_files(spark, f"{top}/{LOCAL}/masterTrans", "*.json"))
    fields = records.select(F.lit("table"), "table", "rec_idx", F.explode("rec"))
    order = records.select(F.lit("order"), "table", "rec_idx", F.lit(""), F.array_join(F.map_keys("rec"), ","))
    flat = documents.generic_items(app._generic(spark, top)).select(F.lit("flat"), "file", F.lit(0), "field", "existing_cn")
    nested = leaves(documents.whole_files(spark, f"{top}/{LOCAL}", "localization.json").select("value"), "value").select(F.lit("nested"), F.lit("localization.json"), F.lit(0), F.col("path").alias("key"), "text")
    return lines.unionAll(fields).unionAll(order).unionAll(flat).unionAll(nested)


def stage_build_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Files and applied texts by kind, and the snapshot's size after the build."""
    cfg, _ = _translated(spark, sf)
    did = app.build(spark, cfg)
    snapshot = buckets.snapshot(spark, f"{cfg['paths']['work']}/snapshot").count()
    rows = [(k, n) for k, n in did.items() if k != "applied"] + [(f"applied {k}", n) for k, n in did["applied"].items()] + [("snapshot", snapshot)]
    return spark.createDataFrame(rows, "what string, n long")


def stage_package(spark: SparkSession, sf: str) -> DataFrame:
    """The archive's entries in order."""
    cfg, _ = _translated(spark, sf)
    app.build(spark, cfg)
    n = app.package(cfg, spark=spark)
    store, place = files.located(f"{cfg['paths']['output']}/package.zip")
    with store.open_input_file(place) as f, zipfile.ZipFile(f) as z:
        whole = z.testzip() is None  # reads every entry
        rows = ((i, e.filename, e.is_dir(), e.is_dir() or whole, n) for i, e in enumerate(z.infolist()))
        found = tables.handed(spark, rows, "place int, name string, is_dir boolean, whole boolean, n_files int", "entries")
        version = z.read("version.txt").decode()
    if version != files.build_version():
        raise ValueError(version)
    return found


def script_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Scripts that arrive in three parts, each followed by a start of the stream, the last by two: the items, and what the snapshot has."""
    root = scratch(spark, "arrivals")
    turns, folder = _turns(spark, sf), f"{root}/scripts"
    stream = Arrivals(spark, folder, f"{root}/state")
    said = F.concat(F.lit("[message name="), F.col("role"), F.lit(" text="), F.col("jp"), F.lit("]"))
    for part in range(3):
        _lay(turns.filter(F.pmod("conv_id", F.lit(3)) == part), F.col("file"), said, "line", "\n", folder)
        stream.run()
    stream.run()
    kept = stream.snapshot().select(F.lit("snapshot").alias("kind"), "uid", "jp")
    return stream.items().select(F.lit("item").alias("kind"), "uid", "jp").unionAll(kept)


def stage_export(spark: SparkSession, sf: str) -> DataFrame:
    """new.json and changed.json read back, in their order."""
    cfg = lay(spark, sf)
    app.extract(spark, cfg)
    counts = app.export(spark, cfg)
    parts = [documents.read_items(spark, f"{cfg['paths']['work']}/{s}.json").select("uid", "status", F.lit(n).cast("long").alias("n")) for s, n in counts.items()]
    return parts[0].unionAll(parts[1])


def _number(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(number: int, value: int | str | bytes) -> bytes:
    if isinstance(value, int):
        return _number(number << 3) + _number(value)
    value = value.encode() if isinstance(value, str) else value
    return _number(number << 3 | 2) + _number(len(value)) + value


def _service(spark: SparkSession, sf: str, options: manifest.ManifestOptions, down: int | None):
    """Answers for the manifest, its objects, a release and its archive; object numbers that leave ``down`` by 7 fail."""
    nations = _table(spark, sf, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey").collect()  # a small dimension
    regions = _table(spark, sf, "region").select("r_regionkey", "r_name").orderBy("r_regionkey").collect()
    listed = [_field(4, _field(1, r.n_nationkey) + _field(3, f"adv_{r.n_name}.txt") + _field(11, f"o{r.n_nationkey}")) for r in nations]
    listed += [_field(4, _field(3, f"{r.r_name}.bin") + _field(11, f"b{r.r_regionkey}")) for r in regions]
    plain = _field(1, 454) + b"".join(listed) + _field(5, "https://store.example.com/{o}")
    key = F.unhex(F.sha2(F.lit(options.api_key_seed), 256))
    body = bytes(spark.createDataFrame([(bytearray(plain),)], "p binary").select(F.aes_encrypt("p", key, F.lit("CBC"), F.lit("PKCS"), F.unhex(F.lit("0f" * 16)))).first()[0])
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for r in regions:
            z.writestr(f"top/{LOCAL}/resource/{r.r_name}.txt", r.r_name)
    zipped = held.getvalue()

    def answer(url: str, headers: dict | None, timeout: float) -> bytes:
        if url == options.list_url():
            return body
        if url.endswith("/release"):
            return json.dumps({"tag_name": "v7", "assets": [{"browser_download_url": "https://store.example.com/zip"}]}).encode()
        if url.endswith("/zip"):
            return zipped
        number = int(re.fullmatch(r"https://store\.example\.com/o(\d+)", url).group(1))
        if down is not None and number % 7 == down:
            raise OSError("down")
        return f"[title text=x{number}]".encode()

    return answer


def stage_fetch(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs against a service: what is held, logged and indexed, what failed in the first run, and the release's files."""
    root = scratch(spark, "workspace")
    options = manifest.ManifestOptions("https://store.example.com/", 400, "9", "secret", "seed")
    packages = {"primary_api": "https://store.example.com/release", "tables_url": "https://store.example.com/zip", "use_fallback": False, "workers": 4}
    cfg = {"paths": {k: f"{root}/{p}" for k, p in PATHS.items()}, "packages": packages, "manifest": options, "names": {}}
    one = app.fetch(spark, cfg, _service(spark, sf, options, 3))
    log = f"{cfg['paths']['scripts']}/download_log"
    first = spark.createDataFrame(tables.read_pairs(spark, log, "name", "state").collect(), "name string, state string")  # the log is swapped by the second run; a small dimension
    two = app.fetch(spark, cfg, _service(spark, sf, options, None))
    held = web.stored(spark, f"{cfg['paths']['scripts']}/{app.SCRIPTS}").select(F.lit("held").alias("kind"), "name", F.col("n_bytes").cast("string").alias("value"))
    logs = first.select(F.lit("log 1"), "name", "state").unionAll(tables.read_pairs(spark, log, "name", "state").select(F.lit("log 2"), "name", "state"))
    index = json.loads(files.get(f"{cfg['paths']['scripts']}/index.json"))
    said = [("index", r["name"], r["objectName"]) for r in index["resources"]] + [("revision", "", str(index["revision"]))]
    said += [(f"run {i}", k, str(v)) for i, did in enumerate((one, two)) for k, v in did.items()]
    said += [("primary", name, files.get(f"{cfg['paths']['primary']}/{name}").decode()) for name in files.tree(cfg["paths"]["primary"])[1]]
    return held.unionAll(logs).unionAll(spark.createDataFrame(said, "kind string, name string, value string"))


def manifest_sources(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest from the service, its JSON copy and the encrypted cache file: origin, and each resource."""
    root = scratch(spark, "manifest")
    options = manifest.ManifestOptions("https://store.example.com/", 400, "9", "secret", "seed", "00112233445566778899aabbccddeeff", "0f" * 16)
    service, copy, cache = _service(spark, sf, options, None), f"{root}/manifest.json", f"{root}/manifest.bin"

    def down(*_):
        raise OSError("down")

    reply = service(options.list_url(), None, 1)
    plain = spark.createDataFrame([(bytearray(reply),)], "c binary").select(manifest.decrypt_reply(F.col("c"), options.api_key_seed).alias("p"))
    sealed = plain.select(F.aes_encrypt(F.concat(F.unhex(F.lit("63" * 16)), "p"), F.unhex(F.lit(options.cache_key)), F.lit("CBC"), F.lit("PKCS"), F.unhex(F.lit(options.cache_iv)))).first()[0]
    files.put(cache, b"\x01" + bytes(sealed)[16:])
    parts = []
    for fetcher in (down, service, down):  # the cache, then the service, whose JSON copy is kept, then the copy
        found, origin = manifest.load_manifest(spark, options, copy, cache, fetcher)
        parts.append(manifest.resources(found).select(F.lit(origin).alias("origin"), "id", "name", "objectName"))
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def fetched_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Files fetched by the connector's own client, from addresses that hold their content."""
    folder = scratch(spark, "fetched")
    wanted = _table(spark, sf, "nation").select(F.concat("n_name", F.lit(".txt")).alias("name"), F.when(F.col("n_nationkey") % 5 == 0, F.lit("")).otherwise(F.col("n_name")).alias("objectName"))
    tried = spark.createDataFrame(web.fetch(wanted, "data:,{o}", folder, workers=4).collect(), "name string, state string")  # fetched once; a small dimension
    return tried.join(web.stored(spark, folder), "name", "left")


def command_line(spark: SparkSession, sf: str) -> DataFrame:
    """The stages by command: exit codes, what the last run exported, and an unknown stage."""
    from driftline.__main__ import main

    cfg, codes = lay(spark, sf), []
    text = json.dumps({"llm": {"backend": "echo", "skip_changed": False}, "paths": {k: cfg["paths"][k] for k in PATHS}, "character_names": NAMES})  # JSON is YAML
    with tempfile.TemporaryDirectory() as folder, contextlib.redirect_stdout(io.StringIO()) as said, contextlib.redirect_stderr(io.StringIO()):
        config = str(Path(folder, "config.yaml"))
        Path(config).write_text(text, encoding="utf-8")
        for stages in (["extract", "translate", "build", "package"], ["export", "--status", "new"], ["wrong"]):
            try:
                codes.append(main([*stages, "--config", config]))
            except SystemExit as e:
                codes.append(e.code)
    n_new = documents.read_items(spark, f"{cfg['paths']['work']}/new.json").count()
    steps = [x.split(":", 1)[0] for x in said.getvalue().splitlines() if ": " in x]
    made = files.exists(f"{cfg['paths']['output']}/package.zip")
    return spark.createDataFrame([(*codes, ",".join(x for x in steps if x.isalpha()), n_new, made)], "stages int, export int, wrong int, said string, n_new long, made boolean")


def config_values(spark: SparkSession, sf: str) -> DataFrame:
    """A configuration file with an environment's overrides, as keys and values."""
    regions = _table(spark, sf, "region").select("r_regionkey", "r_name").orderBy("r_regionkey").collect()
    names = "".join(f"  k{r.r_regionkey}: {json.dumps(r.r_name)}\n" for r in regions)
    with tempfile.TemporaryDirectory() as folder:  # a configuration is the driver's own local file
        Path(folder, "c.yaml").write_text(f"llm: {{model: m, batch_size: 3}}\npaths: {{output: /abs, tables: 'hdfs://n/t'}}\nmanifest: {{url: u, version: 7, extra: 1}}\ncharacter_names:\n{names}  none: null\n", encoding="utf-8")
        found = load_config(Path(folder, "c.yaml"), {"LLM_BATCH_SIZE": "9", "LLM_BASE_URL": "http://h"})
        rows = [(f"{part}.{k}", str(v)) for part in ("llm", "names") for k, v in found[part].items()]
        rows += [(f"paths.{k}", os.path.relpath(v, Path(folder).resolve()) if v.startswith(str(Path(folder).resolve())) else v) for k, v in found["paths"].items()]
        rows += [("manifest.url", found["manifest"].list_url()), ("manifest.version", found["manifest"].version)]
    return spark.createDataFrame(rows, "key string, value string")


QUERIES = {f.__name__: f for f in (stage_extract, stage_translate, stage_translate_again, stage_build, stage_build_counts, stage_package, script_arrivals, stage_export, stage_fetch, fetched_bytes, command_line, manifest_sources, config_values)}

_JP = "か"
_FILES = f"""t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS line, coalesce(role, '') AS role, sha256(coalesce(text, '')) AS jp, CASE WHEN conv_id % 2 = 0 THEN 'adv_dear_hski_' ELSE 'adv_event_' END || conv_id AS stem FROM conversations),
x AS (SELECT *, CASE WHEN conv_id % 3 = 0 AND line % 4 <> 0 THEN 'P' || line WHEN conv_id % 5 = 0 THEN 'F' || line ELSE '' END AS had, conv_id % 3 = 0 AND line % 4 <> 0 AND line % 2 = 1 AS moved FROM t),
n AS (SELECT *, CASE WHEN strpos('the user', role) > 0 THEN 'the user' ELSE role END AS called FROM t),
k AS (SELECT *, 'P' || regexp_extract(p_brand, '([0-9]+)', 1) AS tab FROM part),
o AS (SELECT *, row_number() OVER (PARTITION BY tab ORDER BY p_partkey) - 1 AS idx, row_number() OVER (PARTITION BY tab, p_partkey % 2 ORDER BY p_partkey) - 1 AS held, row_number() OVER (PARTITION BY tab, p_partkey % 3 = 0 ORDER BY p_partkey) - 1 AS held_two FROM k),
m AS (SELECT tab, idx, held, p_partkey, 'k' || p_partkey AS id, '{_JP}' || p_name AS jp, p_type, p_brand, p_size, CASE WHEN p_partkey % 2 = 0 AND (held = idx OR p_partkey % 3 <> 0 OR held_two <> idx) THEN 'P' || p_brand WHEN p_partkey % 3 = 0 THEN 'F' || p_brand ELSE '' END AS had FROM o),
g AS (SELECT c_custkey, c_nationkey, 'local-files/genericTrans/n' || c_nationkey || '.json' AS file, '{_JP}' || c_name AS jp, CASE WHEN c_nationkey % 5 <> 0 THEN 'G' || c_custkey ELSE 'F' || c_custkey END AS had FROM customer WHERE c_nationkey % 5 <> 0 OR c_nationkey % 2 = 0),
l AS (SELECT s_suppkey, 's.k' || s_suppkey AS path, CASE WHEN s_suppkey % 2 = 0 THEN '{_JP}' ELSE '漢' END || s_name AS jp FROM supplier),
l2 AS (SELECT 't[' || (row_number() OVER (ORDER BY s_suppkey) - 1) || '].k' || s_suppkey AS path, jp, s_suppkey FROM l WHERE s_suppkey % 10 = 0),
i AS (SELECT stem || ':' || line || ':text' AS uid, 'resource' AS category, stem || '.txt' AS file, 'text' AS field, jp || ' ' AS jp, had AS existing_cn, CASE WHEN had = '' THEN 'new' WHEN moved THEN 'changed' ELSE 'existing' END AS status, role AS speaker, CASE WHEN conv_id % 2 = 0 THEN 'hski' ELSE '' END AS "character" FROM x
UNION ALL SELECT stem || ':' || line || ':name', 'resource', stem || '.txt', 'name', role, called, 'existing', NULL, NULL FROM n
UNION ALL SELECT 'master:' || tab || ':' || idx || ':' || id || ':name', 'master', tab || '.json', 'name', jp, had, CASE WHEN had = '' THEN 'new' WHEN p_partkey % 8 = 0 THEN 'changed' ELSE 'existing' END, NULL, NULL FROM m
UNION ALL SELECT 'generic:' || file || ':' || jp, 'generic', file, jp, jp, had, 'existing', NULL, NULL FROM g
UNION ALL SELECT 'localization:' || path, 'localization', 'localization.json', path, jp, jp, CASE WHEN s_suppkey % 2 = 0 THEN 'new' ELSE 'existing' END, NULL, NULL FROM (SELECT path, jp, s_suppkey FROM l UNION ALL SELECT path, jp, s_suppkey FROM l2)),
w AS (SELECT *, CASE WHEN status = 'existing' THEN existing_cn ELSE upper(trim(jp)) END AS cn, CASE WHEN "character" = 'hski' THEN 'r' || file WHEN category = 'master' THEN 'm' || file ELSE category END AS gk FROM i)"""
_BATCHES = "(SELECT coalesce(sum((n + 19) // 20), 0) FROM (SELECT count(*) AS n FROM w WHERE status <> 'existing'{} GROUP BY gk))"
_N = "(SELECT count(*) FROM w WHERE status <> 'existing'{})"
_NOT, _OWN = " AND category <> 'master'", " AND category = 'master'"

ORACLES = {
    "stage_extract": f'WITH {_FILES} SELECT uid, category, file, field, jp, existing_cn, status, speaker, "character" FROM i',
    "stage_translate": f"WITH {_FILES} SELECT uid, cn FROM w",
    "stage_translate_again": f"""WITH {_FILES}, c AS (SELECT CAST({_N.format('')} AS BIGINT) AS a, CAST({_N.format(_NOT)} AS BIGINT) AS b, CAST({_N.format(_OWN)} AS BIGINT) AS d, CAST({_BATCHES.format('')} AS BIGINT) AS e, CAST({_BATCHES.format(_OWN)} AS BIGINT) AS f)
SELECT CAST(0 AS INT) AS run, a AS n_eligible, CAST(0 AS BIGINT) AS n_skipped, a AS n_pending, b AS n_answered, e AS n_batches, f AS n_failed_batches, true AS checkpoint_kept, '[' || e || '/' || e || '] 100.0% ok ' || b || ' failed ' || f AS said FROM c
UNION ALL SELECT 1, a, b, d, d, f, 0, false, '[' || f || '/' || f || '] 100.0% ok ' || d || ' failed 0' FROM c UNION ALL SELECT 2, a, a, 0, 0, 0, 0, false, '' FROM c""",
    "stage_build": rf"""WITH {_FILES} SELECT 'script' AS kind, x.stem || '.txt' AS file, CAST(x.line AS INT) AS place, '' AS key, '[message clip={NEST} name=' || n.called || ' text=<r\=' || x.jp || ' >' || w.cn || '</r>]' AS value FROM x JOIN n ON x.conv_id = n.conv_id AND x.line = n.line JOIN w ON w.uid = x.stem || ':' || x.line || ':text'
UNION ALL SELECT 'table', tab, CAST(held AS INT), unnest(['kind', 'id', 'name', 'size']), unnest(['"' || p_type || '"', '"' || id || '"', '"' || CASE WHEN p_partkey % 8 = 0 THEN upper(jp) ELSE had END || '"', CAST(p_size AS VARCHAR)]) FROM m WHERE p_partkey % 2 = 0
UNION ALL SELECT 'order', tab, CAST(held AS INT), '', 'kind,id,name,size' FROM m WHERE p_partkey % 2 = 0
UNION ALL SELECT 'flat', file, 0, jp, had FROM g WHERE c_nationkey % 5 <> 0
UNION ALL SELECT 'nested', 'localization.json', 0, path, upper(jp) FROM l WHERE s_suppkey % 2 = 0 UNION ALL SELECT 'nested', 'localization.json', 0, path, jp FROM l WHERE s_suppkey % 2 = 1""",
    "stage_build_counts": f"""WITH {_FILES}, r(what, n) AS (SELECT 'scripts', count(DISTINCT conv_id) FROM t UNION ALL SELECT 'tables', count(DISTINCT tab) FROM m UNION ALL SELECT 'flat', count(DISTINCT c_nationkey) FROM g WHERE c_nationkey % 5 <> 0 UNION ALL SELECT 'nested', 1
UNION ALL SELECT 'applied tables', count(*) FROM m WHERE p_partkey % 2 = 0 UNION ALL SELECT 'applied flat', count(*) FROM g WHERE c_nationkey % 5 <> 0 UNION ALL SELECT 'applied nested', count(*) FROM l
UNION ALL SELECT 'snapshot', count(*) FROM m) SELECT what, n FROM r""",
    "stage_package": f"""WITH {_FILES}, e AS (SELECT unnest(['local-files/', 'local-files/genericTrans/', 'local-files/masterTrans/', 'local-files/resource/']) AS name, 0 AS late
UNION ALL SELECT DISTINCT file, 1 FROM g WHERE c_nationkey % 5 <> 0 UNION ALL SELECT DISTINCT 'local-files/masterTrans/' || tab || '.json', 1 FROM m UNION ALL SELECT unnest(['local-files/localization.json', 'version.txt']), 1 UNION ALL SELECT DISTINCT 'local-files/resource/' || stem || '.txt', 1 FROM t)
SELECT CAST(row_number() OVER (ORDER BY late, string_split(name, '/')) - 1 AS INT) AS place, name, late = 0 AS is_dir, true AS whole, CAST(sum(late) OVER () AS INT) AS n_files FROM e""",
    "script_arrivals": f"WITH {_FILES}, a AS (SELECT stem || ':' || line || ':text' AS uid, jp FROM t UNION ALL SELECT stem || ':' || line || ':name', role FROM t) SELECT unnest(['item', 'snapshot']) AS kind, uid, jp FROM a",
    "stage_export": f"WITH {_FILES} SELECT uid, status, count(*) OVER (PARTITION BY status) AS n FROM i WHERE status <> 'existing'",
    "stage_fetch": """WITH n AS (SELECT n_nationkey AS k, 'adv_' || n_name || '.txt' AS name FROM nation)
SELECT 'held' AS kind, name, CAST(length('[title text=x]') + length(CAST(k AS VARCHAR)) AS VARCHAR) AS value FROM n UNION ALL SELECT 'log 1', name, 'ok' FROM n WHERE k % 7 <> 3 UNION ALL SELECT 'log 2', name, 'ok' FROM n
UNION ALL SELECT 'index', name, 'o' || k FROM n UNION ALL SELECT 'index', r_name || '.bin', 'b' || r_regionkey FROM region UNION ALL SELECT 'revision', '', '454' UNION ALL SELECT 'primary', 'local-files/resource/' || r_name || '.txt', r_name FROM region UNION ALL SELECT 'primary', 'version.txt', 'v7'
UNION ALL SELECT 'run ' || r, unnest(['manifest', 'n_eligible', 'n_failed', 'primary', 'tables']), unnest(['service', CAST((SELECT count(*) FROM n) AS VARCHAR), CASE r WHEN 0 THEN CAST((SELECT count(*) FROM n WHERE k % 7 = 3) AS VARCHAR) ELSE '0' END, CASE r WHEN 0 THEN '(''v7'', True)' ELSE '(''v7'', False)' END, 'new']) FROM (SELECT unnest([0, 1]) AS r)""",
    "fetched_bytes": "SELECT n_name || '.txt' AS name, CASE WHEN n_nationkey % 5 = 0 THEN 'empty answer' ELSE 'ok' END AS state, CAST(CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE length(n_name) END AS BIGINT) AS n_bytes FROM nation",
    "command_line": f"WITH {_FILES} SELECT CAST(0 AS INT) AS stages, CAST(0 AS INT) AS export, CAST(2 AS INT) AS wrong, 'extract,translate,build,package,export' AS said, count(*) FILTER (status = 'new') AS n_new, true AS made FROM i",
    "manifest_sources": "SELECT origin, id, name, \"objectName\" FROM (SELECT CAST(n_nationkey AS INT) AS id, 'adv_' || n_name || '.txt' AS name, 'o' || n_nationkey AS \"objectName\" FROM nation UNION ALL SELECT 0, r_name || '.bin', 'b' || r_regionkey FROM region), (SELECT unnest(['cache', 'service', 'json']) AS origin)",
    "config_values": "SELECT 'names.k' || r_regionkey AS key, r_name AS value FROM region UNION ALL SELECT unnest(['names.none', 'llm.backend', 'llm.skip_changed', 'llm.batch_size', 'llm.max_concurrent', 'llm.timeout', 'llm.max_tokens', 'llm.api_version', 'llm.model', 'llm.base_url', 'paths.scripts', 'paths.primary', 'paths.fallback', 'paths.tables', 'paths.work', 'paths.output', 'manifest.url', 'manifest.version']), unnest(['', 'openai', 'True', '9', '5', '180', '4096', '2023-06-01', 'm', 'http://h', 'cache/server', 'cache/primary', 'cache/fallback', 'hdfs://n/t', 'cache', '/abs', 'v2/pub/a/400/v/7/list/0', '7'])",
}
