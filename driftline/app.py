"""The stages from fetched files to a package, each on one session: fetch, extract, translate, build, package, export."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import nullcontext
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.backend import create_backend
from driftline.config import validate_llm
from driftline.functions.jsontree import indented
from driftline.functions.text import content_key, no_text, stem
from driftline.operators import diff, master, rebuild, work
from driftline.operators.ledger import ReplyLedger
from driftline.schema import CATEGORIES, CHECKPOINT, ITEM
from driftline.shared import measured_broadcasts, passing_folders
from driftline.sinks import buckets, files, tables
from driftline.sources import documents, manifest, scripts, web

SCRIPTS, LOCAL = "res_raw", "local-files"
#: Batches between two writes of the checkpoint, and writes of a run at most, beyond which waves are larger: the ledger has what they hold meanwhile.
WAVE, WAVES = 1000, 24


def _tidied(stage: Callable) -> Callable:
    """A stage whose intermediate tables are deleted when it ends; what it returns and leaves lies in the configured folders. Its joins broadcast by measured sizes."""

    @wraps(stage)
    def run(spark: SparkSession, *args, **options):
        with passing_folders(spark), measured_broadcasts(spark):
            return stage(spark, *args, **options)

    return run


def fetch(spark: SparkSession, cfg: dict, fetcher: web.Get = web.get) -> dict:
    """Manifest, scripts and packages brought up to date; what was done."""
    paths, packages = cfg["paths"], cfg["packages"]
    found, origin = manifest.load_manifest(spark, cfg["manifest"], f"{paths['work']}/manifest.json", f"{paths['work']}/manifest.bin", fetcher)
    files.put(f"{paths['scripts']}/index.json", manifest.index_json(found).encode())
    folder, log_path = f"{paths['scripts']}/{SCRIPTS}", f"{paths['scripts']}/download_log"
    wanted = web.eligible(manifest.resources(found))
    log = tables.read_pairs(spark, log_path, "name", "state")
    todo = web.missing(wanted, log, web.stored(spark, folder))
    tried_path = f"{paths['scripts']}/download_tried"
    web.fetch(todo, found.first()["urlFormat"], folder, packages.get("headers"), packages.get("workers", web.WORKERS), fetcher).write.mode("overwrite").parquet(tried_path)
    tried = spark.read.schema("name string, state string").parquet(tried_path)
    tables.write_pairs(web.logged(log, tried), log_path)
    out = {"manifest": origin, "n_eligible": wanted.count(), "n_failed": tried.filter("state <> 'ok'").count()}
    if packages.get("primary_api"):
        out["primary"] = web.refresh_release(packages["primary_api"], paths["primary"], fetcher)
    for name in ("fallback", "tables"):
        if packages.get(f"{name}_url") and (name != "fallback" or packages["use_fallback"]):
            out[name] = web.refresh_archive(packages[f"{name}_url"], paths[name], fetcher) or "new"
    return out


def relative(path, root: str):
    """File URIs relative to a folder, decoded."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    mark = "/" + root.split("://", 1)[-1].strip("/") + "/"
    return F.substring(plain, F.instr(plain, F.lit(mark)) + len(mark), F.length(plain))


def _scripts(spark: SparkSession, folder: str) -> DataFrame:
    if documents.exists(spark, folder):
        return scripts.script_items(spark, folder)
    empty = spark.createDataFrame([], "file string, value string")
    return scripts.items(scripts.numbered(empty)).withColumn("uid", F.lit("")).withColumn("file_context", F.lit(None).cast(ITEM["file_context"].dataType))


def _generic(spark: SparkSession, package: str) -> DataFrame:
    found = documents.whole_files(spark, f"{package}/{LOCAL}/genericTrans", "*.json", recursive=True)
    return found.select(relative(F.col("path"), package).alias("rel"), "value")


def _localization(spark: SparkSession, package: str) -> DataFrame:
    found = documents.whole_files(spark, f"{package}/{LOCAL}", "localization.json")
    return found.select(F.lit("localization.json").alias("file"), "value")


def _master(spark: SparkSession, package: str | None) -> DataFrame:
    if package is None:
        return spark.createDataFrame([], "path string, value string")
    return documents.whole_files(spark, f"{package}/{LOCAL}/masterTrans", "*.json")


@_tidied
def extract(spark: SparkSession, cfg: dict) -> DataFrame:
    """All items with their status, written to the work folder in the order of category, file, place."""
    paths, use_fallback = cfg["paths"], cfg["packages"]["use_fallback"]
    one, two = paths["primary"], paths["fallback"] if use_fallback else None
    server = _scripts(spark, f"{paths['scripts']}/{SCRIPTS}")
    earlier = [_scripts(spark, f"{p}/{LOCAL}/resource") if p else server.limit(0) for p in (one, two)]
    resource = diff.resource_diff(server, *earlier, cfg["names"])
    rows = documents.read_tables(spark, paths["tables"])
    snapshot = buckets.snapshot(spark, f"{paths['work']}/snapshot")
    table_items = master.master_items(rows, *[documents.package_rows(_master(spark, p)) for p in (one, two)], snapshot)
    flat, nested = documents.generic_items(_generic(spark, one)), documents.localization_items(_localization(spark, one))
    if two:
        flat = diff.add_missing(flat, documents.generic_items(_generic(spark, two)))
        nested = diff.add_missing(nested, documents.localization_items(_localization(spark, two)))
    ordered = work.item_table([resource, table_items, flat, nested])
    tables.write_items(ordered, f"{paths['work']}/extract")
    return documents.read_items(spark, f"{paths['work']}/extract")


def progress(done: int, whole: int, ok: int, failed: int, seconds: float) -> str:
    """Batches done, share, texts, failed batches, seconds so far and to go at this rate."""
    rate = done / seconds if seconds > 0 else 0
    return f"[{done}/{whole}] {100 * done / max(whole, 1):.1f}% ok {ok} failed {failed} | {seconds:.0f} s, {rate:.2f} batches a s, {(whole - done) / rate if rate else 0:.0f} s to go"


@_tidied
def translate(spark: SparkSession, cfg: dict, backend: Callable[[], object] | None = None, waits: tuple[int, ...] = work.WAITS, report: Callable[[str], object] = print) -> dict:
    """Pending items answered in waves, each kept in the checkpoint; all items merged. The checkpoint goes once no batch has failed.

    Within a wave each batch's answer is in a ledger before the next is asked for; a run that follows one that ended early begins with them. Results are kept by uid and source text, so that a changed source is pending again. ``report`` gets a line a wave.
    """
    llm, at = cfg["llm"], cfg["paths"]["work"]
    items, skip = documents.read_items(spark, f"{at}/extract"), bool(llm["skip_changed"])
    keyed = items.withColumn("jp_sha", content_key(F.col("jp")))
    checkpoint_path, results_path, prior_path, planned_path = (f"{at}/{n}" for n in ("checkpoint", "results", "translated", "planned"))

    def checkpoint() -> DataFrame:
        return spark.read.schema(CHECKPOINT).parquet(checkpoint_path) if files.exists(checkpoint_path) else spark.createDataFrame([], CHECKPOINT)

    prior = spark.createDataFrame([], CHECKPOINT)
    if files.exists(results_path):
        prior = spark.read.schema(CHECKPOINT).parquet(results_path)
    elif files.exists(prior_path):  # items from elsewhere: a result is a text that isn't merely carried over
        earlier = documents.read_items(spark, prior_path).filter(~no_text(F.col("cn")) & ~F.col("cn").eqNullSafe(F.col("existing_cn")))
        prior = earlier.select("uid", content_key(F.col("jp")).alias("jp_sha"), "cn")
    ledger = ReplyLedger(f"{at}/ledger")
    if files.exists(ledger.folder):  # the last run ended within a wave: what it paid for counts
        ledger.rows(spark).select("uid", "jp_sha", "cn").write.mode("append").parquet(checkpoint_path)
        ledger.clear()
    todo = work.pending(items, work.checkpoint_over_prior(checkpoint(), prior, ["uid", "jp_sha"]), skip)
    n_eligible, n_todo, per_wave = items.filter(work.eligible(skip)).count(), todo.count(), llm["batch_size"] * WAVE
    waves = min(-(-n_todo // per_wave), WAVES)
    batched = work.batches(todo, llm["batch_size"]).withColumn("wave", F.pmod(F.xxhash64("gk", "batch"), F.lit(max(waves, 1))))
    batched.repartition("wave", F.pmod(F.hash("gk", "batch"), F.lit(8))).write.mode("overwrite").partitionBy("wave").parquet(planned_path)  # few files a wave
    if backend is None and (kind := llm["backend"]) != "echo":
        validate_llm(llm)
        options = {"base_url": llm["base_url"], "model": llm["model"], "key": llm["api_key"], "timeout": llm["timeout"]} | ({"max_tokens": llm["max_tokens"], "api_version": llm["api_version"]} if kind == "anthropic" else {})
        create_backend(kind, **options)  # an unknown kind fails here, not in the tasks
    else:
        kind, options = "echo", {}
    make = backend or (lambda: create_backend(kind, **options))
    planned, failed, n_ok, n_batches = spark.read.schema(batched.schema).parquet(planned_path), 0, 0, 0
    whole, began = planned.select("gk", "batch").distinct().count(), time.monotonic()
    for wave in range(waves):
        answers = work.translate(planned.filter(F.col("wave") == wave), make, llm["max_concurrent"], waits=waits, names=cfg["names"], ledger=ledger)
        answers, seen = work.totals(answers)
        answers.filter(~no_text(F.col("cn"))).select("uid", "jp_sha", "cn").write.mode("append").parquet(checkpoint_path)
        ledger.clear()  # the wave's replies are in the checkpoint
        got = seen.get
        n_batches, failed, n_ok = n_batches + got["batches"], failed + got["failed"], n_ok + got["texts"]
        report(progress(n_batches, whole, n_ok, failed, time.monotonic() - began))
    results = work.checkpoint_over_prior(checkpoint(), prior, ["uid", "jp_sha"]).groupBy("uid", "jp_sha").agg(F.max("cn").alias("cn"))
    results.write.mode("overwrite").parquet(f"{results_path}.new")
    files.swap(f"{results_path}.new", results_path)
    valid = spark.read.schema(CHECKPOINT).parquet(results_path).join(keyed.select("uid", "jp_sha"), ["uid", "jp_sha"], "left_semi").select("uid", "cn")
    tables.write_items(work.merge_results(items, valid, skip).select(*[f.name for f in ITEM]), f"{at}/translated.new")
    files.swap(f"{at}/translated.new", prior_path)
    for path in [planned_path] + ([] if failed else [checkpoint_path]):
        files.remove(path)
    return {"n_eligible": n_eligible, "n_skipped": n_eligible - n_todo, "n_pending": n_todo, "n_answered": n_ok, "n_batches": whole, "n_failed_batches": failed}


@_tidied
def build(spark: SparkSession, cfg: dict, package: str = "package") -> dict:
    """The output tree: the primary package overlaid by rebuilt files, finished beside the old one and swapped in; the snapshot follows."""
    paths = cfg["paths"]
    items = documents.read_items(spark, f"{paths['work']}/translated")
    dest, one = f"{paths['output']}/{package}", paths["primary"]
    fresh, out = f"{dest}.new", {}
    files.remove(fresh)
    files.copy_tree(one, fresh, spark)
    of = {c: items.filter(F.col("category") == c) for c in CATEGORIES}

    server, held = f"{paths['scripts']}/{SCRIPTS}", f"{one}/{LOCAL}/resource"
    nothing = spark.createDataFrame([], "file string, line int, text string")
    new, old = (scripts.read_lines(spark, p) if documents.exists(spark, p) else nothing for p in (server, held))
    lines = new.unionByName(old.join(new.select("file").distinct(), "file", "left_anti")).join(of["resource"].select("file").distinct(), "file", "left_semi")
    rebuilt = rebuild.rebuilt_lines(lines, of["resource"].withColumn("existing_cn", F.lit(""))).withColumnRenamed("text", "piece")
    out["scripts"], _ = files.write_totals(files.write_streamed(rebuilt, f"{fresh}/{LOCAL}/resource", ["line"]))

    texts = of["master"].withColumn("table", stem(F.col("file")))
    made = master.package_pieces(_master(spark, one).select(stem(F.col("path")).alias("table"), "value"), texts)
    made = made.withColumn("file", F.concat("table", F.lit(".json")))
    out["tables"], set_tables = files.write_totals(files.write_streamed(made, f"{fresh}/{LOCAL}/masterTrans", ["place"], **master.JOINTS))

    flat = _generic(spark, one).withColumnRenamed("rel", "file").join(of["generic"].select("file").distinct(), "file", "left_semi")
    out["flat"], set_flat = files.write_counted(rebuild.apply_generic(flat, of["generic"]).select("file", indented(F.col("value"), 2).alias("content"), "applied"), fresh)
    nested = rebuild.apply_localization(_localization(spark, one), of["localization"])
    out["nested"], set_nested = files.write_counted(nested.select("file", indented(F.col("value"), 2).alias("content"), "applied"), f"{fresh}/{LOCAL}")
    out["applied"] = {"tables": set_tables, "flat": set_flat, "nested": set_nested}

    buckets.update_snapshot(spark, f"{paths['work']}/snapshot", diff.snapshot_rows(of["master"]))
    files.put(f"{fresh}/version.txt", files.build_version().encode())
    files.swap(fresh, dest)
    return out


def package(cfg: dict, name: str = "package", spark: SparkSession | None = None) -> int:
    """The output tree as an archive beside it, packed by tasks of the session or of the active one, if any; the number of files."""
    source = f"{cfg['paths']['output']}/{name}"
    for needed in (source, f"{source}/version.txt"):
        if not files.exists(needed):
            raise FileNotFoundError(needed)
    spark = spark or SparkSession.getActiveSession()
    with passing_folders(spark) if spark else nullcontext():
        return files.create_package(source, f"{source}.zip", spark=spark)


def export(spark: SparkSession, cfg: dict, status: str | None = None) -> dict[str, int]:
    """new.json and changed.json, or one of them, from the extracted items."""
    at = cfg["paths"]["work"]
    items = documents.read_items(spark, f"{at}/extract")
    return {s: tables.export_items(items, s, f"{at}/{s}.json") for s in ((status,) if status else ("new", "changed"))}
