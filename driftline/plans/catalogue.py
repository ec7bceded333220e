"""The operators as queries over the star-schema tables, each with DuckDB SQL for the same rows."""

from __future__ import annotations

import contextlib
import json
import os
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.backend import ChatBackend, EchoBackend, MessagesBackend
from driftline.functions import script, text
from driftline.functions.jsontree import json_with
from driftline.functions.wrapper import prior, split_wrapped
from driftline.operators import contain, diff, master, rebuild, unfold, work
from driftline.operators.ledger import ReplyLedger
from driftline.plans import workspace
from driftline.shared import scratch, written
from driftline.sinks import files, tables
from driftline.sinks.buckets import BucketTable
from driftline.sources import documents, manifest, scripts, web

ACCENTS = r"[À-ÿ]"
#: Calls to a batch function under way at a time.
CALLS = 64
LABELS = {"1-": "first", "2-": "second", "3-": "third"}
#: Moves places from 0 on below 0, in their order: no table has so many rows that moved ones meet others.
ELSEWHERE = -(2**31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _packages(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents as current items; a primary package with every third, half of them of another source; a fallback with every fifth."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("uid"), "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("jp"))
    one = docs.filter(F.col("doc_id") % 3 == 0).select("uid", F.when(F.col("doc_id") % 6 == 0, F.concat("jp", F.lit("x"))).otherwise(F.col("jp")).alias("src"), F.when(F.col("doc_id") % 9 == 0, F.lit("")).otherwise(F.concat(F.lit("p"), "uid")).alias("value"))
    two = docs.filter(F.col("doc_id") % 5 == 0).select("uid", F.col("jp").alias("src"), F.concat(F.lit("f"), "uid").alias("value"))
    return docs, one, two


def _scripts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same as lines of scripts: a document is a file of one message, whose text a package has in the wrapper."""
    docs, one, two = _packages(spark, sf)
    place = [F.lit(1).alias("line"), F.lit("message").alias("command"), F.lit("text").alias("field"), F.lit(0).alias("seq")]
    packages = [p.select(F.col("uid").alias("file"), *place, F.concat(F.lit("<r\\="), "src", F.lit(">"), "value", F.lit("</r>")).alias("jp")) for p in (one, two)]
    return docs.select("uid", F.col("uid").alias("file"), *place, "jp"), *packages


def status_items(spark: SparkSession, sf: str) -> DataFrame:
    return diff.resource_diff(*_scripts(spark, sf), {}).select("uid", "existing_cn", "status")


def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return status_items(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def fallback_union(spark: SparkSession, sf: str) -> DataFrame:
    _, one, two = _packages(spark, sf)
    return diff.add_missing(one.select("uid", "value"), two.select("uid", "value"))


def fallback_by_emptiness(spark: SparkSession, sf: str) -> DataFrame:
    return diff.resource_diff(*_scripts(spark, sf), {}).select("uid", F.col("existing_cn").alias("value"))


def fallback_by_presence(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as records with an id; the primary has them at their places, the fallback elsewhere. A field that is there counts, even an empty one."""
    docs, one, two = _packages(spark, sf)

    def records(rows: DataFrame, t, moved: int) -> DataFrame:
        key = F.concat(F.lit('"d'), "uid", F.lit('"'))
        return rows.select(F.lit("doc").alias("table"), (F.col("uid").cast("int") + F.lit(moved)).alias("rec_idx"), F.create_map(F.lit("id"), key, F.lit("t"), F.concat(F.lit('"'), t, F.lit('"'))).alias("rec"))

    fields = master.record_fields(records(docs, F.concat(F.lit("か"), "uid"), 0)).filter("field = 't'")
    found = master.lookup(fields, records(one, F.col("value"), 0), records(two, F.col("value"), ELSEWHERE))
    return found.select(F.regexp_extract("id", "d(.*)\"", 1).alias("uid"), F.col("existing_cn").alias("value"))


def pending_items(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("uid")).distinct()
    return work.pending(status_items(spark, sf), done, by_source=False).select("uid", "status")


def pending_by_source(spark: SparkSession, sf: str) -> DataFrame:
    docs, one, _ = _packages(spark, sf)
    items = docs.withColumn("status", F.lit("new"))
    return work.pending(items, one.select("uid", text.content_key(F.col("src")).alias("jp_sha"))).select("uid")


def checkpoint_precedence(spark: SparkSession, sf: str) -> DataFrame:
    _, one, two = _packages(spark, sf)
    return work.checkpoint_over_prior(two.select("uid", F.col("value").alias("cn")), one.select("uid", F.col("value").alias("cn")))


def snapshot_changed(spark: SparkSession, sf: str) -> DataFrame:
    docs, one, two = _packages(spark, sf)
    items = docs.join(two.select("uid", F.col("value").alias("existing_cn")), "uid", "left")
    return diff.snapshot_status(items, one.select("uid", F.col("src").alias("jp"))).select("uid", "status")


def snapshot_upsert(spark: SparkSession, sf: str) -> DataFrame:
    docs, one, two = _packages(spark, sf)
    return diff.snapshot_upsert(one.select("uid", F.col("src").alias("jp")), docs.join(two.select("uid", F.col("value").alias("cn")), "uid", "left"))


def snapshot_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot of all documents after an update of every seventh, one of every hundredth with new ids, and one of nothing: what each wrote, and what is read after the last."""
    docs, *_ = _packages(spark, sf)
    kept = BucketTable(spark, scratch(spark, "snapshot"), buckets=16, most=2)
    seventh = docs.filter("doc_id % 7 = 0").select("uid", F.concat(F.lit("a"), "jp").alias("jp"))
    hundredth = docs.filter("doc_id % 100 = 0").select(F.explode(F.array("uid", F.concat(F.lit("n"), "uid"))).alias("uid"), F.concat(F.lit("b"), "jp").alias("jp"))
    did = [kept.upsert(rows) for rows in (docs.select("uid", "jp"), seventh, hundredth, docs.limit(0).select("uid", "jp"))]
    wrote = spark.createDataFrame([(f"version {d['version']}", str(d["rows"])) for d in did], "uid string, jp string")
    return kept.read().unionAll(wrote)


def dup_id_index_join(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as records whose ids (names) repeat; the primary has the even places, the fallback all of them under other places."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    rec = F.create_map(F.lit("id"), F.to_json(F.struct("p_name")).substr(F.lit(11), F.length("p_name") + 2), F.lit("name"), F.concat(F.lit('"'), "p_type", F.lit('"')))
    rows = parts.select(F.lit("part").alias("table"), F.col("p_partkey").cast("int").alias("rec_idx"), rec.alias("rec"), "p_brand")
    brand = F.map_concat(F.map_filter("rec", lambda k, v: k == "id"), F.create_map(F.lit("name"), F.concat(F.lit('"'), "p_brand", F.lit('"'))))
    one = rows.filter("rec_idx % 2 = 0").select("table", "rec_idx", brand.alias("rec"))
    two = rows.select("table", (F.col("rec_idx") + F.lit(ELSEWHERE)).alias("rec_idx"), brand.alias("rec"))
    found = master.lookup(master.record_fields(rows.select("table", "rec_idx", "rec"), ".").filter("field = 'name'"), one, two)
    return found.select("uid", "rec_idx", "jp", "existing_cn")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("file"), F.col("text").alias("value"))


def script_lines(spark: SparkSession, sf: str) -> DataFrame:
    return scripts.numbered(_documents(spark, sf))


#: Signs of scripts and of the wrapper, and letters that stand for them.
SIGNS, PLAIN = ("=[]{}", "＝［］｛｝"), ("<>\\\r", "‹›＼ ")


def _turns(spark: SparkSession, sf: str, escape: bool) -> DataFrame:
    """All conversation turns, nulls as empty texts. escape: signs of scripts are other letters, so that SQL can follow; tests/test_catalogue.py holds them as they are against brute force."""
    turns = table(spark, sf, "conversations")
    said = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), r"\r\n|\r|\n", r"\\n"), r"[^\x20-\x{10FFFF}]", " "))
    plain = lambda c: F.translate(c, *SIGNS) if escape else c
    return turns.select(F.col("conv_id").cast("string").alias("file"), (F.col("turn") + 1).cast("int").alias("line"), plain(F.coalesce("role", F.lit(""))).alias("role"), plain(said).alias("said"))


def _turn_lines(spark: SparkSession, sf: str, escape: bool) -> DataFrame:
    return _turns(spark, sf, escape).select("file", "line", F.concat(F.lit("[message text="), "said", F.lit(" name="), "role", F.lit("]")).alias("text"))


def command_parse(spark: SparkSession, sf: str, escape: bool = True) -> DataFrame:
    return scripts.items(_turn_lines(spark, sf, escape)).select("file", "line", "command", "field", "jp")


def choice_indexed(spark: SparkSession, sf: str, escape: bool = True) -> DataFrame:
    lines_ = _turns(spark, sf, escape).select("file", "line", F.concat(F.lit("[choicegroup choices=[choice text="), "said", F.lit("] choices=[choice text="), "role", F.lit("]]")).alias("text"))
    return scripts.items(lines_).select("file", "line", "command", "field", "jp")


def speaker_for_text(spark: SparkSession, sf: str, escape: bool = True) -> DataFrame:
    return diff.with_speaker(scripts.items(_turn_lines(spark, sf, escape))).filter("field = 'text'").select("file", "line", "jp", "speaker")


def _work(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("uid"), "conv_id", "turn", "role", F.sha2(F.coalesce("text", F.lit("")), 256).alias("jp"))
    context = F.struct(F.lit("dear").alias("story_type"), F.when(F.col("conv_id") % 2 == 0, F.col("role")).alias("character"), F.col("conv_id").cast("string").alias("chapter"))
    return turns.select("uid", F.when(F.col("conv_id") % 5 == 0, F.lit("master")).otherwise(F.lit("resource")).alias("category"), F.col("conv_id").cast("string").alias("file"), F.col("turn").cast("int").alias("line"), "jp", F.when(F.col("turn") % 2 == 0, F.col("role")).alias("speaker"), context.alias("file_context"), (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"), F.lit("new").alias("status"), F.lit("").alias("existing_cn"), F.lit(None).cast("string").alias("cn"))


def batch_plan(spark: SparkSession, sf: str) -> DataFrame:
    return work.batches(_work(spark, sf), 3).select("uid", "gk", "pos", "batch")


def batch_prompt(spark: SparkSession, sf: str) -> DataFrame:
    return work.prompts(work.batches(_work(spark, sf), 3)).select("gk", "batch", F.sha2("prompt", 256).alias("prompt_sha256"), F.size("uids").cast("long").alias("n"))


class Replies(EchoBackend):
    """In reverse order of the items with their uids, or by position, as the first uid's turn is even or odd."""

    def translate(self, prompt: str) -> str:
        uids = re.findall(r"^\[(\d+:\d+)\] ", prompt, re.M)
        if int(uids[0].split(":")[1]) % 2 == 0:
            return "\n---\n".join(f"[{u}]  t{u} " for u in reversed(uids))
        return "\n --- \n".join(f"t{u}" for u in uids)


def response_parse(spark: SparkSession, sf: str) -> DataFrame:
    return work.translate(work.batches(_work(spark, sf), 3), Replies, CALLS, waits=()).select("uid", "cn")


class Failing(EchoBackend):
    """An error without a message where a conversation's number is a multiple of 7, and a text too few where it is one more."""

    def translate(self, prompt: str) -> str:
        left = {int(u) % 7 for u in re.findall(r"^\[(\d+):", prompt, re.M)}
        if 0 in left:
            raise RuntimeError
        reply = super().translate(prompt)
        return reply.rsplit("[", 1)[0] if 1 in left else reply


def failed_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that fails has no texts and says why."""
    got = work.translate(work.batches(_work(spark, sf), 3), Failing, CALLS, waits=())
    return got.select("uid", "cn", F.regexp_replace("error", r"^\d+ of \d+", "some").alias("error"))


class Dying(EchoBackend):
    """Takes its worker down where a conversation's number is a multiple of 50: the executor is lost with what it had in memory."""

    def translate(self, prompt: str) -> str:
        if any(int(u) % 50 == 0 for u in re.findall(r"^\[(\d+):", prompt, re.M)):
            os._exit(3)
        return super().translate(prompt)


def batch_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """A run that dies among its batches, and one after it: each text, and how often its batch was paid for in both."""
    ledger = ReplyLedger(scratch(spark, "ledger"))
    planned = written(work.batches(_work(spark, sf), 3), "planned")
    with contextlib.suppress(Exception):
        work.translate(planned, Dying, CALLS, waits=(), ledger=ledger).write.format("noop").mode("overwrite").save()
    answers = written(work.translate(planned, EchoBackend, CALLS, waits=(), ledger=ledger), "answers")
    paid = ledger.rows(spark).groupBy("uid").agg(F.count(F.lit(1)).alias("n_paid"))
    return answers.join(paid, "uid").select("uid", "cn", "n_paid")


def translate_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Batches, failed ones and texts, counted while the answers are written."""
    answers, seen = work.totals(work.translate(work.batches(_work(spark, sf), 3), Failing, CALLS, waits=()))
    answers.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(seen.get[c] for c in ("batches", "failed", "texts"))], "n_batches long, n_failed long, n_texts long")


def reply_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Replies of both message services, with and without a text, read as the backends read them."""
    said = F.sha2(F.coalesce("text", F.lit("")), 256)
    block = lambda kind, **c: F.struct(F.lit(kind).alias("type"), *[v.alias(k) for k, v in c.items()])
    chat = lambda c: F.to_json(F.struct(F.array(F.struct(F.struct(c.alias("content")).alias("message"))).alias("choices")))
    kinds = F.array(chat(said), F.lit('{"choices":[]}'), chat(F.lit(None).cast("string")), F.to_json(F.struct(F.array(block("tool_use", text=F.lit(None).cast("string")), block("text", text=said)).alias("content"))), F.lit('{"content":[{"type":"tool_use"}]}'), F.lit("{}"))
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.get(kinds, F.pmod(F.col("conv_id") + F.col("turn"), F.lit(6)).cast("int")).alias("reply"), F.pmod(F.col("conv_id") + F.col("turn"), F.lit(6)).alias("k"))

    def read(frames):
        for frame in frames:
            out = []
            for reply, k in zip(frame["reply"], frame["k"], strict=True):
                try:
                    out.append((ChatBackend if k < 3 else MessagesBackend).text(json.loads(reply)))
                except ValueError as e:
                    out.append(f"error: {str(e).split(':')[0]}")
            yield frame[["conv_id", "turn"]].assign(said=out)

    return rows.mapInPandas(read, "conv_id long, turn long, said string")


def translate_merge(spark: SparkSession, sf: str) -> DataFrame:
    items = _work(spark, sf).withColumn("status", F.when(F.col("line") == 0, F.lit("existing")).otherwise(F.lit("new"))).withColumn("existing_cn", F.when(F.col("line") == 0, F.lit("old")).otherwise(F.lit("")))
    got = work.translate(work.batches(items.filter(work.eligible()), 20), EchoBackend, CALLS, waits=())
    return work.merge_results(items, got).select("uid", "cn")


def source_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.sha2(text.normalise_source(F.col("html"), "b|p"), 256).alias("plain_sha256"))


def source_equal(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", text.sources_equal(F.col("html"), F.regexp_replace("html", "</?b>", ""), "b|p").alias("same"), text.sources_equal(F.col("html"), F.col("url"), "b|p").alias("other"))


def hashtag_kana_filter(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", text.contains_source(F.col("text"), ACCENTS).alias("has"), text.looks_like_source(F.col("text"), ACCENTS).alias("looks"))


def _pairs(spark: SparkSession, sf: str, escape: bool) -> DataFrame:
    """All documents, nulls as empty texts. escape: as in ``_turns``, of the wrapper's signs."""
    plain = lambda c: F.translate(c, *PLAIN) if escape else c
    docs = table(spark, sf, "documents").withColumn("text", plain(F.coalesce("text", F.lit("")))).withColumn("lang", plain(F.coalesce("lang", F.lit(""))))
    return docs.select("doc_id", F.replace("text", F.lit("\n"), F.lit("\\n")).alias("s"), F.replace(F.upper("lang"), F.lit("\n"), F.lit("\\n")).alias("lang"), F.size(F.split("text", "\n", -1)).alias("n")).withColumn("t", F.array_join(F.transform(F.split("s", r"\\n", -1), lambda x: F.concat(F.col("lang"), F.length(x).cast("string"))), "\\n"))


def wrap_multiline(spark: SparkSession, sf: str, escape: bool = True) -> DataFrame:
    return _pairs(spark, sf, escape).select("doc_id", F.sha2(text.wrap(F.col("s"), F.col("t")), 256).alias("wrapped_sha256"))


def split_wrapped_back(spark: SparkSession, sf: str, escape: bool = True) -> DataFrame:
    both = _pairs(spark, sf, escape).select("doc_id", split_wrapped(text.wrap(F.col("s"), F.col("t"))).alias("x"))
    return both.select("doc_id", F.sha2("x.src", 256).alias("src_sha256"), F.col("x.dst").alias("dst"))


def first_name_match(spark: SparkSession, sf: str) -> DataFrame:
    """The first nation, by key, whose name contains a two-letter piece of each region's name."""
    regions = table(spark, sf, "region").withColumn("piece", F.substring("r_name", 2, 2))
    return contain.first_names(regions, table(spark, sf, "nation"), "piece", "n_name", ["n_nationkey"], "found").select("r_regionkey", F.col("found").alias("n_name"))


def first_container(spark: SparkSession, sf: str) -> DataFrame:
    """For pieces of parts' names of no to nine letters, the first part whose name contains them."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    pieces = parts.select("p_partkey", F.substring("p_name", F.lit(2), (F.col("p_partkey") % 10).cast("int")).alias("piece"))
    return contain.first_names(pieces, parts.withColumnRenamed("p_partkey", "at"), "piece", "p_name", ["at"], "name")


def context_from_stem(spark: SparkSession, sf: str) -> DataFrame:
    keys = F.array(*[F.lit(k) for k in ("hski", "ttmr", "none")])
    parts = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("adv_"), F.lower("p_brand"), F.lit("_"), F.get(keys, (F.col("p_partkey") % 3).cast("int")), F.lit("-"), F.col("p_size").cast("string")).alias("stem"))
    return parts.select("p_partkey", script.context_of(F.col("stem")).alias("c")).select("p_partkey", "c.*")


def prefix_label(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", text.first_prefix(F.col("o_orderpriority"), LABELS).alias("label"))


def json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    nested = F.to_json(F.struct("conv_id", F.struct("role", F.array("text", "role").alias("said")).alias("turn")))
    trees = table(spark, sf, "conversations").select("conv_id", F.col("turn").alias("k"), nested.alias("tree"))
    return unfold.leaves(trees, "tree").select("conv_id", "k", "path", F.sha2("text", 256).alias("text_sha256"))


def json_path_set(spark: SparkSession, sf: str) -> DataFrame:
    tree = F.to_json(F.struct("event_type", F.struct(F.array("event_type").alias("l")).alias("n")))
    update = F.create_map(F.lit("n.l[0]"), F.col("user_id").cast("string"), F.lit("missing"), F.lit("x"))
    return table(spark, sf, "events").select("event_id", json_with(tree, update)["value"].alias("tree"))


def generic_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as a flat JSON file; keys with an accent are sources, and values other than texts are left out."""
    value = F.to_json(F.struct(F.col("event_type").alias("é"), F.col("user_id").cast("string").alias("à b"), F.col("event_type").alias("plain"), F.col("value").alias("ü")))
    flat = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("rel"), value.alias("value"))
    return documents.generic_items(flat, ACCENTS).select("uid", "file", "field", "jp", "existing_cn", "status")


def localization_leaves(spark: SparkSession, sf: str) -> DataFrame:
    """Each turn as a nested JSON file, French being the source."""
    nested = F.to_json(F.struct(F.struct("role", F.array(F.sha2(F.coalesce("text", F.lit("")), 256), F.concat(F.lit("é#à "), "role"), F.concat(F.lit("#é "), "role")).alias("said")).alias("turn")))
    trees = table(spark, sf, "conversations").select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("file"), nested.alias("value"))
    return documents.localization_items(trees, "[éà]", "[éà]").select("file", "uid", "field", "jp", "status")


def record_pivot(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(F.lit("part").alias("table"), F.col("p_name").alias("record_id"), F.col("p_partkey").alias("rec_idx"), F.col("p_brand").alias("field"), F.col("p_type").alias("cn"), F.lit("").alias("existing_cn"))
    return master.new_table(parts).select("record_id", F.to_json("fields").alias("fields"))


def script_rebuild(spark: SparkSession, sf: str, escape: bool = True) -> DataFrame:
    lines_ = _turn_lines(spark, sf, escape)
    items = scripts.items(lines_).filter("field = 'text' AND line % 2 = 0").select("file", "line", "field", F.concat(F.lit("T"), F.col("line").cast("string")).alias("cn"), F.lit("").alias("existing_cn"), F.col("seq").alias("ord"))
    made = files.write_streamed(rebuild.rebuilt_lines(lines_, items).withColumnRenamed("text", "piece"), scratch(spark, "scripts"), ["line"])
    return made.select("file", F.col("sha256").alias("content_sha256"))


def manifest_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Pages over https that aren't held: every fourth is in the log, and its file is its HTML."""
    pages = table(spark, sf, "pages").withColumn("name", F.concat_ws(" ", "url", "page_id"))
    log = pages.filter("page_id % 4 = 0").select("name", F.lit("ok").alias("state"))
    held = pages.select("name", F.coalesce(F.octet_length("html"), F.lit(0)).alias("n_bytes"))
    wanted = web.eligible(pages.filter(~F.endswith("url", F.lit("#top"))), "https", "")
    return web.missing(wanted, log, held).select("page_id", F.replace(F.lit("https://store.example.com/{o}?x"), F.lit("{o}"), F.col("page_id").cast("string")).alias("object_url"))


def _exported(spark: SparkSession, sf: str, status: str) -> DataFrame:
    path = scratch(spark, "export")
    tables.export_items(status_items(spark, sf), status, path)
    return documents.read_items(spark, path).select("uid")


def export_new(spark: SparkSession, sf: str) -> DataFrame:
    return _exported(spark, sf, "new")


def export_changed(spark: SparkSession, sf: str) -> DataFrame:
    return _exported(spark, sf, "changed")


def category_union(spark: SparkSession, sf: str) -> DataFrame:
    def item(name: str, key: str, jp: str, category: str) -> DataFrame:
        return table(spark, sf, name).select(F.concat_ws(":", F.lit(category), F.col(key).cast("string")).alias("uid"), F.lit(category).alias("category"), F.col(jp).alias("jp"))

    parts = [item("nation", "n_nationkey", "n_name", "resource").withColumn("line", F.lit(1)), item("part", "p_partkey", "p_name", "master"), item("customer", "c_custkey", "c_name", "generic"), item("supplier", "s_suppkey", "s_name", "localization")]
    return work.item_table(parts).select("uid", "category", "jp", F.coalesce("line", F.lit(-1)).alias("line"))


def apply_generic(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("file"), F.to_json(F.create_map(F.lit("a"), F.col("event_type"), F.lit("b"), F.lit("y"))).alias("value"))
    items = events.filter(F.col("file").cast("long") % 2 == 0).select("file", F.explode(F.array(F.lit("a"), F.lit("zz"))).alias("field"), F.lit("T").alias("cn"), F.lit("").alias("existing_cn"), F.lit(1).alias("ord"))
    return rebuild.apply_generic(events, items).select("file", "value", "applied")


def crypto_hash(spark: SparkSession, sf: str) -> DataFrame:
    """Content keys, and texts as the service and the cache file encrypt them, decrypted."""
    seed, key, vector = "driftline", "00112233445566778899aabbccddeeff", "0f" * 16
    docs = table(spark, sf, "documents").withColumn("text", F.coalesce("text", F.lit("")))

    def sealed(plain, by, iv):
        return F.aes_encrypt(plain, by, F.lit("CBC"), F.lit("PKCS"), F.unhex(F.lit(iv)))

    reply = sealed(F.col("text").cast("binary"), F.unhex(F.sha2(F.lit(seed), 256)), vector)
    cached = sealed(F.concat(F.unhex(F.lit("63" * 16)), F.col("text").cast("binary")), F.unhex(F.lit(key)), vector)
    cached = F.concat(F.unhex(F.lit("01")), F.substring(cached, F.lit(17), F.length(cached)))
    back = [manifest.decrypt_reply(reply, seed).cast("string"), manifest.decrypt_cache(cached, key, vector).cast("string")]
    return docs.select("doc_id", text.content_key(F.col("text")).alias("sha256"), (back[0] == F.col("text")).alias("round_trip"), (back[1] == F.col("text")).alias("cache_round_trip"))


def choice_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """Choice lines with the first choice of every second line put in."""
    jp = F.sha2(F.coalesce("text", F.lit("")), 256)
    lines_ = table(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.lit("[choicegroup text="), jp, F.lit(" text=b"), jp, F.lit("]")).alias("line"))
    texts = F.when(F.col("turn") % 2 == 0, F.create_map(F.lit("text[0]"), F.lit("A"), F.lit("text[1]"), F.lit(""))).otherwise(F.create_map(F.lit("text[1]"), F.lit("B")))
    return lines_.select("conv_id", "turn", script.build_line(F.col("line"), texts).alias("line"))


def prior_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Earlier texts of choices: wrapped with a stray bracket, plain answers, plain sources; and of other fields."""
    jp = F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = table(spark, sf, "documents").select("doc_id", jp.alias("jp"), F.when(F.col("doc_id") % 5 == 4, F.lit("text")).otherwise(F.lit("text[0]")).alias("field"))
    kinds = F.element_at(F.array(F.concat(F.lit("<r\\="), "jp", F.lit("]>T</r>")), F.lit("answer"), F.col("jp"), F.concat(F.lit("か"), "jp"), F.lit("answer")), (F.pmod("doc_id", F.lit(5)) + 1).cast("int"))
    current = F.when(F.pmod("doc_id", F.lit(5)) == 3, F.concat(F.lit("か"), "jp")).otherwise(F.col("jp"))
    return rows.select("doc_id", prior(F.col("field"), kinds, current).alias("x")).select("doc_id", "x.*")


def known_names(spark: SparkSession, sf: str) -> DataFrame:
    """Name lines: what a package has, else the first known name that contains it, else itself; {user} stays; and names by key."""
    known = {"k": "", "a": "SMALL BRUSHED TIN", "b": "Brand#11 and Brand#12", "c": "PROMO"}
    part = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 4 == 0, F.lit("{user}")).otherwise(F.col("p_brand")).alias("jp"), F.when(F.col("p_partkey") % 3 == 0, F.lit("had")).otherwise(F.lit("")).alias("existing_cn"), F.when(F.col("p_partkey") % 2 == 0, F.lit("text")).otherwise(F.lit("name")).alias("field"), F.lit("new").alias("status"), "p_type")
    return diff.with_names(part, known).select("p_partkey", "existing_cn", "status", text.mapped(F.col("p_type"), {"PROMO": "promoted", "ECONOMY": "cheap"}).alias("label"))


def record_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as records with texts put in: at their place, by id where the place has another, as a new field, and none."""
    parts = table(spark, sf, "part").withColumn("i", F.col("p_partkey").cast("int"))
    key = F.concat(F.lit('"k'), F.col("p_partkey").cast("string"), F.lit('"'))
    records = parts.select(F.lit("part").alias("table"), F.col("i").alias("rec_idx"), F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("id"), key, F.lit("name"), F.lit('"old"')).alias("rec"))
    kind = F.col("p_partkey") % 4
    items = parts.filter(kind < 3).select(F.lit("part").alias("table"), F.when(kind == 1, F.col("i") + 1).otherwise(F.col("i")).alias("rec_idx"), key.alias("record_id"), F.when(kind == 2, F.lit("more")).otherwise(F.lit("name")).alias("field"), F.col("p_brand").alias("cn"), F.lit("").alias("existing_cn"))
    out = master.apply_updates(records, items)
    return out.select("rec_idx", F.array_join(F.transform(F.map_entries("rec"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("rec"), F.col("applied").cast("int").alias("applied"))


def package_files(spark: SparkSession, sf: str) -> DataFrame:
    """A file for each brand of parts, rewritten with new names; other keys keep order and values. Brands without a file get one."""
    parts = table(spark, sf, "part").select("p_partkey", F.translate("p_brand", "#", "_").alias("table"), "p_name", "p_size", (F.col("p_brand").like("%1%")).alias("held"))
    order = F.row_number().over(Window.partitionBy("table").orderBy("p_partkey")) - 1
    parts = parts.withColumn("rec_idx", order.cast("int")).withColumn("key", F.concat(F.lit("k"), F.col("p_partkey").cast("string")))
    record = F.to_json(F.struct(F.col("p_size").alias("z"), F.col("key").alias("id"), F.lit("old").alias("name"), F.array(F.lit(1), F.lit(2)).alias("a")))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rec_idx", record.alias("r")))), lambda x: x["r"]), ",")
    held = parts.filter("held").groupBy("table").agg(F.concat(F.lit('{"rules":{"primaryKeys":["id"]},"more":1,"data":['), listed, F.lit("]}")).alias("value"))
    items = parts.select("table", "rec_idx", F.concat(F.lit('"'), "key", F.lit('"')).alias("record_id"), F.lit("name").alias("field"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(F.lit("")).alias("cn"), F.lit("").alias("existing_cn"))
    made = files.write_streamed(master.package_pieces(held, items).withColumnRenamed("table", "file"), scratch(spark, "tables"), ["place"], **master.JOINTS)
    return made.select(F.col("file").alias("table"), F.col("sha256").alias("content_sha256"), "applied")


QUERIES = {f.__name__: f for f in (status_counts, status_items, fallback_union, fallback_by_emptiness, fallback_by_presence, pending_items, pending_by_source, checkpoint_precedence, snapshot_changed, snapshot_upsert, snapshot_deltas, dup_id_index_join, script_lines, command_parse, choice_indexed, speaker_for_text, batch_plan, batch_prompt, response_parse, translate_merge, source_normalise, source_equal, hashtag_kana_filter, wrap_multiline, first_name_match, first_container, context_from_stem, prefix_label, json_flatten, json_path_set, generic_explode, record_pivot, script_rebuild, manifest_filter, export_new, export_changed, category_union, apply_generic, crypto_hash, failed_batches, batch_ledger, translate_totals, reply_texts, localization_leaves, choice_rebuild, prior_texts, known_names, record_updates, package_files)} | {"split_wrapped": split_wrapped_back} | workspace.QUERIES
