"""Planning the pending work into ordered batches, calling the batch function, reading its answers, merging them."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from driftline.functions.text import content_key, first_prefix, mapped, no_text
from driftline.operators.ledger import ReplyLedger
from driftline.operators.numbering import numbered
from driftline.schema import CATEGORIES, ITEM, STORY_LABELS

# The prompt's sentences, needed for equal prompts.
HEAD = ("[场景上下文]", "文件: ", "角色: ", "场景类型: ", "章节: ")
RULES = ("将以下{n}条游戏文本翻译成简体中文。", "保持 \\n 换行符不变：输出时必须写为两个字符 \\n，绝对不要输出实际换行。不要翻译 {user} 占位符。", "保留游戏标签格式 `<r\\=...>...</r>`，包括 `r` 后面的反斜杠。")
SPEECH = "注意对话的角色语气和上下文连贯性。"
INPUT = "输入（按顺序翻译）:"
OUTPUT = ("输出格式：每段必须以原始 [uid] 开头，后接对应译文，用 --- 单独一行分隔；--- 不属于译文。", "只翻译本次输入中出现的 [uid]，不要输出任何未出现在输入中的 [uid]。", "不要省略、改写或翻译 [uid]。不要解释。")
ATTEMPTS, WAITS = 3, (5, 10)
#: Calls that one task has under way at most.
THREADS = 8
#: Rows that a task hands on at a time.
HANDED = 2000


def as_items(rows: DataFrame) -> DataFrame:
    """The columns of an item, and seq; those that rows lack are null, or 0."""
    own = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ITEM]
    return rows.select(*own, (F.col("seq") if "seq" in rows.columns else F.lit(0)).cast("int").alias("seq"))


def item_table(parts: list[DataFrame]) -> DataFrame:
    """All parts' items, numbered by ord in the order of category, file and place."""
    whole = reduce(DataFrame.unionByName, map(as_items, parts))
    rank = F.array_position(F.array(*map(F.lit, CATEGORIES)), F.col("category"))
    return whole.orderBy(rank, "file", F.coalesce("line", "rec_idx"), "seq", "uid").withColumn("ord", F.monotonically_increasing_id()).drop("seq")


def eligible(skip_changed: bool = False) -> Column:
    return (F.col("status") == "new") | ((F.col("status") == "changed") & F.lit(not skip_changed))


def checkpoint_over_prior(checkpoint: DataFrame, prior: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(uid, cn), or other keys than uid: the checkpoint, and earlier results that it lacks; empty ones don't count."""
    keys = keys or ["uid"]
    return checkpoint.select(*keys, "cn").unionByName(prior.filter(~no_text(F.col("cn"))).select(*keys, "cn").join(checkpoint, keys, "left_anti"))


def pending(items: DataFrame, done: DataFrame, skip_changed: bool = False, by_source: bool = True) -> DataFrame:
    """Eligible items without a result; by_source: a result (uid, jp_sha) counts for the same source text only."""
    rows = items.filter(eligible(skip_changed))
    if by_source:
        return rows.withColumn("jp_sha", content_key(F.col("jp"))).join(done, ["uid", "jp_sha"], "left_anti").drop("jp_sha")
    return rows.join(done, "uid", "left_anti")


def group_key() -> Column:
    """Scripts with a character and tables go by file, the rest of a category together."""
    known = ~no_text(F.col("file_context.character"))
    return F.when((F.col("category") == "resource") & known, F.concat(F.lit("resource:"), F.col("file"))).when(F.col("category") == "master", F.concat(F.lit("master:"), F.col("file"))).otherwise(F.concat(F.col("category"), F.lit(":flat")))


def batches(items: DataFrame, size: int = 20, key: Column | None = None) -> DataFrame:
    """items with gk, pos (from 0 in the group) and batch: groups in order of lines (scripts) and of ord, cut by size. A group of any size is spread over many tasks."""
    rows = items.withColumn("gk", key if key is not None else group_key())
    by_line = F.when(F.startswith("gk", F.lit("resource:")), F.coalesce("line", F.lit(0))).otherwise(F.lit(0))
    placed = numbered(rows.withColumn("_by_line", by_line), ["gk"], ["_by_line", "ord"], "pos").drop("_by_line")
    return placed.withColumn("batch", F.floor(F.col("pos") / size).cast("long"))


def prompts(planned: DataFrame, names: dict[str, str] | None = None, labels: dict[str, str] | None = None) -> DataFrame:
    """(gk, batch, prompt, uids, shas): one prompt a batch, which has a bounded number of items; shas are the hashes of their sources."""
    row = F.struct("pos", "uid", "jp", "speaker", "file", "file_context")
    got = planned.groupBy("gk", "batch").agg(F.array_sort(F.collect_list(row)).alias("r"))
    first = F.get("r", F.lit(0))
    context, character = first["file_context"], F.coalesce(first["file_context"]["character"], F.lit(""))
    head = F.when(character != "", F.array(F.lit(HEAD[0]), F.concat(F.lit(HEAD[1]), first["file"]), F.concat(F.lit(HEAD[2]), mapped(character, names or {})), F.concat(F.lit(HEAD[3]), first_prefix(F.coalesce(context["story_type"], F.lit("")), labels or STORY_LABELS)), F.concat(F.lit(HEAD[4]), F.coalesce(context["chapter"], F.lit(""))), F.lit(""))).otherwise(F.array().cast("array<string>"))
    rules = F.array(F.replace(F.lit(RULES[0]), F.lit("{n}"), F.size("r").cast("string")), *map(F.lit, RULES[1:]))
    speech = F.when(F.exists("r", lambda x: ~no_text(x["speaker"])), F.array(F.lit(SPEECH))).otherwise(F.array().cast("array<string>"))
    said = F.transform("r", lambda x: F.concat(F.lit("["), x["uid"], F.lit("] "), F.when(no_text(x["speaker"]), F.lit("")).otherwise(F.concat(F.lit("("), x["speaker"], F.lit(") "))), x["jp"]))
    whole = F.concat(head, rules, speech, F.array(F.lit(""), F.lit(INPUT)), said, F.array(F.lit(""), *map(F.lit, OUTPUT), F.lit(""), F.lit("输出:")))
    return got.select("gk", "batch", F.array_join(whole, "\n").alias("prompt"), F.transform("r", lambda x: x["uid"]).alias("uids"), F.transform("r", lambda x: content_key(x["jp"])).alias("shas"))


def shares(concurrency: int) -> tuple[int, int]:
    """Tasks, and calls that each has under way at a time; together at most so many calls."""
    tasks = max(1, -(-concurrency // THREADS))
    return tasks, max(1, concurrency // tasks)


def _answered(service, prompt: str, uids: list[str], waits: tuple[int, ...]) -> tuple[dict[str, str], bool, str | None]:
    """The best of up to ATTEMPTS answers: texts by uid, whether none lacks, and the last error."""
    from driftline.backend import read_reply

    best, error = {}, None
    for attempt in range(ATTEMPTS):
        try:
            found = {u: t for u, t in read_reply(service.translate(prompt), uids).items() if t}
            if len(found) == len(uids):
                return found, True, None
            best = found if len(found) > len(best) else best
            error = f"{len(uids) - len(found)} of {len(uids)} missing"
        except Exception as e:  # noqa: BLE001  a failed call is an error row, not a failed job
            error = str(e)[:200] or type(e).__name__
        if attempt < ATTEMPTS - 1:
            time.sleep(waits[min(attempt, len(waits) - 1)] if waits else 0)
    return best, False, error


def translate(planned: DataFrame, backend: Callable[[], object], concurrency: int = 5, keep_partial: bool = False, waits: tuple[int, ...] = WAITS, names: dict[str, str] | None = None, ledger: ReplyLedger | None = None) -> DataFrame:
    """(gk, batch, uid, jp_sha, cn, error, first): a batch succeeds if every uid has a text; else it is tried again, and failed batches come out as error rows. first: one row a batch.

    ``backend()`` makes an object with translate(prompt) once a task; several threads of the task call it, as many in all as
    ``concurrency`` says. With a ledger each whole answer is kept before its task goes on, and a batch that is kept isn't asked:
    the result may be computed twice. Without one, calls aren't idempotent: write the result before using it twice.
    """
    tasks, threads = shares(concurrency)
    wanted = prompts(planned, names).repartition(tasks, "gk", "batch")

    def run(frames):
        service = backend()

        def ask(gk: str, batch: int, prompt: str, uids: list[str], shas: list[str]) -> list[tuple]:
            key = ledger.key(gk, batch, prompt) if ledger else ""
            texts, error = (ledger.find(key) if ledger else None), None
            if texts is None:
                texts, whole, error = _answered(service, prompt, uids, waits)
                if whole and ledger:
                    ledger.keep(key, gk, batch, [(u, s, texts[u]) for u, s in zip(uids, shas, strict=True)])
                texts = texts if whole or keep_partial else {}
            return [(gk, batch, u, s, texts.get(u), error, i == 0) for i, (u, s) in enumerate(zip(uids, shas, strict=True))]

        def frame_of(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=["gk", "batch", "uid", "jp_sha", "cn", "error", "first"])

        with ThreadPoolExecutor(threads) as pool:
            under_way, out = deque(), []
            for frame in frames:
                for gk, batch, prompt, uids, shas in frame[["gk", "batch", "prompt", "uids", "shas"]].itertuples(index=False):
                    under_way.append(pool.submit(ask, gk, batch, prompt, list(uids), list(shas)))
                    if len(under_way) > 2 * threads:  # bounded: the rest waits in Spark
                        out += under_way.popleft().result()
                    if len(out) >= HANDED:
                        yield frame_of(out)
                        out = []
            while under_way:
                out += under_way.popleft().result()
            if out:
                yield frame_of(out)

    return wanted.mapInPandas(run, "gk string, batch long, uid string, jp_sha string, cn string, error string, first boolean")


def totals(answers: DataFrame) -> tuple[DataFrame, Observation]:
    """The answers, and what their one pass counts: batches, failed ones, texts."""
    seen = Observation()
    has = ~no_text(F.col("cn"))
    return answers.observe(seen, F.count_if("first").alias("batches"), F.count_if(F.col("first") & F.col("error").isNotNull()).alias("failed"), F.count_if(has).alias("texts")), seen


def merge_results(items: DataFrame, results: DataFrame, skip_changed: bool = False) -> DataFrame:
    """items with cn: the result of an eligible item, else what it had."""
    joined = items.drop("cn").join(results.filter(~no_text(F.col("cn"))).select("uid", F.col("cn").alias("_cn")), "uid", "left")
    return joined.withColumn("cn", F.when(eligible(skip_changed) & F.col("_cn").isNotNull(), F.col("_cn")).otherwise(F.col("existing_cn"))).drop("_cn")


def counts(items: DataFrame) -> DataFrame:
    """One row: n, n_new, n_changed."""
    return items.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "new").alias("n_new"), F.count_if(F.col("status") == "changed").alias("n_changed"))
