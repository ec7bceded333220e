"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every historical version of every path is content-addressed (SHA-256 of its UTF-8 bytes). The ledger, two Parquet tables in a
folder, holds the (blob, rule versions) already scanned and the spans found; ``scan`` compares a batch's hashes with it, scans
only the pairs it lacks, appends them, and ``report`` joins the findings back to all paths.

Texts stay where they are read: a blob that one row of the batch has is scanned in place, and of a blob that many have (a third
of the paths, say) one copy a task is shuffled and one is scanned. Hashes, and the matches found, are what else is shuffled.
Rows whose blob is done are kept out by a sieve of the unseen blobs; the few that slip through it are scanned in vain. Ledger
entries of blobs that the batch lacks don't leave their scan. Adaptive execution splits a hot hash in the join back.

Nulls: a null text is the empty blob, which has no spans; a null path is a path like others. Repeated rows each get an answer.
Empty tables give empty results; input columns besides the two named are ignored. The query takes the middle of the ids, so its doc_ids are numbers. A text with very many matches takes time and
space in proportion to them.
"""

from __future__ import annotations

from dataclasses import dataclass

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.llm import base
from driftline.llm.base import discard, failing, load, materialise, narrowed, passing, scratch, sieve, text_of


@dataclass(frozen=True)
class Rule:
    """kind: name in results; version: raised when the pattern changes; hint: a cheap pattern that any match implies; group, least: the group that must be so long."""

    kind: str
    version: int
    hint: str
    pattern: str
    group: int
    least: int

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


#: In the order in which kinds are listed at equal starts. Letters of "assign" match in either ASCII case. For the two
#: single-class patterns the least length is in the pattern: a run matches from its first character to its last or not at all.
RULES = (
    Rule("assign", 1, r"(?i)passw|secret|token|api_?key", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16}", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24}", r"[0-9a-f]{24,}", 0, 24),
)
_SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _pieces(text: Column, rule: Rule, rank: int) -> Column:
    """For each match of the rule, in order: rank, i, the length of the gap before it, its own length, whether it counts."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    held = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else matches
    pairs = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), matches.alias("hit"), held.alias("key"))
    each = F.transform(pairs, lambda x, i: F.struct(F.lit(rank).alias("rank"), i.alias("i"), F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), (F.length(x["key"]) >= rule.least).alias("counts")))
    return F.when(text.rlike(rule.hint), each).otherwise(F.array().cast("array<struct<rank:int,i:int,gap:int,hit:int,counts:boolean>>"))


def spans_of(blobs: DataFrame, rules: list[tuple[int, Rule]]) -> DataFrame:
    """(blob, text) -> (blob, spans) of the blobs that have any: all leftmost non-overlapping matches as (start, rank, end, kind), in code points, end exclusive, in order.

    Splitting a text at its matches gives the gaps; a running sum over gaps and matches, a window over the blob's matches, gives
    the places. Repeated blobs have one answer.
    """
    found = blobs.select("blob", F.concat(*[_pieces(F.col("text"), r, k) for k, r in rules]).alias("m")).filter(F.size("m") > 0)
    each = found.dropDuplicates(["blob"]).select("blob", F.explode("m").alias("m")).select("blob", "m.*").filter("hit IS NOT NULL")  # the last gap has no match behind it
    end = F.sum(F.col("gap") + F.col("hit")).over(Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    kind = F.element_at(F.create_map(*[F.lit(x) for k, r in rules for x in (k, r.kind)]), F.col("rank"))
    placed = each.withColumn("end", end).filter("counts").select("blob", F.struct((F.col("end") - F.col("hit")).alias("start"), "rank", "end", kind.alias("kind")).alias("s"))
    return placed.groupBy("blob").agg(F.array_sort(F.collect_list("s")).cast(_SPANS).alias("spans"))


def _once(rows: DataFrame, many: DataFrame, n: int) -> DataFrame:
    """(blob, text) with one row for each blob of ``many``, and the others' rows as they are."""
    if n <= base.BROADCAST_ROWS:
        few = F.broadcast(many)
        single, repeated = rows.join(few, "blob", "left_anti"), rows.join(few, "blob", "left_semi")
    else:
        bits = sieve(many, "blob", n)
        single, repeated = failing(rows, "blob", bits), passing(rows, "blob", bits)
    return single.unionAll(repeated.groupBy("blob").agg(F.first("text").alias("text")))  # one row a task and blob before the shuffle


class SecretLedger:
    """The scanned (blob, rule version) pairs and their findings, kept in ``path``."""

    def __init__(self, spark: SparkSession, path: str, rules: tuple[Rule, ...] = RULES):
        self.spark, self.path, self.rules = spark, path, rules

    def _table(self, name: str, schema: str) -> DataFrame:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if not there.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(there):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def scanned(self) -> DataFrame:
        """(blob binary, rules array<string>): one row for each blob and batch that scanned it."""
        return self._table("scanned", "blob binary, rules array<string>")

    def found(self) -> DataFrame:
        """(blob binary, rules array<string>, spans): one row for each blob and batch that found something in it."""
        return self._table("found", f"blob binary, rules array<string>, spans {_SPANS}")

    def scan(self, versions: DataFrame, text_col: str = "text") -> int:
        """Scan the unseen pairs among the blobs of ``versions`` and append them; returns the number of blobs scanned.

        Findings are appended before the pairs: a scan that breaks off between is made again, and counts once.
        """
        names = F.array(*[F.lit(r.id) for r in self.rules])
        texts = versions.select(text_of(text_col).alias("text")).select(F.unhex(F.sha2("text", 256)).alias("blob"), "text")
        batch = materialise(texts.groupBy("blob").agg(F.count(F.lit(1)).alias("n")), "batch")
        n_batch = batch.count()
        past, own = narrowed(self.scanned(), "blob", batch.select("blob"), "blob", n_batch)
        done = past.join(own, "blob").groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("done"))
        todo = batch.join(done, "blob", "left").withColumn("rules", F.array_except(names, F.coalesce("done", F.array().cast("array<string>"))))
        todo = materialise(todo.filter(F.size("rules") > 0).select("blob", "rules", "n"), "todo")
        n_todo, parts, held = todo.count(), [], []
        for lacking in [r.rules for r in todo.select("rules").distinct().collect()]:  # sets of rule versions: as many as the rules had changes
            some = todo.filter(F.col("rules") == F.array(*map(F.lit, lacking)))
            n_some, many = some.count(), materialise(some.filter("n > 1").select("blob"), "many")
            held.append(many)
            rows = texts
            if n_some < n_batch:
                rows, few = narrowed(texts, "blob", some.select("blob"), "blob", n_some)
                rows = rows.join(few, "blob", "left_semi") if rows is texts else rows
            often = many.count()
            if often:
                rows = _once(rows, many, often)
            spans = spans_of(rows, [(k, r) for k, r in enumerate(self.rules) if r.id in lacking])
            parts.append(spans.join(some.select("blob", "rules"), "blob").select("blob", "rules", "spans"))
        if parts:
            reduce(DataFrame.unionAll, parts).write.mode("append").parquet(f"{self.path}/found")
            todo.select("blob", "rules").write.mode("append").parquet(f"{self.path}/scanned")
        discard(batch, todo, *held)
        return n_todo

    def findings(self) -> DataFrame:
        """(blob, spans) for the current rule versions, blobs with spans only; spans in order. A pair that two writers scanned counts once."""
        names = F.array(*[F.lit(r.id) for r in self.rules])
        current = self.found().filter(F.arrays_overlap("rules", names))
        kinds = [F.when(F.array_contains("rules", r.id), F.lit(r.kind)) for r in self.rules]
        current = current.select("blob", F.filter("spans", lambda s: F.array_contains(F.array_compact(F.array(*kinds)), s["kind"])).alias("spans"))
        each = current.select("blob", F.explode("spans").alias("s")).distinct()  # grouped by value: a set inside a row would compare all pairs
        return each.groupBy("blob").agg(F.array_sort(F.collect_list("s")).alias("spans"))

    def report(self, versions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """One row for each row of ``versions``: doc_id, n_<kind> for each rule, base_sha256, spans."""
        paths = versions.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text_of(text_col), 256)).alias("blob"))
        joined = paths.join(self.findings(), "blob", "left").withColumn("spans", F.coalesce("spans", F.array().cast(_SPANS)))

        def count(kind: str) -> Column:
            return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

        said = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
        return joined.select("doc_id", *[count(r.kind) for r in self.rules], F.sha2(said, 256).alias("base_sha256"), said.alias("spans"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history in two batches into a new ledger: the older versions (ids up to the middle of their range), then all documents, of which only blobs that the ledger lacks are scanned. The report has all documents. The ledger adds no spans to the base ones."""
    docs = load(spark, sf_dir, "documents")
    ledger = SecretLedger(spark, scratch(spark, "ledger"))
    middle = docs.agg(F.floor((F.min("doc_id") + F.max("doc_id")) / 2)).first()[0]
    ledger.scan(docs.filter(F.col("doc_id") <= middle))
    ledger.scan(docs)
    return ledger.report(docs)


def _sql_spans(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rk, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s, length(hits[i]) AS n
  FROM (SELECT doc_id, gaps, hits, keys, unnest(range(1, len(hits) + 1)) AS i FROM (SELECT doc_id, string_split_regex(t, '{quoted}') AS gaps, regexp_extract_all(t, '{quoted}', 0) AS hits, regexp_extract_all(t, '{quoted}', {group}) AS keys FROM d))
  WHERE length(keys[i]) >= {least}"""


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({' UNION ALL '.join(_sql_spans(r.kind, k, r.pattern, r.group, r.least) for k, r in enumerate(RULES))}),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS na, count(*) FILTER (kind = 'access') AS nc, count(*) FILTER (kind = 'hex') AS nh,
  string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, rk) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(na, 0) AS n_assign, coalesce(nc, 0) AS n_access, coalesce(nh, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""
