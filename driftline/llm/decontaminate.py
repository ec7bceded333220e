"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

Windows are runs of ``window`` item words (a shorter item is one window); each is the set of its ``shingle``-word shingles.
For exact containment all of them must occur, so the necessary prefix is one shingle: the one that is rarest in the
documents. The steps:

1. count, over all documents, the shingles that occur in some window (partial sums before the shuffle);
2. choose each window's rarest shingle, the prefix token, and its place in the window;
3. join document shingles to prefix tokens; the place gives where the window would start, and the length bounds of the
   document rule out starts before its first or past its last word;
4. verify the window word by word at that place.

Everything from the tokens to the verification is one generated code span over the scan when the windows are few enough to
broadcast (their number and bytes are checked). Beyond that the same joins are by shuffle, behind a sieve of the windows'
shingles: only places whose shingle passes it are shuffled, in step 3 with the words around them.
Both sides' shingles are 64-bit hashes of words under the A-Z rule (Unicode's lower case depends on a letter's neighbours, and
these differ between a document and a window); step 4 compares the words. One window is joined once whatever number of items share it.

Nulls: a null text has no words, a null item_id names no item. Rows with the same doc_id and text are one document, with the
answer repeated on each row. Empty tables: no windows, hence nothing hit. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.llm import base as base_
from driftline.llm.base import drop_rows, load, materialise, maybe_broadcast, passing, sieve, text_of

WINDOW, SHINGLE = 10, 5
#: Characters between words, either case of A-Z being word characters.
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: More windows than this are not broadcast.
BROADCAST_WINDOWS = 200_000


def words(text: Column) -> Column:
    """Words, A-Z in lower case."""
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), GAPS), "")


def _key(arr: str, at: Column, n: int) -> Column:
    """Hash of the n words from the 0-based place; null past the end."""
    parts = [F.get(F.col(arr), at + k) for k in range(n)]
    return F.when(parts[-1].isNotNull(), F.xxhash64(*parts, F.lit(n)))


def windows_of(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, DataFrame]:
    """(wid, words, n) for each distinct window, and (wid, item_id) for the items that have it."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item_id"), words(text_of(text_col)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    each = items.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s + 1, window))).alias("words"))
    each = each.withColumn("wid", F.sha2(F.array_join("words", " "), 256))
    distinct = each.dropDuplicates(["wid"]).select("wid", "words", F.size("words").alias("n"))
    return distinct, each.filter("item_id IS NOT NULL").select("wid", "item_id").distinct()


def _tokens(docs: DataFrame) -> DataFrame:
    """A row for each word place: the document's keys, its words, and the place. Outer, so that no filter re-splits the text."""
    return docs.select("doc_id", "h", words(F.col("text")).alias("w")).select("doc_id", "h", "w", F.posexplode_outer("w").alias("p", "_"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, for each document row."""
    base = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    wins, owners = windows_of(benchmark, item_col, item_text, window)
    wins = materialise(wins.withColumn("k", F.least("n", F.lit(shingle))), "windows")
    owners = materialise(owners, "owners")
    n_wins, n_bytes = wins.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.array_join("words", " ")) + 200), F.lit(0))).first()
    few = n_wins <= BROADCAST_WINDOWS and n_bytes <= base_.BROADCAST_BYTES
    lengths = sorted(r.k for r in wins.select("k").distinct().collect())  # at most `shingle` lengths
    if not lengths:
        hits = docs.sparkSession.createDataFrame([], "doc_id long, h long, wid string, s int, n int").select(F.col("doc_id").cast(base.schema["doc_id"].dataType).alias("doc_id"), "h", "wid", "s", "n")
    else:
        # every shingle of every window with its first place there
        places = reduce(DataFrame.unionByName, [
            wins.filter(F.col("k") == k).select("wid", "words", "n", "k", F.explode(F.sequence(F.lit(0), F.col("n") - k)).alias("off")).withColumn("key", _key("words", F.col("off"), k))
            for k in lengths
        ])
        places = materialise(places.groupBy("wid", "key").agg(F.min("off").alias("off"), F.first("words").alias("words"), F.first("n").alias("n"), F.first("k").alias("k")), "places")
        tokens, counted = _tokens(base), []
        for k in lengths:
            keys = places.filter(F.col("k") == k).select("key").distinct()
            every = tokens.select(_key("w", F.col("p"), k).alias("key"))
            every = every.join(F.broadcast(keys), "key") if few else passing(every.filter("key IS NOT NULL"), "key", sieve(keys, "key", keys.count()))
            counted.append(every.groupBy("key").agg(F.count(F.lit(1)).alias("df")))  # what slips through a sieve is no window's shingle
        rarity = reduce(DataFrame.unionByName, counted)
        # a window with a shingle that no document has (no count) can't occur; else the rarest is its prefix
        ranked = places.join(rarity, "key", "left").groupBy("wid").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "key", "off", "words", "n", "k")).alias("x"))
        prefix = materialise(ranked.select("wid", "x.*").filter("df > 0"), "prefix")
        found = []
        for k in lengths:
            side = prefix.filter(F.col("k") == k).select("wid", "key", "off", "words", "n")
            size = F.size("w")
            if few:
                side = F.broadcast(side)
                near, at = tokens.select("doc_id", "h", "w", "p", _key("w", F.col("p"), k).alias("key")), F.col("p") - F.col("off")
                total, first = size, at
            else:  # the words that a window around this place can reach, where they begin, and the document's length
                low = F.greatest(F.col("p") - (window - k), F.lit(0))
                near = tokens.filter("p IS NOT NULL").select("doc_id", "h", F.slice("w", low + 1, F.lit(2 * window)).alias("w"), "p", low.alias("low"), size.alias("size"), _key("w", F.col("p"), k).alias("key"))
                total, first = F.col("size"), F.col("p") - F.col("off") - F.col("low")
                near = passing(near, "key", sieve(side, "key", side.count()))
                at = F.col("p") - F.col("off")
            bound = (at >= 0) & (at + F.col("n") <= total)
            same = reduce(lambda a, b: a & b, [(F.col("n") <= j) | (F.get("w", first + j) == F.get("words", F.lit(j))) for j in range(window)])
            found.append(near.join(side, "key").filter(bound & same).select("doc_id", "h", "wid", at.cast("int").alias("s"), F.col("n").cast("int").alias("n")))
        hits = reduce(DataFrame.unionByName, found).distinct()
    hits = materialise(hits, "hits")
    # words under any window: what each stretch adds beyond those that begin before it
    order = Window.partitionBy("doc_id", "h").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.select("doc_id", "h", "s", (F.col("s") + F.col("n")).alias("e")).distinct()
    spans = spans.withColumn("past", F.coalesce(F.max("e").over(order), F.lit(0)))
    covered = spans.groupBy("doc_id", "h").agg(F.sum(F.greatest(F.col("e") - F.greatest("s", "past"), F.lit(0))).alias("n_hit"))
    named = hits.select("doc_id", "h", "wid").distinct().join(maybe_broadcast(owners, owners.count(), BROADCAST_WINDOWS), "wid").groupBy("doc_id", "h").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    per_doc = covered.join(named, ["doc_id", "h"], "left").withColumnsRenamed({"doc_id": "_id", "h": "_h"})
    counted_docs = base.select("doc_id", "h", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    joined = counted_docs.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "h")


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    bad = contamination(docs, benchmark, id_col=id_col, text_col=text_col).filter("contaminated").select("doc_id", "h")
    return drop_rows(docs, bad, id_col, F.xxhash64(text_of(text_col)), "contaminated")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")).drop("h")


_SQL_WORDS = f"list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
ORACLE = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, w[s:s + {WINDOW - 1}] AS win FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(win) AS n FROM bw),
dw AS (SELECT doc_id, s, n, w[s:s + n - 1] AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, s, dw.n, item_id FROM dw JOIN bw USING (win)),
cov AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hit)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)
"""
