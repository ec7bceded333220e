"""Exact dedup: counting quotient filters built per partition find the fingerprints that repeat; only those texts are compared byte by byte.

* Each partition counts 64-bit fingerprints in one filter a segment (leading bits); filters of a segment merge losslessly.
* Fingerprints with a count of one are single texts and go no further: their text isn't shuffled, but for the few that slip
  through the sieve that stands for the repeated fingerprints where these are too many to broadcast.
* Texts of repeated fingerprints are grouped by (fingerprint, bytes), pre-aggregated before the shuffle, so one text that
  fills a third of the rows reaches the reducers as one row a task.

Nulls: a null text counts as an empty one; a null id ranks below every id. Empty texts equal each other. Long texts are
hashed and compared whole. Ties: of equal texts the largest id stays; rows that repeat both id and text are one document and
carry the same answer (``keep_distinct`` leaves one of them). Empty table: empty result. Columns that the input has besides
do not matter, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import base
from driftline.llm.base import drop_rows, fresh, load, materialise, maybe_broadcast, passing, sieve, text_of
from driftline.llm.quotient import CountingQuotientFilter, tally

#: Fingerprints that one task gathers before it writes out its filters.
FLUSH = 4_000_000


def partition_filters(fps: DataFrame, seg_bits: int) -> DataFrame:
    """fps(fp long) -> (segment, filter): the filters of each partition."""

    def build(batches):
        def out(held):
            distinct, counts = tally(np.concatenate(held))
            seg = (distinct >> np.uint64(64 - seg_bits)).astype(np.int64)
            edge = np.r_[np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]]), len(seg)]
            segments = seg[edge[:-1]].tolist()
            blobs = [CountingQuotientFilter.build(distinct[a:b], counts[a:b], s, seg_bits).to_bytes() for s, a, b in zip(segments, edge[:-1], edge[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(segments, pa.int64()), pa.array(blobs, pa.binary())], names=["segment", "filter"])

        held: list[np.ndarray] = []
        for b in batches:
            if b.num_rows:
                held.append(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= FLUSH:
                yield out(held)
                held = []
        if held:
            yield out(held)

    return fps.mapInArrow(build, "segment long, filter binary")


def merged_repeats(filters: DataFrame) -> DataFrame:
    """(segment, filter) -> (fp long, n long) for the fingerprints that occur more than once."""

    def merge(table: pa.Table) -> pa.Table:
        fps, counts = CountingQuotientFilter.merge([CountingQuotientFilter.from_bytes(x) for x in table.column("filter").to_pylist()]).items()
        many = counts > 1
        return pa.table({"fp": fps[many].view(np.int64), "n": counts[many]})

    return filters.groupBy("segment").applyInArrow(merge, "fp long, n long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seg_bits: int | None = None) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256.

    seg_bits: 2**seg_bits segments of fingerprints, each merged in one task; by default 16 to each shuffle partition.
    """
    spark = docs.sparkSession
    if seg_bits is None:
        seg_bits = min(20, 3 + int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length())
    whole = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("fp", F.xxhash64("text"))
    repeats = materialise(merged_repeats(partition_filters(whole.select("fp"), seg_bits)).select("fp"), "repeats")
    n = repeats.count()
    routed = whole.join(F.broadcast(repeats), "fp", "left_semi") if n <= base.BROADCAST_ROWS else passing(whole, "fp", sieve(repeats, "fp", n))
    classes = routed.groupBy("fp", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    classes = materialise(classes.filter("group_size > 1").select(F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"), "classes")
    keyed = whole.select("doc_id", F.sha2("text", 256).alias("text_sha256"))
    joined = keyed.join(maybe_broadcast(classes, classes.count()), "text_sha256", "left")
    size = F.coalesce("group_size", F.lit(1))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select("doc_id", keep.alias("keep_id"), size.cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    verdict = exact_dedup(docs, id_col, text_col)
    sha = F.sha2(text_of(text_col), 256)
    out = drop_rows(docs, verdict.filter(~F.col("kept")).select("doc_id", "text_sha256"), id_col, sha, "dropped")
    keys = docs.select(F.col(id_col).alias("i"), sha.alias("s")).groupBy("i", "s").count().filter("count > 1")
    if not keys.isEmpty():  # rows that repeat id and text: one of them stays
        (name,) = fresh(docs, "sha")
        out = out.withColumn(name, sha).dropDuplicates([id_col, name]).drop(name)
    return out


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(load(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
