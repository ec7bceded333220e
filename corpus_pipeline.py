"""The corpus pipeline: quality filter, exact dedup, near dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns what it keeps with the columns of ``documents``; the last returns token ids.
Stages are written as Parquet and read again, so a lost executor costs at most the stage it worked on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import decontaminate, exact_dedup, near_dedup, pieces, quality
from driftline.llm.base import TEXT_BATCH, discard, load, made, materialise, release


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled ones among them, scores at 0.3 or more. Written with fewer rows in an Arrow batch: rows hold whole texts."""
    return materialise(quality.keep_good(docs, load(spark, sf_dir, "labels")), "quality", TEXT_BATCH)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_dedup.keep_distinct(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.keep_clean(docs, load(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip: whether decoding the ids gives the text. Written as in the first stage."""
    out = pieces.encode_documents(docs.select("doc_id", "text"), check_col="round_trip")
    return materialise(out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip"), "tokens", TEXT_BATCH)


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode),
]

#: The classifier can't be put in SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage wrote is deleted once the next stage's documents are written."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        first = made(spark)
        past, found = docs, stage(spark, docs, sf_dir)
        docs = found if hasattr(found, "_folder") else materialise(found, name.split()[0].lower(), TEXT_BATCH)
        release(spark, first, keep=docs)
        if name != STAGES[0][0]:
            discard(past)
    return STAGES[-1][1](spark, docs, sf_dir)
