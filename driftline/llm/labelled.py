"""Labelled rows for training: a bounded, deterministic sample that never touches the held-out fold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.base import fold, materialise, text_of

#: Labelled documents that a model learns from, at most; those with the smallest hashes of their ids are taken.
TRAIN_ROWS = 20_000


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, label): at most ``rows`` labelled documents outside the held-out fold, written to the shared folder.

    Null labels and ids teach nothing; an id labelled more than once has its largest label; an id with several texts gives
    the smallest text.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull()).filter(fold(id_col) != 0)
    known = known.groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")  # at most `rows` narrow rows
    return materialise(found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")), "training")
