"""Toxicity: a factorization machine over hashed terms.

A document is the set of its terms: its lower-cased words and their beginnings of three to six characters (languages that
build words from stems share the beginnings), hashed to ``2**BITS`` buckets. A score is

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j,

so that a pair of terms, such as an insult beside a mention of a group, counts beyond the sum of the two. The pairwise part is
computed as half of (sum v x)^2 - sum (v x)^2 for each factor. x_i is log2(1 + count), capped. The machine has the terms whose
document counts differ most between the labels (chi-squared over the whole sample, summed on the executors); they are learnt
by AdaGrad on the driver from a bounded sample (``labelled.TRAIN_ROWS``), scoring is vectorised over sparse rows.

Labels, lang, source and doc_id are never inputs; the held-out fold is never learnt from. Nulls: a null text is empty; empty
texts have no terms and score the intercept. Texts count whole. Repeated rows get equal scores. Without labelled rows every
score is 0.5. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.base import fold, load, text_of
from driftline.llm.labelled import TRAIN_ROWS, training_rows
from driftline.llm.token_files import batches_of
from driftline.llm.wordcache import split_words

#: Bytes of text that a task looks at at a time.
SLICE = 4_000_000
THRESHOLD = 0.5
BITS, FACTORS, TERMS, CAP = 20, 4, 4096, 3.0
BEGINNINGS = (3, 4, 5, 6)
_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _bucket(terms: pa.Array, kind: int) -> np.ndarray:
    """Buckets of distinct strings; kind keeps words and beginnings apart."""
    seed, mask = zlib.crc32(bytes([kind])), (1 << BITS) - 1
    return np.fromiter((zlib.crc32(t, seed) & mask for t in pc.cast(terms, pa.binary()).to_pylist()), np.int32, len(terms))


def terms(texts: pa.Array, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count) of all terms, by text and bucket; ``only``: a flag for each bucket that counts."""
    words, offsets = split_words(pc.replace_substring_regex(pc.utf8_lower(texts), _GAPS, " "))
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    coded = pc.dictionary_encode(words)
    index, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    lengths = pc.utf8_length(distinct).to_numpy(zero_copy_only=False)
    found = []
    for kind in (0, *BEGINNINGS):
        if kind == 0:
            bucket = _bucket(distinct, 0)
        else:
            begun = pc.dictionary_encode(pc.utf8_slice_codeunits(distinct, 0, kind))
            bucket = _bucket(begun.dictionary, kind)[begun.indices.to_numpy(zero_copy_only=False)] if len(distinct) else np.zeros(0, np.int32)
            bucket = np.where(lengths > kind, bucket, -1)
        if only is not None:
            bucket = np.where((bucket >= 0) & only[bucket], bucket, -1)
        own = bucket[index] if len(index) else np.zeros(0, np.int32)
        there = own >= 0
        found.append((owner[there].astype(np.int64) << BITS) | own[there])
    key, count = np.unique(np.concatenate(found), return_counts=True)
    return key >> BITS, key & ((1 << BITS) - 1), count


@dataclass
class FactorizationMachine:
    """place: index of each bucket among the machine's terms, or -1; w0, w, v: intercept, weights, factors."""

    place: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray

    def logits(self, row: np.ndarray, term: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        out = self.w0 + np.bincount(row, self.w[term] * x, n)
        for f in range(self.v.shape[1]):
            vx = self.v[term, f] * x
            out += 0.5 * (np.bincount(row, vx, n) ** 2 - np.bincount(row, vx**2, n))
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        row, bucket, count = terms(texts, self.place >= 0)
        out = self.logits(row, self.place[bucket], value(count), len(texts))
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def value(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(1.0 + count), CAP)


def choose(bucket: np.ndarray, pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int, most: int = TERMS) -> np.ndarray:
    """The buckets whose document counts differ most between the labels, by chi-squared."""
    a, b = pos.astype(float), neg.astype(float)
    c, d = n_pos - a, n_neg - b
    chi = (n_pos + n_neg) * (a * d - b * c) ** 2 / np.maximum(n_pos * n_neg * (a + b) * (c + d), 1)
    order = np.lexsort((bucket, -chi))[:most]
    return np.sort(bucket[order[chi[order] > 6.6]])  # beyond chance at one in a hundred


def fit(row: np.ndarray, term: np.ndarray, x: np.ndarray, y: np.ndarray, n_terms: int, epochs: int = 40, batch: int = 256, rate: float = 0.1, l2: float = 1e-4, seed: int = 7) -> tuple[float, np.ndarray, np.ndarray]:
    """AdaGrad on sparse rows given in order of ``row``."""
    rng = np.random.default_rng(seed)
    n = len(y)
    p = (y.sum() + 1) / (n + 2)
    w0, w, v = float(np.log(p / (1 - p))), np.zeros(n_terms), rng.normal(0, 0.01, (n_terms, FACTORS))
    g0, gw, gv = 1e-6, np.full(n_terms, 1e-6), np.full((n_terms, FACTORS), 1e-6)
    begin = np.searchsorted(row, np.arange(n + 1))
    for _ in range(epochs):
        order = rng.permutation(n)
        for a in range(0, n, batch):
            rows = order[a : a + batch]
            sizes = begin[rows + 1] - begin[rows]
            ends = np.cumsum(sizes)
            at = np.repeat(begin[rows] - (ends - sizes), sizes) + np.arange(ends[-1])
            local, t, xv = np.repeat(np.arange(len(rows)), sizes), term[at], x[at]
            vx = v[t] * xv[:, None]
            sums = np.stack([np.bincount(local, vx[:, f], len(rows)) for f in range(FACTORS)], axis=1)
            squares = np.bincount(local, (vx**2).sum(1), len(rows))
            logit = w0 + np.bincount(local, w[t] * xv, len(rows)) + 0.5 * ((sums**2).sum(1) - squares)
            err = 1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y[rows]
            e = err[local] * xv
            touched, where = np.unique(t, return_inverse=True)
            dw = np.bincount(where, e, len(touched)) / len(rows) + l2 * w[touched]
            dv = np.stack([np.bincount(where, e * (sums[local, f] - vx[:, f]), len(touched)) for f in range(FACTORS)], axis=1) / len(rows) + l2 * v[touched]
            d0 = err.mean()
            g0 += d0**2
            gw[touched] += dw**2
            gv[touched] += dv**2
            w0 -= rate * d0 / np.sqrt(g0)
            w[touched] -= rate * dw / np.sqrt(gw[touched])
            v[touched] -= 0.5 * rate * dv / np.sqrt(gv[touched])
    return w0, w, v


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS) -> FactorizationMachine:
    sample = training_rows(docs, labels, label, rows).select("text", F.col("label").cast("int").alias("label"), F.col("doc_id").cast("string").alias("doc_id"))

    def count(batches):
        for batch in batches:
            for part in batches_of(batch, SLICE, 0):
                y = part.column(1).to_numpy(zero_copy_only=False)
                row, bucket, _ = terms(part.column(0))
                both = [np.bincount(bucket[y[row] == k], minlength=1 << BITS) for k in (1, 0)]
                there = np.flatnonzero(both[0] + both[1])
                yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(both[0][there]), pa.array(both[1][there])], names=["bucket", "pos", "neg"])

    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    empty = FactorizationMachine(np.full(1 << BITS, -1, np.int32), 0.0, np.zeros(0), np.zeros((0, FACTORS)))
    if not sizes:
        return empty
    # at most 2**BITS narrow rows; terms of fewer than three documents tell nothing
    counts = sample.mapInArrow(count, "bucket long, pos long, neg long").groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).filter("pos + neg >= 3").toPandas()
    chosen = choose(*(counts[c].to_numpy() for c in ("bucket", "pos", "neg")), sizes.get(1, 0), sizes.get(0, 0))
    place = empty.place
    place[chosen] = np.arange(len(chosen))

    def sparse(batches):
        for batch in batches:
            for part in batches_of(batch, SLICE, 0):
                row, bucket, n = terms(part.column(0), place >= 0)
                at = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(2), part.column(1), pa.ListArray.from_arrays(at, pa.array(place[bucket])), pa.ListArray.from_arrays(at, pa.array(value(n).astype(np.float32)))], names=["doc_id", "label", "term", "x"])

    told = sample.mapInArrow(sparse, "doc_id string, label int, term array<int>, x array<float>").toArrow()  # at most `rows` rows of terms that the machine has
    told = told.take(pc.sort_indices(told["doc_id"])).combine_chunks()  # the order of rows in a DataFrame is not fixed
    y, (term, x) = told["label"].to_numpy().astype(float), (told[c].combine_chunks() for c in ("term", "x"))
    row = np.repeat(np.arange(len(y)), pc.list_value_length(term).to_numpy(zero_copy_only=False))
    w0, w, v = fit(row, term.flatten().to_numpy().astype(np.int64), x.flatten().to_numpy().astype(float), y, len(chosen))
    return FactorizationMachine(place, w0, w, v)


def score(docs: DataFrame, machine: FactorizationMachine, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """All columns and the score."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in batches_of(batch, SLICE, at):
                texts = pc.fill_null(part.column(at).cast(pa.string()), "")
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(machine.scores(texts))], names=[*part.schema.names, out_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out_col, T.DoubleType())]))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    scored = score(docs.select("doc_id", text_of("text").alias("text")), learn(docs, load(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
