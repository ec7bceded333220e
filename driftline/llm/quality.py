"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins at quantiles. Boosting goes round the features in a cycle; each step fits a tree of at most
four leaves to one feature's bins and adds it to that feature's lookup table. The pairs of features whose quadrants explain
most of what is left are then boosted alike on two-dimensional tables. A score is a sum of looked-up values, one vectorised
addition a table, put through the logistic function.

Features are counts and ratios over the whole text: kinds of characters, lengths, repetition of words and lines. Labels, lang,
source and doc_id are never among them; the held-out fold (crc32(id) mod 5 = 0) is never learnt from. The model learns on the
driver from a bounded sample (``labelled.TRAIN_ROWS``) of feature rows.

Nulls: a null text is empty; empty texts have zero features and get a score. Texts count whole, whatever their length.
Repeated rows get equal scores. Without labelled rows every score is 0.5. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.base import fold, fresh, load, text_of
from driftline.llm.labelled import TRAIN_ROWS, training_rows
from driftline.llm.token_files import batches_of
from driftline.llm.wordcache import split_words

#: Bytes of text that a task looks at at a time.
SLICE = 4_000_000
THRESHOLD = 0.3
_KINDS = ("upper", "lower", "digit", "space", "newline", "stop", "comma", "shout", "bar", "symbol", "other", "beyond")
FEATURES = (*(f"share_{k}" for k in _KINDS), "log_bytes", "log_words", "word_bytes", "distinct_words", "same_as_last", "most_of_a_word", "line_words", "distinct_lines", "short_words", "upper_of_letters")


def _kind_table() -> np.ndarray:
    table = np.full(256, _KINDS.index("other"), np.uint8)
    for kind, chars in {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": b" \t", "newline": b"\n\r", "stop": b".?", "comma": b",;:", "shout": b"!", "bar": b"|", "symbol": b"#$%&*@^~+=<>\\/_", "beyond": range(128, 256)}.items():
        table[list(chars)] = _KINDS.index(kind)
    return table


_TABLE = _kind_table()


def _repeats(codes: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For units coded and belonging to texts: each text's number of distinct units and the count of its commonest."""
    width = int(codes.max()) + 1 if len(codes) else 1
    key, count = np.unique(of.astype(np.int64) * width + codes, return_counts=True)
    owner = key // width
    most = np.zeros(n, np.int64)
    np.maximum.at(most, owner, count)
    return np.bincount(owner, minlength=n), most


def features(texts: pa.Array) -> np.ndarray:
    """(texts, FEATURES) float32."""
    n = len(texts)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(pc.cast(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), texts.cast(pa.string())), ""), pa.binary())[0].as_py(), np.uint8)
    of = np.repeat(np.arange(n, dtype=np.int32) * 16, sizes)
    kinds = np.bincount(of + _TABLE[data], minlength=16 * n).reshape(n, 16)[:, : len(_KINDS)]
    words, offsets = split_words(texts)
    n_words = np.diff(offsets)
    owner = np.repeat(np.arange(n), n_words)
    codes = pc.dictionary_encode(words).indices.to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, np.int32)
    distinct, most = _repeats(codes, owner, n)
    again = np.bincount(owner[1:][(codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])], minlength=n) if len(codes) > 1 else np.zeros(n)
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False)
    short = np.bincount(owner[lengths <= 3], minlength=n)
    lists = pc.split_pattern(texts, "\n")
    at = lists.offsets.to_numpy()
    lines = lists.values.slice(at[0], at[-1] - at[0])
    n_lines = np.diff(at)
    line_codes = pc.dictionary_encode(lines).indices.to_numpy(zero_copy_only=False)
    distinct_lines, _ = _repeats(line_codes, np.repeat(np.arange(n), n_lines), n)

    def over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a / np.maximum(b, 1)

    letters = kinds[:, 0] + kinds[:, 1]
    columns = [*(over(kinds, sizes[:, None]).T), np.log1p(sizes), np.log1p(n_words), over(np.bincount(owner, weights=lengths, minlength=n), n_words), over(distinct, n_words), over(again, n_words), over(most, n_words), over(n_words, n_lines), over(distinct_lines, n_lines), over(short, n_words), over(kinds[:, 0], letters)]
    return np.stack(columns, axis=1).astype(np.float32)


@dataclass
class AdditiveModel:
    """edges: cut points of each feature; tables: its values by bin; pairs: (f, g, coarse cut points of either, 2-d table)."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for f, (edge, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += table[np.searchsorted(edge, x[:, f], side="right")]
        for f, g, ef, eg, table in self.pairs:
            out += table[np.searchsorted(ef, x[:, f], side="right"), np.searchsorted(eg, x[:, g], side="right")]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logits(x)))


_LEAF = 5.0  # added to a leaf's curvature, so that few rows move little


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gt, ht = g.sum(), h.sum()
    gain = gl**2 / (hl + _LEAF) + (gt - gl) ** 2 / (ht - hl + _LEAF) - gt**2 / (ht + _LEAF)
    at = int(np.argmax(gain)) if len(gain) else -1
    return (float(gain[at]), at + 1) if at >= 0 else (0.0, 0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Step values over ordered bins of a tree with at most 2**depth leaves."""
    out = np.empty(len(g))

    def grow(a: int, b: int, left: int) -> None:
        gain, at = _best_cut(g[a:b], h[a:b]) if left and b - a > 1 else (0.0, 0)
        if gain > 1e-9:
            grow(a, a + at, left - 1)
            grow(a + at, b, left - 1)
        else:
            out[a:b] = -g[a:b].sum() / (h[a:b].sum() + _LEAF)

    grow(0, len(g), depth)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and step values of the best tree over two-dimensional bins that cuts one axis, then either part on the other."""
    best, values = 0.0, np.zeros_like(g)
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        base = gg.sum() ** 2 / (hh.sum() + _LEAF)
        for at in range(1, len(gg)):
            total, out = 0.0, np.empty_like(gg)
            for part in (slice(0, at), slice(at, None)):
                pg, ph = gg[part].sum(0), hh[part].sum(0)
                gain, cut = _best_cut(pg, ph)
                total += gain + pg.sum() ** 2 / (ph.sum() + _LEAF)
                for side in (slice(0, cut), slice(cut, None)):
                    out[part, side] = -pg[side].sum() / (ph[side].sum() + _LEAF)
            if total - base > best:
                best, values = total - base, (out.T if flip else out).copy()
    return best, values


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 150, rate: float = 0.15, n_pairs: int = 6, pair_bins: int = 8, pair_rounds: int = 30) -> AdditiveModel:
    """Learn from feature rows and 0/1 labels."""
    width = x.shape[1]
    if not len(y):
        return AdditiveModel(0.0, [np.zeros(0)] * width, [np.zeros(1)] * width)
    p = (y.sum() + 1) / (len(y) + 2)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    model = AdditiveModel(float(np.log(p / (1 - p))), edges, [np.zeros(len(e) + 1) for e in edges])
    score = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        prob = 1 / (1 + np.exp(-score))
        return prob - y, prob * (1 - prob)

    for _ in range(rounds):
        for f, b in enumerate(binned):
            g, h = slopes()
            n = len(model.tables[f])
            step = rate * _shallow_tree(np.bincount(b, g, n), np.bincount(b, h, n))
            model.tables[f] += step
            score += step[b]
    coarse = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, pair_bins + 1)[1:-1])) for f in range(width)]
    rough = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(coarse)]

    def grid(f: int, k: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(coarse[f]) + 1, len(coarse[k]) + 1)
        cell = rough[f] * shape[1] + rough[k]
        return np.bincount(cell, g, shape[0] * shape[1]).reshape(shape), np.bincount(cell, h, shape[0] * shape[1]).reshape(shape), cell

    g, h = slopes()
    gains = sorted(((_quadrants(*grid(f, k, g, h)[:2])[0], f, k) for f, k in combinations(range(width), 2)), reverse=True)[:n_pairs]
    model.pairs = [(f, k, coarse[f], coarse[k], np.zeros((len(coarse[f]) + 1, len(coarse[k]) + 1))) for _, f, k in gains]
    for _ in range(pair_rounds):
        for f, k, _, _, table in model.pairs:
            gg, hh, cell = grid(f, k, *slopes())
            step = rate * _quadrants(gg, hh)[1]
            table += step
            score += step.ravel()[cell]
    return model


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> AdditiveModel:
    """Fit on at most ``rows`` labelled documents, of which only features come to the driver."""

    def run(batches):
        for batch in batches:
            for part in batches_of(batch, SLICE):
                found = features(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float32()))], names=["doc_id", "label", "x"])

    rows_ = training_rows(docs, labels, label, rows).select(F.col("doc_id").cast("long"), "text", "label").mapInArrow(run, "doc_id long, label int, x array<float>").toPandas().sort_values("doc_id")
    x = np.stack(rows_["x"].to_list()) if len(rows_) else np.zeros((0, len(FEATURES)), np.float32)
    return fit(x.astype(np.float32), rows_["label"].to_numpy(np.float64))


def score(docs: DataFrame, model: AdditiveModel, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """All columns and the score."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in batches_of(batch, SLICE, at):
                texts = pc.fill_null(part.column(at).cast(pa.string()), "")
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.scores(features(texts)))], names=[*part.schema.names, out_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out_col, T.DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least the threshold, with the columns of ``docs``."""
    (name,) = fresh(docs, "score")
    return score(docs, learn(docs, labels), out_col=name).filter(F.col(name) >= threshold).select(*docs.columns)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    scored = score(docs.select("doc_id", text_of("text").alias("text")), learn(docs, load(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
