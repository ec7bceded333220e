"""Suffix-array dedup: removes every byte under a string of LENGTH bytes that also starts elsewhere.

1. Anchors. Of the k-grams in each LENGTH-byte window the one with the least hash is its anchor, so equal windows have equal
   anchors at equal places. Windows that share an anchor form a run; its bytes are a snippet. Counts and the least and largest
   snippet digest (XXH3 of its bytes, 128 bits) of each anchor, pre-aggregated before the shuffle, sort anchors into single
   ones (no window repeats), even ones (all snippets equal: all windows repeat) and mixed ones.
2. Mixed anchors: their distinct snippets, with how often each occurs, are gathered in collections of bounded size, and the
   suffixes of a collection are sorted by column-wise construction of its Burrows-Wheeler transform and common prefixes
   (``collection_bwt``), through files in the shared folder. A window repeats iff its suffix has LENGTH bytes in common with a
   neighbour, or its snippet occurs more than once.
3. Mixed anchors with more than GROUP distinct snippets (a common line in very many contexts) are cut again by longer anchors
   first; at k = LENGTH an anchor is the whole window and nothing is mixed. So no group is unbounded, and none is cut short.
4. Runs of repeated windows go back to their documents, whose covered bytes are dropped.

Equality is that of 128-bit digests of the bytes in step 1 and of bytes in step 2, where snippets of one anchor whose digests
agree in 64 bits are one. Only documents with a snippet to sort, or something to remove, have their texts shuffled. Strings never cross documents and are judged on the input. Nulls:
a null text is empty; texts shorter than LENGTH bytes keep everything. Rows that repeat an id and a text are documents that
repeat each other. Empty table: empty result. Very long texts are cut into overlapping parts for hashing only. Other columns
are ignored.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.base import TEXT_BATCH, failing, load, made, materialise, maybe_broadcast, narrowed, passing, release, scratch, sieve, text_of
from driftline.llm.collection_bwt import SYMBOL, RoundFiles, build
from driftline.llm.token_files import batches_of, tidy

LENGTH = 200
#: Anchor lengths of the first pass and of the passes for anchors with many snippets.
ANCHORS = (64, 120, 160, 184, 200)
#: Distinct snippets of an anchor that may share a collection.
GROUP = 512
#: Bytes of snippets in one collection.
COLLECTION = 2_000_000
_PART = 1_500_000  # bytes hashed at a time
_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(411).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse mod 2**64, for i < n at least."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def runs(data: np.ndarray, offsets: np.ndarray, k: int, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, start in data, windows, anchor, and both halves of the snippet's digest) of the runs of all texts, in order."""
    sizes = np.diff(offsets)
    windows = np.maximum(sizes - length + 1, 0)
    total = int(windows.sum())
    if not total:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64, np.int64))
    up, down = _powers(len(data) + 1)
    sums = np.r_[np.uint64(0), np.cumsum(_TABLE[data] * up[: len(data)])]
    grams = _mix((sums[k:] - sums[:-k]) * down[: len(data) - k + 1])
    place = np.uint64((1 << 23) - 1)
    least, span, width = (grams & ~place) | np.arange(len(grams), dtype=np.uint64), 1, length - k + 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    ends = np.cumsum(windows)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), windows)
    start = np.arange(total) + np.repeat(offsets[:-1] - (ends - windows), windows)
    anchor = (least[start] & place).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
    count = np.diff(np.r_[first, total])
    begin = start[first]
    whole, each = data.tobytes(), xxhash.xxh3_128_digest
    digest = b"".join([each(whole[a:b]) for a, b in zip(begin.tolist(), (begin + count - 1 + length).tolist(), strict=True)])
    return owner[first].astype(np.int64), begin, count, grams[anchor[first]], *np.frombuffer(digest, "<i8").reshape(-1, 2).T


def _parts(texts: pa.Array):
    """(text numbers, places in the texts, bytes, offsets) of about _PART bytes each; a longer text in overlapping parts, which cut runs but lose no window."""
    raw = pc.cast(texts, pa.binary())
    for i, t in enumerate(raw):
        t = t.as_buffer()
        if t is not None and len(t) > 2 * _PART:
            data = np.frombuffer(t, np.uint8)
            for a in range(0, len(data) - LENGTH + 1, _PART):
                part = data[a : a + _PART + LENGTH - 1]
                yield np.array([i]), np.array([a]), part, np.array([0, len(part)])
    sizes = pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.flatnonzero((sizes >= LENGTH) & (sizes <= 2 * _PART))
    group = np.cumsum(sizes[rows]) // _PART
    for g in np.unique(group).tolist():
        own = rows[group == g]
        data = np.frombuffer(b"".join(raw.take(pa.array(own)).to_pylist()), np.uint8)
        yield own, np.zeros(len(own), np.int64), data, np.r_[0, np.cumsum(sizes[own])]


def occurrences(docs: DataFrame) -> DataFrame:
    """docs (doc_id, th, text) -> (anchor, snip, proof, doc_id, th, at): a row a run; snip and proof are its digest, at = start * 256 + windows."""
    k = ANCHORS[0]

    def run(batches):
        for batch in batches:
            for part in batches_of(batch, column=2):
                for own, moved, data, offsets in _parts(part.column(2)):
                    text, start, count, anchor, snip, proof = runs(data, offsets, k)
                    row = pa.array(own[text])
                    at = (start - offsets[text] + moved[text]) * 256 + count
                    yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(snip), pa.array(proof), part.column(0).take(row), part.column(1).take(row), pa.array(at)], names=["anchor", "snip", "proof", "doc_id", "th", "at"])

    return docs.mapInArrow(run, "anchor long, snip long, proof long, doc_id long, th long, at long")


def kinds(rows: DataFrame, weight=None) -> DataFrame:
    """(anchor, snip, proof) -> (anchor, even) of the anchors that occur more than once; partial sums before the shuffle."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    ends = [f(c).alias(f"{name}_{c}") for c in ("snip", "proof") for f, name in ((F.min, "low"), (F.max, "high"))]
    even = (F.col("low_snip") == F.col("high_snip")) & (F.col("low_proof") == F.col("high_proof"))
    return rows.groupBy("anchor").agg(n.alias("n"), *ends).filter("n > 1").select("anchor", even.alias("even"))


def snippet_bytes(reps: DataFrame, docs: DataFrame) -> DataFrame:
    """reps (anchor, snip, n, rep(doc_id, th, at)) -> (anchor, snip, n, data), written."""
    per = reps.select("rep.doc_id", "rep.th", F.struct("anchor", "snip", "n", "rep.at").alias("s")).groupBy("doc_id", "th").agg(F.collect_list("s").alias("s"))  # at most one a window of the document
    wanted = materialise(per.withColumnsRenamed({"doc_id": "_id", "th": "_th"}), "wanted")
    near, keys = narrowed(docs, "th", wanted.select(F.col("_id").alias("_i"), F.col("_th").alias("_t")), "_t", wanted.count())
    texts = near.join(keys, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("th") == F.col("_t")), "left_semi")
    texts = texts.dropDuplicates(["doc_id", "th"])
    joined = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))).select("text", "s")

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                lists = part.column(1)
                anchor, snip, n, at = lists.flatten().flatten()
                at, edges, parts = at.to_numpy(), (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist(), []
                begin, end = (at // 256).tolist(), (at // 256 + at % 256 - 1 + LENGTH).tolist()
                for data, x, y in zip(pc.cast(part.column(0), pa.binary()).to_pylist(), edges[:-1], edges[1:], strict=True):
                    parts += [data[i:j] for i, j in zip(begin[x:y], end[x:y], strict=True)]
                yield pa.RecordBatch.from_arrays([anchor, snip, n, pa.array(parts, pa.binary())], names=["anchor", "snip", "n", "data"])

    return materialise(joined.mapInArrow(run, "anchor long, snip long, n long, data binary"), "snippets", TEXT_BATCH)


def flagged(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, folder: str) -> np.ndarray:
    """For each byte of the snippets whether a repeated window starts there."""
    files = RoundFiles(f"{folder}/{uuid.uuid4().hex}")
    out, last = np.zeros(len(data), bool), np.zeros(0, np.int32)
    for place, common in build(data, offsets, files):
        alike = np.flatnonzero(common >= LENGTH // SYMBOL)
        place = np.r_[last, place]  # with the last one of the block before
        out[place[alike + len(last)]] = out[place[alike + len(last) - 1]] = True
        last = place[-1:]
    files.clear()
    start, sizes = offsets[:-1], np.diff(offsets)
    full = np.repeat(weights > 1, np.maximum(sizes - LENGTH + 1, 0))
    windows = np.maximum(sizes - LENGTH + 1, 0)
    at = np.arange(len(full)) + np.repeat(start - (np.cumsum(windows) - windows), windows)
    out[at[full]] = True
    return out


def _stretches(flags: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, start in it, length) of the runs of flags, none across strings."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    on = np.flatnonzero(flags)
    if not len(on):
        return (np.zeros(0, np.int64),) * 3
    first = np.flatnonzero(np.r_[True, (on[1:] != on[:-1] + 1) | (owner[on[1:]] != owner[on[:-1]])])
    begin = on[first]
    return owner[begin], begin - offsets[owner[begin]], np.diff(np.r_[first, len(on)])


def sorted_collections(snippets: DataFrame, folder: str) -> DataFrame:
    """(anchor, snip, n, data) -> (anchor, snip, rel): repeated windows of each snippet; rel = start * 256 + windows."""
    spread = snippets.select("anchor", "snip", "n", "data").repartition("anchor").sortWithinPartitions("anchor")

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0

        def done():
            table = pa.Table.from_batches(held).combine_chunks()
            data = table.column("data").chunk(0)
            offsets = np.r_[0, np.cumsum(pc.binary_length(data).to_numpy().astype(np.int64))]
            flags = flagged(np.frombuffer(b"".join(data.to_pylist()), np.uint8), offsets, table.column("n").to_numpy(), folder)
            who, start, count = _stretches(flags, offsets)
            row = pa.array(who)
            return pa.RecordBatch.from_arrays([table.column("anchor").chunk(0).take(row), table.column("snip").chunk(0).take(row), pa.array(start * 256 + count)], names=["anchor", "snip", "rel"])

        last = None
        for batch in batches:
            anchor = batch.column(0).to_numpy()
            edges = np.r_[0, np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor)].tolist() if len(anchor) else [0]
            lens = np.r_[0, np.cumsum(pc.binary_length(batch.column(3)).to_numpy())]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if size > COLLECTION and anchor[a] != last:
                    yield done()
                    held, size = [], 0
                held.append(batch.slice(a, b - a))
                size, last = size + int(lens[b] - lens[a]), anchor[a]
        if held:
            yield done()
        tidy()

    return spread.mapInArrow(run, "anchor long, snip long, rel long")


def _cut_again(snippets: DataFrame, k: int) -> DataFrame:
    """(anchor, snip, n, data) -> (anchor, snip, proof, up_anchor, up_snip, off, count, n, data): the runs of snippets by longer anchors, and where they are in the snippet."""

    def run(batches):
        for batch in batches:
            for part in batches_of(batch, _PART, column=3):
                raw = part.column(3)
                offsets = np.r_[0, np.cumsum(pc.binary_length(raw).to_numpy().astype(np.int64))]
                joined = b"".join(raw.to_pylist())
                text, start, count, anchor, snip, proof = runs(np.frombuffer(joined, np.uint8), offsets, k)
                row = pa.array(text)
                data = [joined[a:b] for a, b in zip(start.tolist(), (start + count - 1 + LENGTH).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(snip), pa.array(proof), part.column(0).take(row), part.column(1).take(row), pa.array(start - offsets[text]), pa.array(count), part.column(2).take(row), pa.array(data, pa.binary())], names=["anchor", "snip", "proof", "up_anchor", "up_snip", "off", "count", "n", "data"])

    return snippets.select("anchor", "snip", "n", "data").mapInArrow(run, "anchor long, snip long, proof long, up_anchor long, up_snip long, off long, count long, n long, data binary")


def mixed_windows(snippets: DataFrame) -> DataFrame:
    """snippets (anchor, snip, n, data) of mixed anchors -> (anchor, snip, rel): each snippet's repeated windows."""
    folder = scratch(snippets.sparkSession, "rounds")
    rows, up, found = snippets, None, []

    def placed(part: DataFrame) -> DataFrame:
        """(anchor, snip, rel) of a level's snippets as places in the first level's."""
        if up is None:
            return part
        return part.join(up, ["anchor", "snip"]).select(F.col("top_anchor").alias("anchor"), F.col("top_snip").alias("snip"), (F.col("base") * 256 + F.col("rel")).alias("rel"))

    for k in ANCHORS[1:]:
        large = materialise(rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > GROUP).select("anchor"), "large")
        n = large.count()
        found.append(placed(sorted_collections(rows.join(maybe_broadcast(large, n), "anchor", "left_anti"), folder)))
        if not n:
            break
        cut = materialise(_cut_again(rows.join(maybe_broadcast(large, n), "anchor", "left_semi"), k), "cut")
        kind = materialise(kinds(cut, "n"), "anchors")
        even = cut.join(kind.filter("even"), "anchor").select(F.col("up_anchor").alias("anchor"), F.col("up_snip").alias("snip"), (F.col("off") * 256 + F.col("count")).alias("rel"))
        found.append(placed(even))
        mixed = cut.join(kind.filter("NOT even"), "anchor")
        ways = mixed.select(F.col("anchor").alias("_a"), F.col("snip").alias("_s"), F.col("up_anchor").alias("anchor"), F.col("up_snip").alias("snip"), "off")
        if up is None:
            ways = ways.select("_a", "_s", F.col("anchor").alias("top_anchor"), F.col("snip").alias("top_snip"), F.col("off").alias("base"))
        else:
            ways = ways.join(up, ["anchor", "snip"]).select("_a", "_s", "top_anchor", "top_snip", (F.col("base") + F.col("off")).alias("base"))
        rows = materialise(mixed.groupBy("anchor", "snip").agg(F.sum("n").alias("n"), F.min("data").alias("data")), "classes")
        up = materialise(ways.withColumnsRenamed({"_a": "anchor", "_s": "snip"}), "ways")
    return reduce(DataFrame.unionByName, found)


def repeated_windows(docs: DataFrame) -> DataFrame:
    """docs (doc_id, th, text) -> (doc_id, th, at): runs of windows that also start elsewhere; at = start * 256 + windows."""
    seen = occurrences(docs)
    kind = materialise(kinds(seen), "anchors")
    near, repeated = narrowed(seen, "anchor", kind, "anchor", kind.count())  # most anchors are single: their runs aren't shuffled
    hits = near.join(repeated, "anchor").select(F.when(~F.col("even"), F.col("anchor")).alias("anchor"), F.when(~F.col("even"), F.col("snip")).alias("snip"), "doc_id", "th", "at")
    hits = materialise(hits, "hits")
    mixed = hits.filter("anchor IS NOT NULL")
    reps = mixed.groupBy("anchor", "snip").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "th", "at")).alias("rep"))
    windows = materialise(mixed_windows(snippet_bytes(reps, docs)).groupBy("anchor", "snip").agg(F.collect_list("rel").alias("rel")), "windows")  # at most one a window
    placed = mixed.join(windows, ["anchor", "snip"]).select("doc_id", "th", F.floor(F.col("at") / 256).cast("long").alias("start"), F.explode("rel").alias("rel"))
    placed = placed.select("doc_id", "th", (F.col("start") * 256 + F.col("rel")).alias("at"))
    return hits.filter("anchor IS NULL").select("doc_id", "th", "at").union(placed)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (the removed stretches, array<struct<start,end>>) and kept (binary, what remains) of each document."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn("th", F.xxhash64("text")).select("doc_id", "th", "text")
    spark = docs.sparkSession
    first = made(spark)
    marks = repeated_windows(base).groupBy("doc_id", "th").agg(F.collect_list("at").alias("at"))  # at most one a window of the document
    marks = materialise(marks.withColumnsRenamed({"doc_id": "_id", "th": "_th"}), "marks")
    release(spark, first, keep=marks)
    bits = sieve(marks, "_th", marks.count())
    marked = passing(base, "th", bits).join(marks, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left").select("doc_id", "text", "at")
    joined = marked.unionAll(failing(base, "th", bits).select("doc_id", "text", F.lit(None).cast("array<long>").alias("at")))

    def run(batches):
        for batch in batches:
            for part in batches_of(batch):
                spans, kept, sizes = [], [], []
                for t, at in zip(pc.cast(part.column(1), pa.binary()).to_pylist(), part.column(2), strict=True):
                    own: list[tuple[int, int]] = []
                    if at.is_valid:
                        v = np.sort(at.values.to_numpy())
                        begin, end = v // 256, np.maximum.accumulate(v // 256 + v % 256 - 1 + LENGTH)
                        first = np.flatnonzero(np.r_[True, begin[1:] > end[:-1]])
                        own = list(zip(begin[first].tolist(), end[np.r_[first[1:] - 1, len(v) - 1]].tolist(), strict=True))
                    cuts = [0, *(x for s in own for x in s), len(t)]
                    kept.append(b"".join(t[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)) if own else t)
                    spans.append([{"start": a, "end": b} for a, b in own])
                    sizes.append(len(t))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(load(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    return out.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5(h[2 * i + 1:2 * i + {2 * LENGTH}]) AS g FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - {LENGTH - 1}, 0))) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS c FROM w) WHERE c > 1),
b AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > {LENGTH}, true) AS new FROM r),
s AS (SELECT doc_id, min(i) AS a, max(i) + {LENGTH} AS z FROM (SELECT doc_id, i, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM b) GROUP BY doc_id, k),
n AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_ FROM s),
k AS (SELECT n.doc_id, sum(z - a) AS gone, count(*) AS spans, string_agg(h[2 * from_ + 1:2 * a], '' ORDER BY a) || max(h)[2 * max(z) + 1:] AS kept FROM n JOIN d USING (doc_id) GROUP BY n.doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
