"""MinHash near-dedup: universal hash minima, banding, signature verification, full-set verification, connected components.

1. Each text's set of distinct k-word shingles (64-bit hashes) gives BANDS * ROWS minima of universal hashes a*x + b mod 2^64
   and a 128-bit key of the set. Texts with equal sets are one class from here on.
2. Classes meet in buckets, one for each band of ROWS minima. At a similarity of 0.8 two sets miss all 32 bands of four with a
   probability of 5e-8.
3. Star rounds: in each bucket one class is the hub, and pairs go from the hub to classes of other components only; pairs
   whose signatures agree in too few places are dropped, the others are confirmed on the full sets, and confirmed links are
   joined into components. Buckets whose classes are all in one component are done, which for a large group of near copies
   happens without enumerating its pairs.
4. What is left: buckets that still hold several components. In those of at most SMALL classes all classes of unlike components
   meet by signature, each pair in its first common band.
5. The classes of larger ones, such as pages of one template that are less similar than the threshold, would meet in numbers
   that grow with the square of the bucket. They go through a prefix-filtered join of their full sets instead, exact and
   without buckets: shingles are put in one order for all, the rarest first, and two sets as similar as the threshold share
   one among the first few of each, at places that leave room for enough common shingles after it. What pages of a template
   have in common comes late in that order. Rounds with a hub for each shingle join dense groups first. Then the classes that
   still meet across components at some shingle are gathered around the component that has most of its places, and compared in
   tiles of at most TILE by TILE classes spread over the tasks: by signature, and on the full sets unless the tile has joined
   the two already. So no list of pairs arises, and no link is lost to a cap.
6. Components by alternating large-star and small-star after each step.

Texts are read again only for the classes in surviving pairs. Nulls: a null text is empty; texts without words have empty sets
and are linked with nothing; a null id is never the smallest of a component unless alone in it. Texts shorter than k words are
one shingle. Rows with one id and text carry the same answer. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.base import PAIR_BATCH, TEXT_BATCH, discard, drop_rows, load, materialise, maybe_broadcast, narrowed, text_of
from driftline.llm.components import components
from driftline.llm.token_files import batches_of, tidy
from driftline.llm.wordcache import split_words

WORDS, THRESHOLD = 5, 80
BANDS, ROWS = 32, 4
#: Signatures that agree in fewer of the 128 places are not of sets as similar as 0.8: the mean is 102.4 there, the deviation 4.5.
AGREE = 76
STAR_ROUNDS = 2
#: Buckets of at most so many classes list all their pairs across components.
SMALL = 32
#: Rounds with a hub for each shingle, made while the pairs to compare may be more than LISTED times the places they come from and
#: the round before found a link for each HUB_YIELD places at least.
HUB_ROUNDS, LISTED, HUB_YIELD = 4, 64, 100
TILE = 256
#: Bytes of text that a task turns into shingles at a time.
SLICE = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def _mix(h: np.ndarray, m: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(m)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, each text's rising, and where each text's begin."""
    words, offsets = split_words(pc.ascii_lower(texts))
    coded = pc.dictionary_encode(words)
    distinct = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in pc.cast(coded.dictionary, pa.binary()).to_pylist()), np.uint64, len(coded.dictionary))
    hashes = distinct[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.uint64)
    n_words = np.diff(offsets)
    n = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(n_words.dtype))
    owner = np.repeat(np.arange(len(texts)), n)
    ends = np.cumsum(n)
    start = np.repeat(np.asarray(offsets[:-1]) - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
    width = np.minimum(np.repeat(n_words, n), k)
    h = width.astype(np.uint64)
    for j in range(k):
        inside = j < width
        h = np.where(inside, h * _BASE + hashes[np.minimum(start + j, max(len(hashes) - 1, 0))], h) if len(hashes) else h
    h = _mix(h)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])] if len(h) else np.zeros(0, bool)
    return h[new], np.r_[0, np.cumsum(np.bincount(owner[new], minlength=len(texts)))]


def signatures(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, BANDS * ROWS) uint32 minima; rows of empty sets are all ones."""
    out = np.full((len(offsets) - 1, BANDS * ROWS), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        starts, buffer = offsets[full], np.empty(len(h), np.uint64)
        for j in range(BANDS * ROWS):
            np.multiply(h, _A[j], out=buffer)
            buffer += _B[j]
            out[full, j] = np.minimum.reduceat(buffer, starts) >> np.uint64(32)
    return out


def _set_keys(h: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """128-bit keys of the sets: two sums of mixed hashes, which don't depend on order."""
    sums = [np.r_[np.uint64(0), np.cumsum(_mix(h, m))] for m in (0x9FB21C651E98DF25, 0xA24BAED4963EE407)]
    both = np.stack([s[offsets[1:]] - s[offsets[:-1]] for s in sums], axis=1).astype(">u8")
    return [r.tobytes() for r in both]


def sketch(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, n, key, sig): th is a hash of the text, key and sig are null for empty sets."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for part in batches_of(batch, SLICE):
                h, offsets = shingles(part.column(1), k)
                n = np.diff(offsets)
                sig = signatures(h, offsets)
                keys = [x if c else None for x, c in zip(_set_keys(h, offsets), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n.astype(np.int64)), pa.array(keys, pa.binary()), pa.array([s.tobytes() if x else None for s, x in zip(sig, keys, strict=True)], pa.binary())], names=["doc_id", "th", "n", "key", "sig"])

    return base.withColumn("th", F.xxhash64("text")).mapInArrow(run, "doc_id long, th long, n long, key binary, sig binary")


def _sig_array(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, BANDS * ROWS)


def _band_hashes(sig: np.ndarray) -> np.ndarray:
    """(rows, BANDS) hashes of the bands, each band its own kind."""
    grouped = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sig), BANDS)).copy()
    for j in range(ROWS):
        h = _mix(h * _BASE + grouped[:, :, j])
    return h


def buckets(classes: DataFrame) -> DataFrame:
    """(key, sig) -> (h, band, key), a row for each class and band."""

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 4000):
                part = batch.slice(a, 4000)
                h = _band_hashes(_sig_array(part.column(1)))
                n = part.num_rows
                keys = part.column(0).take(pa.array(np.repeat(np.arange(n), BANDS)))
                yield pa.RecordBatch.from_arrays([pa.array(h.ravel().view(np.int64)), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), n)), keys], names=["h", "band", "key"])

    return classes.select("key", "sig").mapInArrow(run, "h long, band int, key binary")


def _agreeing(pairs: DataFrame, classes: DataFrame, agree: int) -> DataFrame:
    """Pairs (a, b) whose signatures agree in enough places."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                same = (_sig_array(batch.column(2)) == _sig_array(batch.column(3))).sum(axis=1)
                yield batch.filter(pa.array(same >= agree)).select([0, 1])

    one, two = (classes.select(F.col("key").alias(c), F.col("sig").alias(f"sig_{c}")) for c in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a binary, b binary")


def _texts(keys: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(key) distinct -> (key, text), the text of one document of each class; written. docs: (doc_id, th, text)."""
    wanted = materialise(keys.join(classes.select("key", "rep"), "key").select("key", F.col("rep.doc_id").alias("_id"), F.col("rep.th").alias("_th")), "wanted")
    near, side = narrowed(docs, "th", wanted, "_th", wanted.count())
    texts = near.join(side, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))).select("key", "text")
    texts = materialise(texts.groupBy("key").agg(F.min("text").alias("text")), "texts")
    discard(wanted)
    return texts


def _sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    h, offsets = shingles(texts, k)
    return [h[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def _similar(x: np.ndarray, y: np.ndarray, threshold: int) -> bool:
    """100 * |x & y| >= threshold * |x | y|, for sets as rising arrays that aren't empty."""
    if 100 * min(len(x), len(y)) < threshold * max(len(x), len(y)):
        return False
    small, large = (x, y) if len(x) < len(y) else (y, x)
    common = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
    return 100 * common >= threshold * (len(x) + len(y) - common)


def confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; written. docs: (doc_id, th, text)."""
    texts = _texts(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), classes, docs)

    def run(batches):
        for batch in batches:
            both = pc.add(pc.binary_length(batch.column(2)), pc.binary_length(batch.column(3))).to_numpy().astype(np.int64)
            edges = np.r_[0, np.flatnonzero(np.diff(np.cumsum(both) // SLICE)) + 1, batch.num_rows].tolist()
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(a, b - a)
                coded = pc.dictionary_encode(pa.concat_arrays([part.column(2), part.column(3)]))
                sets, index, n = _sets(coded.dictionary, k), coded.indices.to_numpy(), part.num_rows
                good = [_similar(sets[a], sets[b], threshold) for a, b in zip(index[:n].tolist(), index[n:].tolist(), strict=True)]
                yield part.filter(pa.array(good, pa.bool_())).select([0, 1])
        tidy()

    one, two = (texts.select(F.col("key").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    found = materialise(joined.mapInArrow(run, "a binary, b binary"), "links", PAIR_BATCH)
    discard(texts)
    return found


def small_buckets(lab: DataFrame, classes: DataFrame, agree: int) -> DataFrame:
    """lab (h, band, key, comp) of buckets with at most SMALL classes -> (a, b): the pairs across components whose signatures agree enough, each in its first common band only."""
    deal = int(lab.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the work goes by pairs, not by bytes, so partitions aren't merged by size
    rows = lab.join(classes.select("key", "sig"), "key").select("h", "band", "key", "comp", "sig").repartition(deal, "h").sortWithinPartitions("h")

    def compare(group: pa.Table) -> list[tuple[bytes, bytes]]:
        band, key = group.column("band")[0].as_py(), group.column("key").to_pylist()
        comp = pc.dictionary_encode(group.column("comp").combine_chunks()).indices.to_numpy()
        sig, out = _sig_array(group.column("sig").combine_chunks()), []
        bands = _band_hashes(sig)
        for x in range(len(key) - 1):
            ys = np.flatnonzero(comp[x + 1 :] != comp[x]) + x + 1
            ys = ys[(sig[ys] == sig[x]).sum(axis=1) >= agree]
            out += [(key[x], key[y]) for y in ys[(bands[ys] == bands[x]).argmax(axis=1) == band].tolist()]
        return out

    return rows.mapInArrow(_grouped(1, compare), "a binary, b binary")


def _grouped(columns: int, compare):
    """For mapInArrow: pairs (a, b) that ``compare`` finds in each group of neighbouring rows that agree in the leading columns (long, or any number type)."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        last = None

        def done(found: list[tuple[bytes, bytes]]):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found, strict=True)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            found: list[tuple[bytes, bytes]] = []
            group = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(columns)], axis=1)
            edges = np.r_[0, np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1, batch.num_rows].tolist()
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if last != group[a].tolist():
                    if held:
                        found += compare(pa.Table.from_batches(held))
                    held, last = [], group[a].tolist()
                held.append(batch.slice(a, b - a))
            if found:
                yield done(found)
        if held and (found := compare(pa.Table.from_batches(held))):
            yield done(found)
        tidy()

    return run


def full_sets(keys: DataFrame, classes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(key) distinct -> (key, n, grams), written: the shingle hashes of each class, rising as unsigned numbers."""
    texts = _texts(keys, classes, docs)

    def run(batches):
        for batch in batches:
            for part in batches_of(batch, SLICE):
                h, offsets = shingles(part.column(1), k)
                grams = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets).astype(np.int64)), grams], names=["key", "n", "grams"])

    sets = materialise(texts.mapInArrow(run, "key binary, n long, grams array<long>"), "sets", TEXT_BATCH)
    discard(texts)
    return sets


def prefixes(sets: DataFrame, threshold: int) -> DataFrame:
    """(key, n, grams) -> (g, key, n, most), written: the places at which a similar set can share its first shingle.

    Order: shingles that no other set has, then by the number of sets that have them, then by hash. Two sets of a and b
    shingles are similar enough iff (100 + threshold) * common >= threshold * (a + b). If the first that they share, in
    order, is at place p (from 0) of the one of a, common <= a - p, so b is at most
    most = ((100 + threshold) * (a - p) - threshold * a) / threshold. Places whose ``most`` is less than any similar set has are
    left out: what remains is a fifth of a set.
    """
    each = sets.select("key", "n", F.explode("grams").alias("g"))
    shared = each.groupBy("g").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    met = each.join(shared, "g").groupBy("key", "n").agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("x"))  # at most the set's size
    met = met.select("key", "n", F.posexplode("x").alias("i", "x"), (F.col("n") - F.size("x")).alias("alone"))
    most = F.floor(((100 + threshold) * (F.col("n") - F.col("alone") - F.col("i")) - threshold * F.col("n")) / threshold).cast("long")
    out = met.select(F.col("x.g").alias("g"), "key", "n", most.alias("most")).filter(100 * F.col("most") >= threshold * F.col("n"))
    return materialise(out, "prefixes")


def agreeing_sets(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; written."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                x, y = ([v.values.to_numpy().view(np.uint64) for v in part.column(c)] for c in (2, 3))
                yield part.filter(pa.array([_similar(i, j, threshold) for i, j in zip(x, y, strict=True)], pa.bool_())).select([0, 1])
        tidy()

    one, two = (sets.select(F.col("key").alias(c), F.col("grams").alias(f"grams_{c}")) for c in "ab")
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "grams_a", "grams_b")
    return materialise(joined.mapInArrow(run, "a binary, b binary"), "links", PAIR_BATCH)


def _met(places: DataFrame, comps: DataFrame) -> DataFrame:
    """(g, key, n, most, comp, main, total, listed), written: the places at shingles that still have several components, of which main is the one with most places."""
    rows = places.join(comps, "key")
    per = rows.groupBy("g", "comp").agg(F.count(F.lit(1)).alias("c"), F.max((F.col("most") >= F.col("n")).cast("int")).alias("smaller"))
    per = per.groupBy("g").agg(F.max(F.struct("c", "comp")).alias("x"), F.sum("c").alias("total"), F.max("smaller").alias("smaller")).filter("total > x.c AND smaller = 1")
    per = per.select("g", F.col("x.comp").alias("main"), "total", ((F.col("total") - F.col("x.c")) * F.col("total").cast("double")).alias("listed"))
    return materialise(rows.join(per, "g"), "met")


def _fitting(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """Pairs (a, b) of two sides' places at one shingle, in unlike components, each of a size that the other's place allows."""
    other = theirs.select("g", F.col("key").alias("_k"), F.col("comp").alias("_c"), F.col("n").alias("_n"), F.col("most").alias("_m"))
    both = mine.join(other, "g").filter((F.col("comp") != F.col("_c")) & (F.col("n") <= F.col("_m")) & (F.col("_n") <= F.col("most")))
    return both.select(F.least("key", "_k").alias("a"), F.greatest("key", "_k").alias("b")).distinct()


def tiles(met: DataFrame, classes: DataFrame, sets: DataFrame, agree: int, threshold: int) -> DataFrame:
    """met -> (a, b), written: links that join all components whose classes meet at some shingle.

    A class belongs to the ring of each main component of its places, ``other`` unless it is of that component. In a ring the
    others are compared with the main ones and among each other: that covers each pair that meets, since at least one of the two
    is other at the shingle where they do.
    """
    deal = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = met.select(F.xxhash64("main").alias("ring"), "key", "comp", (F.col("comp") != F.col("main")).alias("other")).distinct()
    per = rows.groupBy("ring").agg(F.ceil(F.count_if(~F.col("other")) / TILE).alias("tm"), F.ceil(F.count_if("other") / TILE).alias("to")).filter("to > 0")
    rows = rows.join(per, "ring").withColumn("own", F.pmod(F.xxhash64("key"), F.when(F.col("other"), F.col("to")).otherwise(F.col("tm"))))

    # the tiles (kind, i, j) in which a row takes part: kind 0 crosses others i with main ones j, kind 1 others i with others j >= i
    def tile(kind: int, i, j):
        return F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("i"), j.cast("long").alias("j"))

    def up_to(c: str):
        return F.when(F.col(c) > 0, F.sequence(F.lit(0).cast("long"), F.col(c) - 1)).otherwise(F.array().cast("array<long>"))

    crossing = F.transform(up_to("tm"), lambda j: tile(0, F.col("own"), j))
    among = F.transform(up_to("to"), lambda j: tile(1, F.least(F.col("own"), j), F.greatest(F.col("own"), j)))
    serving = F.transform(up_to("to"), lambda i: tile(0, i, F.col("own")))
    rows = rows.join(classes.select("key", "sig"), "key").join(sets.select("key", "n", "grams"), "key")
    rows = rows.withColumn("t", F.explode(F.when(F.col("other"), F.concat(crossing, among)).otherwise(serving)))
    rows = rows.select("ring", "t.kind", "t.i", "t.j", "other", "own", "key", "comp", "n", "sig", "grams")
    rows = rows.repartition(deal, "ring", "kind", "i", "j").sortWithinPartitions("ring", "kind", "i", "j", "key")

    def compare(group: pa.Table) -> list[tuple[bytes, bytes]]:
        kind, i, j = (group.column(c)[0].as_py() for c in ("kind", "i", "j"))
        key, n = group.column("key").to_pylist(), group.column("n").to_numpy()
        comp = pc.dictionary_encode(group.column("comp").combine_chunks()).indices.to_numpy()
        other, own = group.column("other").to_numpy(), group.column("own").to_numpy()
        left, right = (np.flatnonzero(other & (own == i)), np.flatnonzero(~other if kind == 0 else own == j))
        sig, lists = _sig_array(group.column("sig").combine_chunks()), group.column("grams").combine_chunks()
        up, out = np.arange(len(key)), []  # the component that each component has been joined to

        def root(c: int) -> int:
            while up[c] != c:
                c = up[c]
            return c

        def grams(x: int) -> np.ndarray:
            return lists[x].values.to_numpy().view(np.uint64)

        for x in left.tolist():
            ys = right[right > x] if kind == 1 and i == j else right
            ys = ys[(comp[ys] != comp[x]) & (100 * np.minimum(n[ys], n[x]) >= threshold * np.maximum(n[ys], n[x]))]
            same = (sig[ys] == sig[x]).sum(axis=1)
            for y in ys[same >= agree][np.argsort(-same[same >= agree], kind="stable")].tolist():  # the likeliest first
                if root(comp[x]) != root(comp[y]) and _similar(grams(x), grams(y), threshold):
                    up[root(comp[x])] = root(comp[y])
                    out.append((key[x], key[y]))
        return out

    return materialise(rows.mapInArrow(_grouped(4, compare), "a binary, b binary"), "links", PAIR_BATCH)


def near_dedup(docs: DataFrame, k: int = WORDS, threshold: int = THRESHOLD, agree: int = AGREE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept and th (xxhash64 of the text), a row a document."""
    if threshold < THRESHOLD:
        raise ValueError("bands and signature bound are set for a similarity of 0.8 or more")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn("th", F.xxhash64("text"))
    drawn = materialise(sketch(docs, k, id_col, text_col), "sketch", TEXT_BATCH)
    named = F.when(F.col("doc_id").isNotNull(), F.col("doc_id"))
    classes = drawn.filter("key IS NOT NULL").groupBy("key").agg(F.min("sig").alias("sig"), F.min(F.struct("doc_id", "th")).alias("rep"))
    classes = materialise(classes, "classes")
    banded = buckets(classes)
    shared = materialise(banded.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "buckets")
    members = materialise(banded.join(maybe_broadcast(shared, shared.count()), "h"), "members")
    links: list[DataFrame] = []
    roots: DataFrame | None = None

    def labels(rows: DataFrame) -> DataFrame:
        """rows (key, ...) with the component of each class."""
        if roots is None:
            return rows.withColumn("comp", F.col("key"))
        return rows.join(roots.withColumnsRenamed({"node": "key"}), "key", "left").withColumn("comp", F.coalesce("root", "key")).drop("root")

    def settle(pairs: DataFrame, check) -> None:
        """Candidates, whose signatures agree, confirmed."""
        pairs = materialise(pairs, "pairs", TEXT_BATCH)
        if not pairs.isEmpty():
            found = check(pairs)
            (discard if found.isEmpty() else links.append)(found)
        discard(pairs)

    def join_up() -> None:
        """Components joined by the links found since; what was joined before goes in as stars."""
        nonlocal roots
        if links:
            edges, past = reduce(DataFrame.unionAll, links), roots
            edges = edges if past is None else edges.unionAll(past.select("node", "root"))
            roots = materialise(components(edges.toDF("u", "v")), "roots")
            discard(*links, *([past] if past is not None else []))
            links.clear()

    def by_text(pairs: DataFrame) -> DataFrame:
        return confirm(pairs, classes, base, k, threshold)

    for turn in range(STAR_ROUNDS):
        lab = labels(members)
        hubs = lab.groupBy("h").agg(F.min(F.struct(F.xxhash64("key", F.lit(turn)).alias("_"), "key", "comp")).alias("hub"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        hubs = hubs.filter("low != high").select("h", F.col("hub.key").alias("hub"), F.col("hub.comp").alias("hub_comp"))
        pairs = lab.join(hubs, "h").filter("comp != hub_comp").select(F.least("hub", "key").alias("a"), F.greatest("hub", "key").alias("b")).distinct()
        settle(_agreeing(pairs, classes, agree), by_text)
        join_up()
    lab = labels(members)
    open_ = lab.groupBy("h").agg(F.count(F.lit(1)).alias("total"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low != high").select("h", "total")
    left = materialise(lab.join(open_, "h"), "left")
    hot = materialise(left.filter(F.col("total") > SMALL).select("key").distinct(), "hot")
    settle(small_buckets(left.filter(F.col("total") <= SMALL), classes, agree), by_text)
    if not hot.isEmpty():
        sets = full_sets(hot, classes, base, k)
        places = prefixes(sets, threshold)

        def by_set(pairs: DataFrame) -> DataFrame:
            return agreeing_sets(pairs, sets, threshold)

        enough = False  # the last round found few links
        for turn in range(HUB_ROUNDS + 1):
            met = _met(places, labels(hot))
            n_met, listed = met.agg(F.count(F.lit(1)), F.sum(F.col("listed") / F.col("total"))).first()
            listing = enough or turn == HUB_ROUNDS or (listed or 0) <= LISTED * n_met
            if listing:
                found = tiles(met, classes, sets, agree, threshold)
                (discard if found.isEmpty() else links.append)(found)
            else:
                hubs = met.filter("most >= n").groupBy("g").agg(F.min(F.struct(F.xxhash64("key", F.lit(turn)).alias("_"), "key", "comp", "n", "most")).alias("hub")).select("g", "hub.key", "hub.comp", "hub.n", "hub.most")
                settle(_agreeing(_fitting(hubs, met), classes, agree), by_set)
                enough = sum(x.count() for x in links) * HUB_YIELD < n_met
            join_up()
            discard(met)
            if listing:
                break
        discard(sets, places)
    join_up()
    discard(classes, shared, members, left, hot)
    of = drawn.select("doc_id", "n", "key", "th")
    if roots is None:
        of = of.withColumn("root", F.col("key"))
    else:
        of = of.join(roots.withColumnsRenamed({"node": "key"}), "key", "left").withColumn("root", F.coalesce("root", "key"))
    # the least id of each component that has several rows; single rows are their own
    least = of.filter("root IS NOT NULL").groupBy("root").agg(F.min(named).alias("least"), F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("root", "least")
    least = materialise(least, "least")
    out = of.join(maybe_broadcast(least, least.count()), "root", "left").withColumn("component_id", F.coalesce("least", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "th")


def keep_one(docs: DataFrame, k: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, with all its columns."""
    gone = near_dedup(docs, k, id_col=id_col, text_col=text_col).filter(~F.col("kept")).select("doc_id", "th")
    return drop_rows(docs, gone, id_col, F.xxhash64(text_of(text_col)), "gone")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, by this query's contract."""
    return near_dedup(load(spark, sf_dir, "documents"), k=4).drop("th")


def oracle(k: int, source: str = "documents") -> str:
    words = "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {words} AS w FROM {source}),
s AS (SELECT DISTINCT doc_id, w[i:i + {k - 1}] AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {k - 1}, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {THRESHOLD} * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS to_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.to_id = e.a),
m AS (SELECT doc_id, min(to_id) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)
"""


ORACLE = oracle(4)
