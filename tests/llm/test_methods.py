"""The methods below the queries, against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from driftline.llm import collection_bwt, near_dedup, pieces, quality, secrets, token_files, toxicity
from driftline.llm.base import scratch
from driftline.llm.collection_bwt import SYMBOL, RoundFiles, build
from driftline.llm.quotient import CountingQuotientFilter, tally


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 40), max_size=60), st.lists(st.integers(0, 40), max_size=60), st.integers(0, 8))
def test_quotient_filters_merge_without_loss(a, b, seg_bits):
    def filters(values):
        fps, counts = tally(np.array(values, np.uint64))
        seg = (fps >> np.uint64(64 - seg_bits)).astype(int) if seg_bits else np.zeros(len(fps), int)
        return {s: CountingQuotientFilter.from_bytes(CountingQuotientFilter.build(fps[seg == s], counts[seg == s], s, seg_bits).to_bytes()) for s in set(seg.tolist())}

    one, two, got = filters(a), filters(b), {}
    for s in one.keys() | two.keys():
        fps, counts = CountingQuotientFilter.merge([f[s] for f in (one, two) if s in f]).items()
        got |= dict(zip(fps.tolist(), counts.tolist(), strict=True))
    want = {}
    for x in a + b:
        want[x] = want.get(x, 0) + 1
    assert got == want


def test_quotient_filters_are_packed():
    rng = np.random.default_rng(3)
    fps = np.unique(rng.integers(0, 2**56, 100_000, dtype=np.uint64))
    counts = np.where(rng.random(len(fps)) < 0.1, rng.integers(2, 1 << 40, len(fps)), 1)
    for seg_bits in (8, 20):
        own = fps if seg_bits == 8 else np.unique(fps & np.uint64((1 << 44) - 1))
        n = counts[: len(own)]
        made = CountingQuotientFilter.build(own, n, 0, seg_bits)
        data = made.to_bytes()
        slots = len(made.slots)
        assert len(data) <= 32 + (1 << made.q) // 8 + slots // 8 + slots * made.r // 8 + 2 and made.r == 64 - seg_bits - made.q
        got = CountingQuotientFilter.from_bytes(data).items()
        assert (got[0] == own).all() and (got[1] == n).all()
        more = CountingQuotientFilter.merge([CountingQuotientFilter.from_bytes(data)] * 3).items()
        assert (more[0] == own).all() and (more[1] == 3 * n).all()


@pytest.mark.parametrize(("seed", "block"), [(0, 1 << 18), (1, 7), (2, 64), (3, 1000)])
def test_column_wise_construction(tmp_path, monkeypatch, seed, block):
    rng = random.Random(seed)
    base = bytes(rng.choice(b"ab") for _ in range(400))
    strings = [base[rng.randrange(100) :][: rng.randrange(0, 300)] for _ in range(12)] + [b"", b"x", b"a" * 250, b"a" * 250]
    offsets = np.r_[0, np.cumsum([len(s) for s in strings])]
    data = np.frombuffer(b"".join(strings), np.uint8)
    monkeypatch.setattr(collection_bwt, "BLOCK", block)
    place, common = (np.concatenate(x) for x in zip(*build(data, offsets, RoundFiles(f"file://{tmp_path}/r")), strict=True))
    ends = np.repeat(offsets[1:], np.diff(offsets))

    def whole(p):
        t = data[p : ends[p]].tobytes()
        return [t[i : i + SYMBOL] for i in range(0, len(t) - SYMBOL + 1, SYMBOL)]

    assert sorted(place.tolist()) == [p for p in range(len(data)) if len(whole(p))]
    for i in range(1, len(place)):
        x, y = whole(place[i - 1]), whole(place[i])
        n = next((j for j, (u, v) in enumerate(zip(x, y, strict=False)) if u != v), min(len(x), len(y)))
        assert common[i] == n


def test_ranks_come_from_the_transform(tmp_path, monkeypatch):
    """An altered transform gives other places."""
    rng = random.Random(9)
    strings = [bytes(rng.choice(b"ab") for _ in range(240)) for _ in range(6)]
    data, offsets = np.frombuffer(b"".join(strings), np.uint8), np.arange(7) * 240

    def built(name):
        return np.concatenate([p for p, _ in build(data, offsets, RoundFiles(f"file://{tmp_path}/{name}"))]).tolist()

    right, whole = built("a"), RoundFiles.blocks

    def altered(self, name):
        for part in whole(self, name):
            if name == "transform" and self.round == 2:
                part = part.copy()
                i, j = np.flatnonzero(part)[[0, -1]]
                part[i], part[j] = part[j], part[i]
            yield part

    monkeypatch.setattr(RoundFiles, "blocks", altered)
    assert built("b") != right


def test_pieces_match_the_library():
    path = pieces.default_model()
    ours, library, rng = pieces.model(path), sentencepiece.SentencePieceProcessor(model_file=path), random.Random(3)
    texts = ["".join(rng.choice(["the", "in", "er", "  ", " ", "\n", "é", "中", "😀", "=", "-", "12", "▁", "a", "s", "t"]) for _ in range(rng.randrange(16))) for _ in range(3000)]
    texts += ["", " ", "a" * 500, " " * 700, "<s> <0x0A><unk>", "word, word. (word)"]
    ids, offsets = ours.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == library.encode(texts)
    assert ours.decode(ids, offsets) == library.decode([ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)])


def test_added_tokens():
    from tokenizers import Tokenizer

    path, rng = token_files.default_tokenizer(), random.Random(4)
    texts = ["hello <|endoftext|> world", "ends<|endoftext|>", "ends<|endoftext|>, then", "in<|startoftext|>side", "<|endoftext|><|startoftext|>.", "no<|ENDOFTEXT|> a<|endoftext| b|>", "it<|endoftext|>'s", "plain, words."]
    texts += ["".join(rng.choice(["<|endoftext|>", "<|startoftext|>", "<|", "|>", "endoftext", "word", "É", ",", ".", "'s", " ", "\n"]) for _ in range(rng.randrange(12))) for _ in range(2000)]
    ids, at = token_files.WordTokenizer(path).encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def _components_by_brute_force(texts, k):
    sets = [{tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if (w := t.split()) else set() for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and sets[a] & sets[b]:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize(("small", "listed", "tile"), [(2, 8, 256), (2, 0, 7), (32, 8, 16)])
def test_large_buckets_lose_no_link(spark, monkeypatch, small, listed, tile):
    """Pages of templates, less similar than the threshold or about it; dense groups, chains, sets within sets, short texts."""
    rng = random.Random(11)

    def own(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    texts = []
    for share, sizes in ((60, range(16, 24)), (90, range(3, 30)), (40, [40])):
        frame = own(share)
        texts += [" ".join(frame + own(rng.choice(sizes))) for _ in range(60)]
    for _ in range(8):  # groups of near copies under one frame
        seed = frame + own(40)
        for _ in range(12):
            copy = list(seed)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = own(1)[0]
            texts.append(" ".join(copy[rng.randrange(4) :]))
    chain = own(80)
    for i in range(30):
        chain[rng.randrange(80)] = f"c{i}"
        texts.append(" ".join(chain))
    pool = [own(10) for _ in range(8)]
    texts += [" ".join(w for part in rng.sample(pool, 6) for w in part) for _ in range(40)]
    texts += ["a b c d", "a b c d e", "a b c", "a b c", "", *(f"a b c d {i}" for i in range(40))]
    rng.shuffle(texts)
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "LISTED", listed)
    monkeypatch.setattr(near_dedup, "TILE", tile)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(docs, 4).collect()}
    want = _components_by_brute_force(texts, 4)
    assert [got[i] for i in range(len(texts))] == want


def test_prefixes_hold_every_pair(spark):
    rng = random.Random(12)
    sets = [sorted(rng.sample(range(30), rng.randrange(1, 25))) for _ in range(200)]
    rows = spark.createDataFrame([(bytes([i]), len(x), x) for i, x in enumerate(sets)], "key binary, n long, grams array<long>")
    comps = rows.select("key", F.col("key").alias("comp"))
    places = near_dedup.prefixes(rows, 80)
    met = near_dedup._met(places, comps)
    pairs = {(r.a[0], r.b[0]) for r in near_dedup._fitting(met.filter("comp != main"), met).collect()}
    want = {(a, b) for b in range(200) for a in range(b) if 100 * len(set(sets[a]) & set(sets[b])) >= 80 * len(set(sets[a]) | set(sets[b]))}
    assert want and want <= pairs


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
    assert (quality.fit(np.zeros((0, 3), np.float32), np.zeros(0)).scores(x[:2]) == 0.5).all()


def test_additive_scores_are_sums_of_looked_up_values():
    """One text, table and boosting step at a time."""
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["Word", "a", "bb!", "|", "12", "é", "line\n", "X,"], rng.integers(0, 60))) for _ in range(300)]
    x = quality.features(pa.array(texts))
    assert all((quality.features(pa.array([t]))[0] == x[i]).all() for i, t in enumerate(texts[:50]))  # a text's features are its own
    y = (x[:, 2] + rng.normal(0, 0.05, len(x)) > x[:, 2].mean()).astype(float)
    model = quality.fit(x, y, rounds=5, pair_rounds=3)
    for row, score in zip(x, model.scores(x), strict=True):
        total = model.intercept
        for f, (edge, table) in enumerate(zip(model.edges, model.tables, strict=True)):
            total += table[sum(e <= row[f] for e in edge)]
        for f, g, ef, eg, table in model.pairs:
            total += table[sum(e <= row[f] for e in ef), sum(e <= row[g] for e in eg)]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))
    # the first step of boosting on one feature: the tree of at most four leaves that lowers the loss most, greedily
    g, h = rng.normal(size=9), rng.random(9)

    def leaf(a, b):
        return -g[a:b].sum() / (h[a:b].sum() + quality._LEAF)

    def gain(a, b):
        return g[a:b].sum() ** 2 / (h[a:b].sum() + quality._LEAF)

    def cut(a, b):
        return max(((gain(a, c) + gain(c, b) - gain(a, b), c) for c in range(a + 1, b)), default=(0, a))

    want, stack = np.zeros(9), [(0, 9, 2)]
    while stack:
        a, b, left = stack.pop()
        best, c = cut(a, b) if left else (0, a)
        if best > 1e-9:
            stack += [(a, c, left - 1), (c, b, left - 1)]
        else:
            want[a:b] = leaf(a, b)
    assert quality._shallow_tree(g, h) == pytest.approx(want)


def test_machine_scores_by_the_formula():
    """Terms and pairs one by one."""
    rng = np.random.default_rng(6)
    words = ["You", "are", "idiot", "group", "café", "Of", "them!", "x-ray"]
    texts = [" ".join(rng.choice(words, rng.integers(0, 12))) for _ in range(60)]
    row, bucket, count = toxicity.terms(pa.array(texts))
    used = np.unique(bucket)
    place = np.full(1 << toxicity.BITS, -1, np.int32)
    place[used[::2]] = np.arange(len(used[::2]))
    n = len(used[::2])
    machine = toxicity.FactorizationMachine(place, 0.3, rng.normal(size=n), rng.normal(size=(n, toxicity.FACTORS)) * 0.2)
    for i, t in enumerate(texts):
        seen = {}
        for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower()):
            for kind in (0, *toxicity.BEGINNINGS):
                if kind == 0 or len(w) > kind:
                    b = int(toxicity._bucket(pa.array([w[:kind] if kind else w]), kind)[0])
                    seen[b] = seen.get(b, 0) + 1
        assert seen == dict(zip(bucket[row == i].tolist(), count[row == i].tolist(), strict=True))
        xs = [(place[b], min(np.log2(1 + c), toxicity.CAP)) for b, c in seen.items() if place[b] >= 0]
        logit = machine.w0 + sum(machine.w[j] * x for j, x in xs) + sum(machine.v[j] @ machine.v[k] * x * z for a, (j, x) in enumerate(xs) for k, z in xs[:a])
        assert machine.scores(pa.array([t]))[0] == pytest.approx(1 / (1 + np.exp(-logit)))


def test_machine_learns_a_pair_of_terms():
    rng = np.random.default_rng(2)
    both = rng.integers(0, 2, (3000, 2))
    y = (both[:, 0] & both[:, 1]).astype(float)
    row, term = np.nonzero(np.c_[both, np.ones(3000, int)])
    w0, w, v = toxicity.fit(row, term, np.ones(len(row)), y, 3)
    scores = toxicity.FactorizationMachine(np.zeros(1, np.int32), w0, w, v).logits(row, term, np.ones(len(row)), 3000)
    assert ((scores > 0) == y).mean() > 0.98


def test_findings_follow_the_matches(spark):
    """A report over a text of 40,000 matches takes about as long as one of 10,000 four times over, not sixteen."""
    import time

    def took(n):
        docs = spark.createDataFrame([(1, " ".join(f"{i:024x}" for i in range(n)))], "doc_id long, text string")
        ledger = secrets.SecretLedger(spark, scratch(spark, "many-matches"))
        ledger.scan(docs)
        began = time.perf_counter()
        row = ledger.report(docs).first()
        assert row.n_hex == n and row.spans.count(",") == n - 1
        return time.perf_counter() - began

    took(1000)
    assert took(40_000) < 4 * took(10_000) + 2


def test_long_units_take_time_by_their_length():
    import random
    import time

    import sentencepiece

    model = pieces.model(pieces.default_model())
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())

    def took(n):
        unit = "".join(random.Random(n).choice("etaoinshrdlu漢🜚") for _ in range(n))
        began = time.process_time()
        ids, _ = model.encode(pa.array([unit]))
        spent = time.process_time() - began
        assert n > 20_000 or ids.tolist() == library.encode(unit)
        return spent

    took(20_000)
    assert took(400_000) < 10 * took(100_000) + 1
