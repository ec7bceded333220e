"""The operators on nulls, empty and odd texts, ties, repeated rows, empty tables and clashing columns."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import base, decontaminate, exact_dedup, near_dedup, pieces, quality, repeats, secrets, token_files, toxicity, warc_fixity
from driftline.llm.base import scratch
from driftline.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, ids string, score double, th long, _id long"
WORDS = " ".join(f"word{i}" for i in range(60))
TEXTS = [(1, WORDS), (2, WORDS), (3, WORDS.replace("word30", "other")), (4, None), (5, ""), (6, "short"), (7, "Ünïcode, ÉÀ! " * 40), (8, "x" * 30_000), (None, "no id"), (None, WORDS), (9, "same row"), (9, "same row"), (10, "token=abcdef secret:token:abcdefgh AKIA" + "A1" * 10 + " " + "0f" * 14)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", 0, True, "x", 0.5, 1, 2) for i, t in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, None if i == 3 else i % 2) for i in range(1, 9)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")


def none(docs):
    return docs.limit(0)


@pytest.mark.parametrize("rows", [100_000, 0])
def test_exact(docs, monkeypatch, rows):
    monkeypatch.setattr(base, "BROADCAST_ROWS", rows)
    got = sorted(((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs).collect()), key=str)
    want = {1: (2, 3, False), 2: (2, 3, True), 4: (5, 2, False), 5: (5, 2, True), 9: (9, 2, True)}
    for d, *rest in got:
        if d in want:
            assert tuple(rest) == want[d]
    assert exact_dedup.exact_dedup(none(docs)).count() == 0
    kept = exact_dedup.keep_distinct(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 5, 6, 7, 8, 9, 10]


def test_secrets_and_ledger(spark, docs):
    path = scratch(spark, "test-ledger")
    ledger = secrets.SecretLedger(spark, path)
    assert ledger.scan(docs) == 9 and ledger.scan(docs) == 0  # one scan a blob
    rows = {r.doc_id: r for r in ledger.report(docs).collect()}
    assert rows[10].spans == "assign:0:12,access:35:59,hex:60:88" and rows[10].n_assign == 1 and rows[4].spans == ""
    later = docs.union(spark.createDataFrame([(11, "passwd: abcdefghi", "en", "s", 0, True, "x", 0.5, 1, 2)] * 3, SCHEMA))
    assert ledger.scan(later) == 1 and {r.spans for r in ledger.report(later).filter("doc_id = 11").collect()} == {"assign:0:17"}
    assert [ledger.found().groupBy("blob").count().filter("count > 1").count(), ledger.scanned().count()] == [0, 10]
    newer = secrets.SecretLedger(spark, path, (*secrets.RULES[:2], secrets.Rule("hex", 2, "[0-9a-f]{28}", "[0-9a-f]{28,}", 0, 28)))
    assert newer.scan(docs) == 9 and newer.scan(docs.union(docs)) == 0  # a new rule version is a new pair
    assert newer.report(docs).count() == docs.count() and ledger.report(none(docs)).count() == 0


@pytest.mark.parametrize("rows", [None, 0])
def test_secrets_against_plain_python(spark, monkeypatch, rows):
    """With and without broadcasts, over two batches, and a text with very many matches."""
    if rows is not None:
        monkeypatch.setattr(base, "BROADCAST_ROWS", rows)
    rng = np.random.default_rng(8)
    parts = ["token=", "SECRET : '", "api_key\"=\"", "AKIA", "A1B2C3D4E5F6A7B8", "0f" * 12, "abcdef", " ", "é", "password", "=", "x" * 7, "apikey:", "\n"]
    texts = ["".join(rng.choice(parts, rng.integers(1, 14))) for _ in range(150)] + [("0f" * 12 + " ") * 20_000, None, ""]
    texts += texts[:40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    patterns = [(r.kind, re.compile(r.pattern, re.ASCII), r.group, r.least) for r in secrets.RULES]

    def brute(t):
        hits = [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for k, (kind, p, group, least) in enumerate(patterns) for m in p.finditer(t or "") if len(m.group(group)) >= least]
        return ",".join(x[2] for x in sorted(hits))

    ledger = secrets.SecretLedger(spark, scratch(spark, "test-ledger"))
    first = len(set(map(lambda t: t or "", texts[:90])))
    assert ledger.scan(docs.filter("doc_id < 90")) == first and ledger.scan(docs) == len({t or "" for t in texts}) - first
    assert {r.doc_id: r.spans for r in ledger.report(docs).collect()} == {i: brute(t) for i, t in enumerate(texts)}


def test_decontaminate(spark, docs):
    items = [(1, " ".join(f"WORD{i}" for i in range(5, 20))), (2, "short"), (3, None), (None, "no id"), (1, "word1 word2"), (4, "absent words here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.n_words): (r.n_hit, r.n_items, r.contaminated) for r in decontaminate.contamination(docs, bench).collect()}
    assert got[1, 60] == (17, 1, True) and got[3, 60] == (17, 1, True) and got[6, 1] == (1, 1, True)
    assert got[4, 0] == (0, 0, False) and got[None, 2] == (2, 0, True)
    assert decontaminate.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.contamination(none(docs), bench).count() == 0
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [4, 5, 7, 8, 9, 9, 10]


def test_decontaminate_without_broadcast(docs, spark, monkeypatch):
    bench = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(5, 20)))], "item_id long, text string")
    want = sorted(map(str, decontaminate.contamination(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert sorted(map(str, decontaminate.contamination(docs, bench).collect())) == want


def test_decontaminate_beside_signs(spark, monkeypatch):
    greek = [f"{'ΟΔΟΣ' if i % 2 else 'ΑΣ'}{sign}ΣΑ{i} {'ΟΔΟΣ'}'{'İX'}" for i, sign in enumerate([".", ":", "'", "·", "\u00ad", ",", "’", "-"])]
    passage = " ".join(greek)
    bench = spark.createDataFrame([(1, passage.replace(".", " ").replace(":", " ").replace("'", " ")), (2, "x Σ y"), (3, "only lower σ")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"Before, {passage} after"), (2, "X:Σ Y"), (3, "only lower Σ"), (4, passage.lower())], "doc_id long, text string")
    n = len([w for w in re.split(decontaminate.GAPS, passage) if w])
    want = {1: (n, True), 2: (3, True), 3: (0, False), 4: (0, False)}
    for most in (decontaminate.BROADCAST_WINDOWS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", most)
        assert {r.doc_id: (r.n_hit, r.contaminated) for r in decontaminate.contamination(docs, bench).collect()} == want


@pytest.mark.parametrize("rows", [100_000, 0])
def test_near(docs, monkeypatch, rows):
    monkeypatch.setattr(base, "BROADCAST_ROWS", rows)
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dedup.near_dedup(docs, 4).collect()}
    assert got[1, 57] == got[2, 57][:1] + (True,) or got[1, 57] == (1, True)
    assert got[2, 57] == (1, False) and got[3, 57] == (1, False) and got[4, 0] == (4, True) and got[6, 1] == (6, True)
    assert near_dedup.near_dedup(none(docs)).count() == 0
    assert near_dedup.keep_one(docs).columns == docs.columns


@pytest.mark.parametrize("slots", [8192, 1])
def test_sieve(spark, monkeypatch, slots):
    """Nothing that is in is kept out; in one piece and in segments, and with more keys than bits."""
    monkeypatch.setattr(base, "SLOTS", slots)
    keys, rows = spark.range(0, 15_000, 3), spark.range(30_000).select("id", F.lit("x").alias("bits"), F.lit(None).alias("sieve_slot"))
    for segments in (8, 1):
        monkeypatch.setattr(base, "SEGMENTS", segments)
        bits = base.sieve(keys, "id", 5000)
        into, out = base.passing(rows, "id", bits), base.failing(rows, "id", bits)
        there = {r.id for r in into.collect()}
        assert set(range(0, 15_000, 3)) <= there and len(there) < (6000 if slots * segments > 2 else 15_000) and into.columns == rows.columns
        assert {r.id for r in out.collect()} == set(range(30_000)) - there
    assert base.passing(rows, "id", base.sieve(keys.limit(0), "id", 0)).count() == 0


def test_what_is_written_is_released(spark):
    first = base.made(spark)
    one, two = base.materialise(spark.range(3), "test-one"), base.materialise(spark.range(4), "test-two")
    base.discard(one)
    assert base.made(spark) == first + 1 and base.release(spark, first, keep=two) == 0 and two.count() == 4
    assert base.release(spark, first) == 1 and base.made(spark) == first
    for gone in (one, two):
        with pytest.raises(Exception, match="driftline-test"):
            gone.count()


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_stopped_early(spark):
    with pytest.raises(RuntimeError, match="after 2 rounds"):
        components(spark.createDataFrame([(i, i + 1) for i in range(50)], "u long, v long"), most_rounds=2)


def brute_repeats(texts, n):
    seen = {}
    for k, t in enumerate(texts):
        for i in range(len(t) - n + 1):
            seen.setdefault(t[i : i + n], []).append((k, i))
    gone = [set() for _ in texts]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                gone[k].update(range(i, i + n))
    return [bytes(b for i, b in enumerate(t) if i not in g) for t, g in zip(texts, gone, strict=True)]


@pytest.mark.parametrize("rows", [100_000, 0])
def test_repeats(spark, docs, monkeypatch, rows):
    monkeypatch.setattr(base, "BROADCAST_ROWS", rows)
    rng = np.random.default_rng(5)
    a, b = ("".join(rng.choice(list("abcé "), 900)) for _ in range(2))
    texts = [a, b[:300] + a[100:420] + b[300:], "y" * 700, None, "", a[:199], "z" + a[:205] + "é", b[:250]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in repeats.remove_repeats(rows).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats([(t or "").encode() for t in texts], 200)
    assert repeats.remove_repeats(none(docs)).count() == 0
    assert repeats.remove_repeats(docs).count() == docs.count()


def test_token_files(spark, docs):
    from tokenizers import Tokenizer

    path, out = token_files.default_tokenizer(), scratch(spark, "test-tokens")
    shards = token_files.write_tokens(docs, out, path, length=64)
    got = token_files.read_back(spark, out, shards).orderBy("start").collect()
    encode, at = Tokenizer.from_file(path), 0
    want = {(i, zlib.crc32(np.array([*encode.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes())) for i, t in TEXTS}
    assert {(r.doc_id, r.ids_crc32) for r in got} == want
    assert [r.doc_id or 0 for r in got] == sorted(i or 0 for i, _ in TEXTS)
    for r in got:
        assert r.start == at
        at += r.n_tokens
    tokens = token_files.TokenFile(f"{out}/{shards[0]['name']}.arrow")
    ids, mask = tokens.sequence(len(tokens) - 1)
    assert len(ids) == 64 and sum(mask.to_pylist()) == (shards[0]["n_tokens"] - 1) % 64 + 1 and ids.base is not None
    assert token_files.write_tokens(none(docs), scratch(spark, "test-tokens"), path) == []


def test_shards_are_cut_by_bytes_and_read_by_ranges(spark, tmp_path, monkeypatch):
    """A store that can't be mapped: one sequence costs one batch."""
    from pyarrow import fs

    texts = [(i, f"some words {i} " * 40) for i in range(3000)]
    rows = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    path, out = token_files.default_tokenizer(), f"file://{tmp_path}/tokens"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        shards = token_files.write_tokens(rows, out, path, length=32, file_bytes=100_000)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(shards) > 6 and max(s["n_tokens"] for s in shards) * 2 < 100_000 + 100 * 500
    whole = [tuple(r) for r in token_files.read_back(spark, out, shards).orderBy("start").collect()]
    assert [r[0] for r in whole] == list(range(3000)) and [r[1] for r in whole[1:]] == [r[1] + r[2] for r in whole[:-1]]
    near = token_files.TokenFile(f"{out}/{shards[0]['name']}.arrow")
    monkeypatch.setattr(token_files, "filesystem", lambda uri: (fs.SubTreeFileSystem(f"{tmp_path}/tokens", fs.LocalFileSystem()), uri.rsplit("/", 1)[-1]))
    far = token_files.TokenFile(f"{out}/{shards[0]['name']}.arrow")
    assert near.mapped and not far.mapped and len(near) == len(far) and far.bytes_read < far.places[-1]
    before = far.bytes_read
    i = len(far) // 2
    ids, mask = far.sequence(i)
    assert (ids == near.sequence(i)[0]).all() and mask.equals(near.sequence(i)[1]) and near.bytes_read == 0
    assert far.bytes_read - before <= max(b - a for a, b in zip(far.places, far.places[1:], strict=False))
    assert (far.span(100, 5000) == near.span(100, 5000)).all()


def test_pieces_round_trip(docs):
    encoded = pieces.encode_documents(docs.select("doc_id", "text"), check_col="ok")
    assert encoded.filter("ok").count() == docs.count()
    back = pieces.decode_documents(encoded).select((F.coalesce("text", F.lit("")) == F.col("decoded")).alias("same"))
    assert back.filter("same").count() == docs.count() and pieces.encode_documents(none(docs).select("text")).count() == 0


def test_classifiers(docs, labels):
    plain = docs.select("doc_id", "text", "lang")
    for module, label in ((quality, "quality"), (toxicity, "toxic")):
        got = module.score(plain, module.learn(docs, labels, label))
        assert got.count() == docs.count() and got.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
        assert module.score(none(plain), module.learn(none(docs), labels, label)).count() == 0
        assert {r.score for r in module.score(plain, module.learn(docs, labels.limit(0), label)).collect()} == {0.5}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    for query, label, least in ((quality.op5_quality, "quality", 0.99), (toxicity.op9_toxicity, "toxic", 0.97)):
        scored = query(spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
        assert scored.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] >= least


def test_warc(spark):
    pages = spark.createDataFrame([(i, None if i == 3 else f"http://h/{i}\r\nX: y", None if i == 4 else "é" * i) for i in range(300)] + [(None, "u", "h"), (5, "u", "h")], "page_id long, url string, html string")
    a, b = scratch(spark, "test-a"), scratch(spark, "test-b")
    manifest = warc_fixity.write_warc(pages, a, file_bytes=20_000)
    warc_fixity.copy_replica(manifest, a, b, manifest.filter("page_id IN (17, 250)").select("file", (F.col("start") + 5).alias("at")))
    trees = [warc_fixity.tree(warc_fixity.leaves(manifest, root), fanout=4) for root in (a, b)]
    bad = warc_fixity.audit(*trees, fanout=4).join(manifest, ["file", "ord"])
    assert {r.page_id for r in bad.collect()} == {17, 250}
    assert warc_fixity.audit(trees[0], trees[0], fanout=4).count() == 0
    whole = {r.record_sha256 for r in warc_fixity.leaves(manifest, a).collect()}
    assert len(whole) == 302 and warc_fixity.write_warc(pages.limit(0), scratch(spark, "test-c")).count() == 0


def test_warc_against_what_was_written(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "é" * i) for i in range(300)], "page_id long, url string, html string")
    a, b, alike = (scratch(spark, f"test-{x}") for x in "efg")
    manifest = warc_fixity.write_warc(pages, a, file_bytes=20_000)
    warc_fixity.copy_replica(manifest, a, b, manifest.filter("page_id IN (17, 250)").select("file", (F.col("start") + 5).alias("at")))
    warc_fixity.copy_replica(manifest, b, alike)
    one, two, three = (warc_fixity.leaves(manifest, root) for root in (a, b, alike))
    assert warc_fixity.audit(warc_fixity.tree(two), warc_fixity.tree(three)).count() == 0  # the replicas agree
    assert [{r.page_id for r in x.filter("NOT intact").join(manifest, ["file", "ord"]).collect()} for x in (one, two, three)] == [set(), {17, 250}, {17, 250}]
    assert warc_fixity.longer_or_shorter(manifest, alike).count() == 0
    last = manifest.orderBy("file", F.desc("ord")).first()
    with open(f"{alike.removeprefix('file://')}/{last.file}", "ab") as out:
        out.write(b"more")
    assert [tuple(r) for r in warc_fixity.longer_or_shorter(manifest, alike).collect()] == [(last.file, last.ord)]


def test_queries_over_empty_tables(spark, tmp_path):
    from driftline.llm import queries

    for name in ("documents", "benchmark", "labels", "pages", "conversations", "sale_lines", "vendors", "items"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert {name: query(spark, str(tmp_path)).count() for name, query in queries.QUERIES.items()} == dict.fromkeys(queries.QUERIES, 0)
