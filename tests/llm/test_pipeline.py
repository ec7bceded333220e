"""The pipeline's stages against plain Python on the smallest documents."""

import re

import corpus_pipeline
from driftline.llm import pieces, quality
from driftline.llm.base import load

SF = "/root/testdata/sf0.001"


def windows(words, n):
    return {tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))} if words else set()


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def test_pipeline(spark):
    docs = load(spark, SF, "documents")
    model = quality.learn(docs, load(spark, SF, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model).collect()
    texts = {r.doc_id: r.text or "" for r in scored if r.score >= quality.THRESHOLD}
    last = {t: i for i, t in sorted(texts.items())}
    texts = {i: t for t, i in last.items()}
    sets = {i: windows(re.split(r"[\x20\x09-\x0D]+", lower(t).strip(" \t\n\x0b\x0c\r")) if t.strip(" \t\n\x0b\x0c\r") else [], 5) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in texts:
        for b in texts:
            if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    texts = {i: t for i, t in texts.items() if find(i) == i}
    gaps = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

    def words(t):
        return [w for w in re.split(gaps, lower(t)) if w]

    items = {w for r in load(spark, SF, "benchmark").collect() for w in windows(words(r.text or ""), 10)}
    sizes = {len(w) for w in items}
    clean = {i for i, t in texts.items() if not any(len(w) in sizes and w in items for n in sizes for w in windows(words(t), n))}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == clean and all(r.round_trip for r in got)
    ours = pieces.model(pieces.default_model())
    import pyarrow as pa

    for r in got[:20]:
        assert r.ids == ours.encode(pa.array([texts[r.doc_id]]))[0].tolist()
    assert [len(corpus_pipeline.STAGES), [len(s) for s in corpus_pipeline.STAGES]] == [5, [2] * 5]
