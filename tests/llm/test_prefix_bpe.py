"""The per-prefix encoder against the tokenizers library."""

import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from driftline.llm import prefix_bpe
from driftline.llm.token_files import default_tokenizer

ODD = ["", " ", "<|endoftext|>", "x<|startoftext|>y", "<|ENDOFTEXT|>", "it's I'VE don't", "\x00\x1c\x85\xa0a", "é ÅΣΑΣ ẞ İ", "3.14²½", "ｈａｌｆ", "👩‍👩‍👧", "a" * 5000, "=-" * 300, "</w> </w>", "\n\t", "'", "''s"]


@pytest.fixture(scope="module")
def model():
    return prefix_bpe.model(default_tokenizer())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


def texts():
    deal = random.Random(3)
    marks = [chr(c) for c in (*range(1, 128), *range(0xA0, 0x250), *range(0x300, 0x340), *range(0x370, 0x400), *range(0x4E00, 0x4E20), 0x1F600, 0x212B)]
    yield from ODD
    for _ in range(1500):
        yield "".join(deal.choice(marks) for _ in range(deal.randint(0, 40)))
        yield "".join(deal.choice("etaoinshrdlu") for _ in range(deal.randint(1, 60)))
        yield "".join(deal.choice("aab ") for _ in range(deal.randint(1, 60)))


def test_ids_and_texts_match_the_library(model, library):
    given = list(texts())
    ids, offsets = model.encode(pa.array(given))
    decoded = model.decode(ids, offsets)
    for i, text in enumerate(given):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[offsets[i] : offsets[i + 1]].tolist() == want, text[:60]
        assert decoded[i].decode() == library.decode(want, skip_special_tokens=False)


def test_every_token_stands_and_pairs_fit_as_merging_says(model, library):
    assert all(map(model.stands, model.symbols))
    deal = random.Random(4)
    letters = [i for i, s in model.symbols.items() if s.isascii() and s.isalpha() and s.islower()]
    words = ["".join(model.symbols[deal.choice(letters)] for _ in range(2)) for _ in range(3000)]
    for word in words:  # the last symbol ends the word
        symbols = word[:-1] + chr(ord(word[-1]) + prefix_bpe.END)
        assert model._word(symbols) == library.encode(word, add_special_tokens=False).ids


def test_time_follows_the_length(model):
    def took(n):
        word = "".join(random.Random(n).choice("etaoinshrdlu") for _ in range(n))
        began = time.process_time()
        model.encode_units([word])
        return time.process_time() - began

    took(400_000)  # learns the pairs of tokens
    assert took(400_000) < 10 * took(100_000) + 0.3


def test_documents(spark, library):
    rows = [(i, t, "clash") for i, t in enumerate([*ODD, None, "word " * 40_000, "same", "same"])] + [(None, "no id", "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = prefix_bpe.digests(docs.select("doc_id", prefix_bpe.text_of("text").alias("text"))).collect()
    want = {}
    for i, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[i] = len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(rows)
    back = prefix_bpe.decode_documents(prefix_bpe.encode_documents(docs))
    assert back.columns == [*docs.columns, "ids", "decoded"]
    assert back.filter("doc_id = 2").first().decoded == "<|endoftext|>" and prefix_bpe.encode_documents(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="ids already"):
        prefix_bpe.encode_documents(docs.withColumnRenamed("n_tokens", "IDS"))
