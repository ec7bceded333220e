"""BPE encoding by per-prefix dynamic programming, and decoding.

A word's symbols (bytes, the last one marked as the word's end) run through an automaton of all tokens, whose suffix links give
the tokens that end at each place. For every prefix of the word exactly one token can be the last of the prefix's encoding: the
one that may follow the last token of the prefix before it. That token is stored, and following the stored tokens back from the
word's end emits the ids. Nothing is merged, and the time is linear in the word's length, for any length.

Whether token B may follow token A is a matter of the two alone (``WordBpe.fits``): the merges that built A's right edge and B's
left edge are replayed in order of rank, and no merge across the place between them may come first. Tokens that their own
merges would not build are never matched.

The tokenizer file's normaliser (NFC, lower case) and its pattern cut texts into words. Words between ASCII white space, and
marks that trail a word, are handled apart, as in ``token_files``; a string of an added token such as <|endoftext|> is matched
on the raw text and gives its id. The file has no decoder, so decoding joins the tokens' strings by single spaces, special ones
included.

Nulls: a null text is empty and has no ids. Texts and words of any length are encoded whole. Ties and repeated rows: each row
is encoded by itself. An empty table gives an empty one. Other columns are ignored by the query and carried by
``encode_documents``; an ``ids`` column that is there already is an error. Ids of documents are cast to long.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.base import load, text_of
from driftline.llm.token_files import batches_of, default_tokenizer
from driftline.llm.wordcache import UnitEncoder, split_words

#: Bytes of text that a task encodes at a time.
SLICE = 4_000_000
#: Distinct units whose ids, and pairs of tokens whose fit, a worker keeps; beyond that it starts anew.
UNITS, PAIRS = 400_000, 500_000
#: A symbol that ends a word is its letter moved by so much.
END = 0x10000
#: The file's pattern on printable ASCII in lower case (fixed value).
_PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_MODELS: dict[str, WordBpe] = {}


class WordBpe:
    """A BPE tokenizer file of the word-end kind."""

    def __init__(self, path: str, units: int = UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.normalise, self.cut = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, added = file["model"], file["added_tokens"]
        if model["type"] != "BPE" or file.get("decoder") or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or t["content"].split() != [t["content"]] for t in added):
            raise ValueError(f"{path}: not a BPE file without a decoder and with added tokens that are matched as they stand")
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"]
        self.added = {t["content"]: t["id"] for t in added}
        self.at_added = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})") if added else None
        n = max([*vocabulary.values(), *self.added.values()]) + 1
        self.string = [""] * n
        for token, i in [*vocabulary.items(), *self.added.items()]:
            self.string[i] = token
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        built = {a + b for a, b in merges}
        self.symbols: dict[int, str] = {}  # by token
        for token, i in vocabulary.items():
            if token not in built:
                letter = token.removesuffix(suffix) if len(token) > 1 else token
                if len(letter) != 1:
                    raise ValueError(f"{path}: the token {token!r} is neither a letter nor made by a merge")
                self.symbols[i] = letter if letter == token else chr(ord(letter) + END)
        self.parts: dict[int, tuple[int, int]] = {}  # the two tokens that a token is merged from
        self.rank: dict[int, int] = {}
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}  # rank and token of a merge
        for rank, (a, b) in enumerate(merges):
            one, two, whole = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.merged[one, two] = rank, whole
            if whole not in self.parts:
                self.parts[whole], self.rank[whole], self.symbols[whole] = (one, two), rank, self.symbols[one] + self.symbols[two]
        self.tokens = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, s in self.symbols.items():
            self.tokens.add_word(s, i)
        self.tokens.make_automaton()
        self.length = [0] * n
        for i, s in self.symbols.items():
            self.length[i] = len(s)
        self.own: dict[int, bool] = {}  # whether a token's own merges build it
        self.known: dict[int, bool] = {}  # whether one token may follow another, by both ids
        strings = [s.encode() for s in self.string]
        self.out_len = np.fromiter((len(s) + 1 for s in strings), np.int64, n)
        self.out_at = np.cumsum(self.out_len) - self.out_len
        self.out = np.frombuffer(b"".join(s + b" " for s in strings), np.uint8)
        self.units = UnitEncoder(self.encode_units, units)

    def fits(self, left: int, right: int) -> bool:
        """Whether encoding the two tokens' symbols gives just these two.

        The left token's right edge is a chain of ever shorter tokens, each alive from its own merge to that of the one around
        it; the right token's left edge likewise. Where a token of either chain is alive at the same time and the two have a merge, it would
        come first if its rank is below that of the next merge on either side; at equal rank the left place goes first.
        """
        left_end = right_end = len(self.merged)  # ranks at which the tokens looked at are taken in; none yet
        while True:
            found = self.merged.get((left, right))
            if found and found[0] < left_end and found[0] <= right_end:
                return False
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a >= b:  # the later of the two merges is undone; of equal ones that on the right happened last
                if a == b:
                    right_end, right = b, self.parts[right][0]
                else:
                    left_end, left = a, self.parts[left][1]
            else:
                right_end, right = b, self.parts[right][0]

    def stands(self, token: int) -> bool:
        """Whether the token's own merges build it: both parts stand, and no other merge across their place comes before the token's."""
        if token not in self.own:
            todo = [token]
            while todo:
                t = todo[-1]
                a, b = self.parts.get(t, (-1, -1))
                waiting = [x for x in (a, b) if x >= 0 and x not in self.own]
                if waiting:
                    todo += waiting
                    continue
                self.own[t] = a < 0 or (self.own[a] and self.own[b] and self._joins(a, b, self.rank[t]))
                todo.pop()
        return self.own[token]

    def _joins(self, left: int, right: int, rank: int) -> bool:
        """Whether the first merge across the place between the two is the one of this rank, which joins them whole."""
        left_end = right_end = rank + 1
        if self.rank.get(left, -1) >= rank or self.rank.get(right, -1) > rank:
            return False
        first = True
        while True:
            found = self.merged.get((left, right))
            if found and not first and found[0] < left_end and found[0] <= right_end:
                return False
            first = False
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                left_end, left = a, self.parts[left][1]
            else:
                right_end, right = b, self.parts[right][0]

    def _word(self, symbols: str) -> list[int]:
        """The word's ids: for each prefix its last token, then back from the end."""
        n = len(symbols)
        if n == 1:
            return [self.tokens.get(symbols)]
        last = [-1] * (n + 1)
        length, own, known = self.length, self.own, self.known
        at, found = -1, False
        for end, token in self.tokens.iter(symbols):  # longest token first at each end
            if end != at:
                at, found = end, False
            elif found:
                continue
            before = last[end + 1 - length[token]]
            if end + 1 == length[token]:
                if own[token] if token in own else self.stands(token):
                    last[end + 1], found = token, True
            elif before >= 0:
                pair = before << 32 | token
                fit = known.get(pair)
                if fit is None:
                    if len(known) > PAIRS:
                        known.clear()
                    fit = known[pair] = self.stands(token) and self.fits(before, token)
                if fit:
                    last[end + 1], found = token, True
        ids, at = [], n
        while at:
            token = last[at]
            if token < 0:
                raise ValueError(f"no token ends at {at} of a word of {n} symbols")
            ids.append(token)
            at -= length[token]
        ids.reverse()
        return ids

    def words(self, text: str) -> list[str]:
        """The text's words in symbols; the last symbol of each marks its end."""
        if text.isascii() and text.isprintable() and " " not in text:
            found = _PLAIN.findall(text.lower())
        else:
            found = [w for w, _ in self.cut(self.normalise(text))]
        return [w[:-1] + chr(ord(w[-1]) + END) for w in found if w]

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids and each unit's number of them."""
        done: dict[str, list[int]] = {}
        flat: list[int] = []
        lens = np.zeros(len(units), np.int64)
        for i, unit in enumerate(units):
            first = len(flat)
            pieces = self.at_added.split(unit) if self.at_added else [unit]
            for k, piece in enumerate(pieces):
                if k % 2:
                    flat.append(self.added[piece])
                    continue
                for word in self.words(piece) if piece else ():
                    ids = done.get(word)
                    if ids is None:
                        ids = done[word] = self._word(word)
                    flat += ids
            lens[i] = len(flat) - first
        return np.array(flat, np.uint32), lens

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, and where each text's begin."""
        words, offsets = split_words(texts)
        return self.units(words, offsets, trim=True, uncut=list(self.added))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """UTF-8 of the id lists that begin at the offsets: the tokens' strings with a space between two."""
        n = self.out_len[ids]
        ends = np.cumsum(n)
        data = self.out[np.repeat(self.out_at[ids] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        at = np.r_[0, ends][offsets].tolist()
        return [data[a : max(a, b - 1)] for a, b in zip(at[:-1], at[1:], strict=True)]


def model(path: str) -> WordBpe:
    """The worker's model; its caches live as long as the worker."""
    if path not in _MODELS:
        _MODELS[path] = WordBpe(path)
    return _MODELS[path]


def encode_documents(docs: DataFrame, text_col: str = "text", path: str | None = None, out_col: str = "ids") -> DataFrame:
    """All columns and ``ids`` array<int>."""
    path, at = path or default_tokenizer(), docs.columns.index(text_col)
    if out_col.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the table has a column {out_col} already")

    def run(batches):
        for batch in batches:
            for part in batches_of(batch, SLICE, at):
                ids, offsets = model(path).encode(part.column(at).cast(pa.string()).fill_null(""))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, out_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out_col, T.ArrayType(T.IntegerType()))]))


def decode_documents(encoded: DataFrame, ids_col: str = "ids", path: str | None = None, out_col: str = "decoded") -> DataFrame:
    """All columns and ``decoded``; null ids are read as none."""
    path, at = path or default_tokenizer(), encoded.columns.index(ids_col)

    def run(batches):
        for batch in batches:
            lists = batch.column(at).fill_null([])
            offsets = lists.offsets.to_numpy()
            ids = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
            texts = [x.decode() for x in model(path).decode(ids, offsets - offsets[0])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out_col])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out_col, T.StringType())]))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) -> doc_id, n_tokens, ids_sha256, decoded_sha256: encodes and decodes in one pass."""
    path = path or default_tokenizer()

    def run(batches):
        for batch in batches:
            for part in batches_of(batch, SLICE):
                ids, offsets = model(path).encode(part.column(1))
                flat, at = ids.astype("<u4"), offsets.tolist()
                sha = [hashlib.sha256(flat[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]
                decoded = [hashlib.sha256(x).hexdigest() for x in model(path).decode(ids, offsets)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.array(sha, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(load(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")))
