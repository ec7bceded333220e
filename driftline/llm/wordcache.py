"""Encoding texts by their distinct words: each unit is encoded once for each batch, or taken from a bounded cache."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units that a worker's cache keeps; beyond that it starts anew.
CACHE_UNITS = 250_000

#: ASCII marks that may trail a word, without the apostrophe, which can begin a token with letters.
TRAIL = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"
#: Ends of words after which such a mark begins a token of its own.
_SOLID = r"[A-Za-z0-9À-ÖØ-öø-ÿ]$"


class UnitEncoder:
    """Maps units (strings) to ids by ``encode``, which takes distinct units and gives all their ids and each one's number of them."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = CACHE_UNITS):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.ids, self.n_ids = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.lens = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _add(self, units: list[str]) -> int:
        """Stores the units' ids; returns the place of the first."""
        flat, lens = self.encode(units)
        first, n = len(self.at), len(units)
        while first + n > len(self.begin):
            self.begin, self.lens = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.lens))
        while self.n_ids + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.begin[first : first + n] = self.n_ids + np.cumsum(lens) - lens
        self.lens[first : first + n] = lens
        self.ids[self.n_ids : self.n_ids + len(flat)] = flat
        self.n_ids += len(flat)
        self.at.update(zip(units, range(first, first + n), strict=True))
        return first

    def places(self, distinct: pa.Array) -> np.ndarray:
        """Where the distinct units are in ``begin`` and ``lens``."""
        units = distinct.to_pylist()
        get = self.at.get
        at = np.fromiter((get(u, -1) for u in units), np.int64, len(units))
        missing = np.flatnonzero(at < 0)
        if len(self.at) + len(missing) > self.most:
            self._clear()
            missing = np.arange(len(units))
        if len(missing):
            first = self._add([units[i] for i in missing.tolist()])
            at[missing] = np.arange(first, first + len(missing))
        return at

    def gather(self, places: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units at the places, in order, and where the texts that begin at the unit offsets begin in them."""
        take, begin = self.lens[places], self.begin[places]
        ends = np.cumsum(take)
        ids = self.ids[np.repeat(begin - (ends - take), take) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.r_[0, ends][offsets]

    def __call__(self, units: pa.Array, offsets: np.ndarray, trim: bool = False, uncut: Sequence[str] = ()) -> tuple[np.ndarray, np.ndarray]:
        """units: of all texts in order; offsets: where each text's units begin, and the end. Returns all ids and each text's offsets in them.

        trim: marks that trail a word are units of their own (for tokenizers without a token across such a place). Words that
        contain a string of ``uncut`` stay whole.
        """
        coded = pc.dictionary_encode(units)
        index = coded.indices.to_numpy(zero_copy_only=False)
        if not trim:
            return self.gather(self.places(coded.dictionary)[index] if len(index) else index, offsets)
        whole = coded.dictionary
        core = pc.utf8_rtrim(whole, TRAIL)
        cut = pc.and_(pc.match_substring_regex(core, _SOLID), pc.less(pc.binary_length(core), pc.binary_length(whole)))
        for kept in uncut:
            cut = pc.and_not(cut, pc.match_substring(whole, kept))
        rows = np.flatnonzero(cut.to_numpy(zero_copy_only=False))
        core = pc.if_else(cut, core, whole)
        tails = [w[len(c) :] for w, c in zip(whole.take(pa.array(rows)).to_pylist(), core.take(pa.array(rows)).to_pylist(), strict=True)]
        both = pc.dictionary_encode(pa.concat_arrays([core, pa.array(tails, pa.string())]))
        at = self.places(both.dictionary)[both.indices.to_numpy(zero_copy_only=False)] if len(both) else np.zeros(0, np.int64)
        first, second = at[: len(whole)], np.full(len(whole), -1, np.int64)
        second[rows] = at[len(whole) :]
        # two places for a word that was cut, one for others
        pairs = np.stack([first[index], second[index]], axis=1).ravel() if len(index) else np.zeros(0, np.int64)
        there = pairs >= 0
        return self.gather(pairs[there], np.r_[0, np.cumsum(there)][np.asarray(offsets) * 2])


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words between ASCII white space of all texts, and where each text's begin."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy()
    words = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if full.all():
        return words, offsets
    return words.filter(pa.array(full)), np.r_[0, np.cumsum(full)][offsets]
