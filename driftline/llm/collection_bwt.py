"""The Burrows-Wheeler transform and common prefixes of a collection, built column by column through sequential files.

Each round inserts one symbol of every string, from the last to the first. The transform has, for each suffix in order, the
symbol before it. So a suffix that a symbol begins comes after as many suffixes as the transform has smaller symbols, and equal
ones before the place of what follows it (LF mapping): one pass over the transform, with a count for each symbol, gives the
places of the new suffixes, and the suffixes next to them. Two neighbours that begin with the same symbol have one symbol more in
common than what follows either has, which is the least common prefix between these two places: one pass over the common
prefixes answers that for all of them. A third pass merges the new suffixes into the files of the round (transform, common
prefixes, places), which are written one after another while those of the round before are read.

Files are read and written in blocks of BLOCK entries. What stays in memory besides the text is a few numbers for each string,
symbol and block.

A symbol is SYMBOL bytes; each string of bytes enters once for each of its SYMBOL phases, so that every byte begins a suffix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SYMBOL = 40
_WORD = 8
#: Entries of a file that are held at a time.
BLOCK = 1 << 18
_KINDS = {"transform": np.int32, "common": np.uint8, "place": np.int32}


class RoundFiles:
    """The files of a round in a folder, read and written in order; those of the round before are deleted once the next are written."""

    def __init__(self, folder: str):
        from driftline.llm.base import filesystem

        self.fs, self.root = filesystem(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.round = 0

    def _name(self, name: str, k: int) -> str:
        return f"{self.root}/{name}.{k}"

    def writer(self) -> dict:
        return {name: self.fs.open_output_stream(self._name(name, self.round + 1), compression=None) for name in _KINDS}

    def done(self, sinks: dict) -> None:
        for name, out in sinks.items():
            out.close()
            if self.round:
                self.fs.delete_file(self._name(name, self.round))
        self.round += 1

    def reader(self, name: str):
        return self.fs.open_input_stream(self._name(name, self.round), compression=None)

    def blocks(self, name: str) -> Iterator[np.ndarray]:
        with self.reader(name) as f:
            while len(part := take(f, name, BLOCK)):
                yield part

    def clear(self) -> None:
        self.fs.delete_dir(self.root)


def take(f, name: str, n: int) -> np.ndarray:
    """The next n entries, fewer at the end."""
    size, parts = n * np.dtype(_KINDS[name]).itemsize, []
    while size and (part := f.read(size)):
        parts.append(part)
        size -= len(part)
    return np.frombuffer(b"".join(parts), _KINDS[name])


def put(sinks: dict, **arrays: np.ndarray) -> None:
    for name, a in arrays.items():
        if len(a):
            sinks[name].write(memoryview(np.ascontiguousarray(a, _KINDS[name])).cast("B"))


def symbols(data: np.ndarray) -> np.ndarray:
    """Codes of the SYMBOL bytes from each place, from 1, equal iff the bytes are; places too near the end have none.

    Places are sorted by a hash of the bytes; neighbours with one hash are compared byte for byte. (Any fixed order of symbols
    gives the same common prefixes.)
    """
    n = len(data) - SYMBOL + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    value = np.zeros(len(data) - _WORD + 1, np.uint64)
    for j in range(_WORD):
        value = (value << np.uint64(8)) | data[j : j + len(value)]
    h = np.zeros(n, np.uint64)
    for j in range(0, SYMBOL, _WORD):
        h = (h ^ value[j : j + n]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    order = np.argsort(h)
    new = np.r_[True, h[order[1:]] != h[order[:-1]]]
    twin = np.flatnonzero(~new)
    x, y = order[twin], order[twin - 1]
    if any((value[x + j] != value[y + j]).any() for j in range(0, SYMBOL, _WORD)):  # two symbols share a hash
        order = np.lexsort([value[j : j + n] for j in range(0, SYMBOL, _WORD)])
        new = np.r_[True, np.any([value[order[1:] + j] != value[order[:-1] + j] for j in range(0, SYMBOL, _WORD)], axis=0)]
    code = np.empty(n, np.int64)
    code[order] = np.cumsum(new)
    return code


class LeastOver:
    """Least value of an array over ranges, by doubling."""

    def __init__(self, values: np.ndarray, longest: int):
        self.levels, step = [values], 1
        while step * 2 <= longest:
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Over a..b, both included."""
        out, size = np.zeros(len(a), np.uint8), b - a + 1
        level = np.frexp(size.astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            v = self.levels[k]
            out[at] = np.minimum(v[a[at]], v[b[at] - (1 << k) + 1])
        return out


def _neighbours(files: RoundFiles, pending: np.ndarray, asked: np.ndarray, before: np.ndarray, n_strings: int) -> tuple[np.ndarray, ...]:
    """One pass over the transform. pending: rising places of the entries whose symbol begins a new suffix; asked: whether a symbol is one of theirs; before: how many entries have a smaller one.

    Entries of other symbols only count in ``before``: no new suffix comes between those that they begin.

    Returns the new suffix of each pending entry, and (suffix, a, b) for each suffix that is new or follows a new one and begins
    with the same symbol as the one before it: a - 1 and b are the places of what follows the two symbols.
    """
    seen, last, last_new = np.zeros(len(before), np.int64), np.full(len(before), -1, np.int64), np.zeros(len(before), bool)
    spot, found, low = np.zeros(len(pending), np.int64), [], 0
    for t in files.blocks("transform"):
        i, j = np.searchsorted(pending, (low, low + len(t)))
        is_new = np.zeros(len(t), bool)
        is_new[pending[i:j] - low] = True
        nz = np.flatnonzero(asked[t])
        key = (t[nz].astype(np.int64) << 32) | nz
        key.sort()
        sym, idx = key >> 32, key & 0xFFFFFFFF
        first = np.r_[True, sym[1:] != sym[:-1]] if len(sym) else np.zeros(0, bool)
        start = np.flatnonzero(first)
        size = np.diff(np.r_[start, len(sym)])
        suffix = n_strings + before[sym] + seen[sym] + np.arange(len(sym)) - np.repeat(start, size)
        new = is_new[idx]
        spot[np.searchsorted(pending, idx[new] + low)] = suffix[new]
        prev, prev_new = np.r_[0, idx[:-1]] + low, np.r_[False, new[:-1]]
        prev[first], prev_new[first] = last[sym[first]], last_new[sym[first]]
        want = (new | prev_new) & (prev >= 0)
        found.append((suffix[want], prev[want] + 1, idx[want] + low))
        ends = start + size - 1
        seen[sym[start]] += size
        last[sym[start]], last_new[sym[start]] = idx[ends] + low, new[ends]
        low += len(t)
    return (spot, *(np.concatenate(x) for x in zip(*found, strict=True)))


def _least_common(files: RoundFiles, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One pass over the common prefixes: the least from place a to place b, both included, of each pair."""
    out, least = np.full(len(a), 255, np.uint8), []
    of_a, of_b = a // BLOCK, b // BLOCK
    by_a, by_b = np.argsort(of_a, kind="stable"), np.argsort(of_b, kind="stable")
    for k, c in enumerate(files.blocks("common")):
        low = k * BLOCK
        begin = by_a[slice(*np.searchsorted(of_a[by_a], (k, k + 1)))]
        end = by_b[slice(*np.searchsorted(of_b[by_b], (k, k + 1)))]
        inside = begin[of_b[begin] == k]
        if len(inside):
            out[inside] = LeastOver(c, int((b[inside] - a[inside]).max()) + 1)(a[inside] - low, b[inside] - low)
        begin, end = begin[of_b[begin] > k], end[of_a[end] < k]
        out[begin] = np.minimum(out[begin], np.minimum.accumulate(c[::-1])[::-1][a[begin] - low])
        out[end] = np.minimum(out[end], np.minimum.accumulate(c)[b[end] - low])
        least.append(c.min())
    far = np.flatnonzero(of_b - of_a > 1)  # whole blocks between
    if len(far):
        out[far] = np.minimum(out[far], LeastOver(np.array(least, np.uint8), len(least))(of_a[far] + 1, of_b[far] - 1))
    return out


def _merge(files: RoundFiles, spot: np.ndarray, new: dict[str, np.ndarray], changed: np.ndarray, common: np.ndarray, size: int) -> None:
    """Write the next round's files: old entries in order around the new ones at the rising places ``spot``, and common prefixes at the rising places ``changed``."""
    sinks, sources = files.writer(), {name: files.reader(name) for name in _KINDS}
    for low in range(0, size, BLOCK):
        high = min(low + BLOCK, size)
        i, j = np.searchsorted(spot, (low, high))
        old = np.ones(high - low, bool)
        old[spot[i:j] - low] = False
        n_old, out = high - low - (j - i), {}
        for name, kind in _KINDS.items():
            out[name] = np.empty(high - low, kind)
            out[name][old], out[name][~old] = take(sources[name], name, n_old), new[name][i:j]
        x, y = np.searchsorted(changed, (low, high))
        out["common"][changed[x:y] - low] = common[x:y]
        put(sinks, **out)
    for f in sources.values():
        f.close()
    files.done(sinks)


def build(data: np.ndarray, offsets: np.ndarray, files: RoundFiles) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """data: all strings' bytes; offsets: where each begins, and the end.

    Yields, in blocks, the places (in data) of all suffixes in order, and for each the length of its common prefix, in symbols
    up to 255, with the one before. Suffixes of less than a symbol are left out.
    """
    code = symbols(data)
    begin = (offsets[:-1, None] + np.arange(SYMBOL)).ravel()
    n_symbols = np.maximum(np.repeat(offsets[1:], SYMBOL) - begin, 0) // SYMBOL
    begin, n_symbols = begin[n_symbols > 0], n_symbols[n_symbols > 0]
    n_strings = len(begin)
    at = begin + (n_symbols - 1) * SYMBOL  # the place of the symbol that each string inserts next
    live, rank = np.arange(n_strings), np.arange(n_strings)  # rank: of what follows that symbol; the empty suffixes come first, in order of strings
    counts = np.bincount(code[at], minlength=int(code.max(initial=0)) + 1)  # of each symbol in the transform
    sinks, size = files.writer(), n_strings
    for low in range(0, n_strings, BLOCK):
        some = at[low : low + BLOCK]
        put(sinks, transform=code[some], common=np.zeros(len(some)), place=np.full(len(some), -1))
    files.done(sinks)
    while len(live):
        before = np.cumsum(counts) - counts
        asked = np.zeros(len(counts), bool)
        asked[code[at[live]]] = True
        spot, suffix, a, b = _neighbours(files, rank[live], asked, before, n_strings)
        common = np.minimum(_least_common(files, a, b), 254) + np.uint8(1)
        by_suffix, by_spot = np.argsort(suffix), np.argsort(spot)
        rank[live] = spot
        who = live[by_spot]
        place = at[who]
        preceding = np.where(place - SYMBOL >= begin[who], code[np.maximum(place - SYMBOL, 0)], 0)
        size += len(who)
        _merge(files, spot[by_spot], {"transform": preceding, "common": np.zeros(len(who), np.uint8), "place": place}, suffix[by_suffix], common[by_suffix], size)
        counts += np.bincount(preceding[preceding > 0], minlength=len(counts))
        at[who] -= SYMBOL
        live = who[at[who] >= begin[who]]  # in order of rank
    for place, common in zip(files.blocks("place"), files.blocks("common"), strict=True):
        yield place[place >= 0], common[place >= 0]
