"""Counting quotient filters: a multiset of 64-bit fingerprints as sorted remainders in the runs of their quotients.

A filter holds the fingerprints of one segment (the leading ``seg_bits`` bits). The next ``q`` bits are the quotient, which
names a run; the other r bits are the remainder, stored in the run in rising order, in slots of r bits. A remainder that occurs
once takes one slot. One that occurs oftener takes two (itself twice: never so for distinct remainders) and its count in as many
more as 48 bits need. Nothing is lost, so filters of unlike ``q`` merge exactly: their runs are read in order, which is the order
of the fingerprints, and two sorted sequences are merged at a time, counts of equal ones being added.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<BBQQ")
COUNT_BITS = 48
#: Slots packed at a time, a multiple of 8.
_BLOCK = 1 << 16


def tally(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints, rising, and how often each occurs."""
    return np.unique(fps, return_counts=True)


def merge_sorted(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two rising sequences of distinct fingerprints with counts as one."""
    at = np.searchsorted(a, b)
    same = a[np.minimum(at, len(a) - 1)] == b if len(a) else np.zeros(len(b), bool)
    n_a = n_a.copy()
    n_a[at[same]] += n_b[same]
    return np.insert(a, at[~same], b[~same]), np.insert(n_a, at[~same], n_b[~same])


def pack(slots: np.ndarray, r: int) -> bytes:
    """The r low bits of each slot, one after another."""
    blocks = (slots[i : i + _BLOCK] for i in range(0, len(slots), _BLOCK))
    return b"".join(np.packbits(np.unpackbits(x.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - r :]).tobytes() for x in blocks)


def unpack(data: np.ndarray, n: int, r: int) -> np.ndarray:
    out, step = np.zeros(n, np.uint64), _BLOCK * r // 8
    for i, at in zip(range(0, n, _BLOCK), range(0, len(data), step), strict=True):
        size = min(_BLOCK, n - i)
        bits = np.zeros((size, 64), np.uint8)
        bits[:, 64 - r :] = np.unpackbits(data[at : at + step])[: size * r].reshape(size, r)
        out[i : i + size] = np.packbits(bits, axis=1).view(">u8").ravel()
    return out


class CountingQuotientFilter:
    def __init__(self, segment: int, seg_bits: int, q: int, occupied: np.ndarray, runends: np.ndarray, slots: np.ndarray):
        self.segment, self.seg_bits, self.q, self.occupied, self.runends, self.slots = segment, seg_bits, q, occupied, runends, slots

    @property
    def r(self) -> int:
        return 64 - self.seg_bits - self.q

    @staticmethod
    def _digits(r: int) -> int:
        return -(-COUNT_BITS // r)

    @classmethod
    def build(cls, fps: np.ndarray, counts: np.ndarray, segment: int, seg_bits: int) -> CountingQuotientFilter:
        """From distinct rising fingerprints of one segment and their counts."""
        q = max(3, int(len(fps) * 1.3).bit_length())
        r = np.uint64(64 - seg_bits - q)
        low = fps & np.uint64((1 << (64 - seg_bits)) - 1)
        quotient, rem = (low >> r).astype(np.int64), low & np.uint64((1 << int(r)) - 1)
        digits = cls._digits(int(r))
        width = np.where(counts > 1, 2 + digits, 1)
        start = np.flatnonzero(np.r_[True, quotient[1:] != quotient[:-1]]) if len(fps) else np.zeros(0, np.int64)
        run_q, run_len = quotient[start], np.add.reduceat(width, start) if len(start) else np.zeros(0, np.int64)
        before = np.cumsum(run_len) - run_len
        at = before + np.maximum.accumulate(run_q - before) if len(start) else before  # a run is pushed on by those before it
        size = max(1 << q, int(at[-1] + run_len[-1]) if len(start) else 0)
        occupied, runends, slots = np.zeros(1 << q, bool), np.zeros(size, bool), np.zeros(size, np.uint64)
        occupied[run_q] = True
        runends[at + run_len - 1] = True
        inside = np.cumsum(width) - width
        of_run = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(fps)]))
        slot = at[of_run] + inside - before[of_run] if len(fps) else inside
        slots[slot] = rem
        many = counts > 1
        slots[slot[many] + 1] = rem[many]
        for d in range(digits):  # the last digit first
            slots[slot[many] + 1 + digits - d] = (counts[many].astype(np.uint64) >> (r * np.uint64(d))) & np.uint64((1 << int(r)) - 1)
        return cls(segment, seg_bits, q, occupied, runends, slots)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct rising fingerprints and their counts."""
        run_q, ends = np.flatnonzero(self.occupied), np.flatnonzero(self.runends)
        # the start of a run: its canonical slot, or where the run before it ends
        starts = np.maximum(run_q, np.r_[-1, ends[:-1]] + 1) if len(ends) else ends
        lens = ends - starts + 1
        base = np.repeat(starts - (np.cumsum(lens) - lens), lens)
        flat = self.slots[base + np.arange(len(base))]
        of = np.repeat(run_q, lens)
        # within a run, a remainder equal to the one before it announces a count in the slots after it
        kind = np.zeros(len(flat), np.int8)
        digits = self._digits(self.r)
        if len(flat) > 2:
            twin = np.flatnonzero((flat[1:] == flat[:-1]) & (of[1:] == of[:-1])) + 1
            # a count may happen to equal its remainder: walk over the announcements in order, skipping what they announce
            taken = -1
            for i in twin.tolist():
                if i - 1 > taken:
                    kind[i], kind[i + 1 : i + 1 + digits], taken = 1, 2, i + digits
        head = np.flatnonzero(kind == 0)
        counts = np.ones(len(head), np.int64)
        nxt = np.minimum(head + 1, max(len(flat) - 1, 0))
        many = (kind[nxt] == 1) & (head + 1 < len(flat)) if len(flat) else np.zeros(0, bool)
        r = np.uint64(self.r)
        counts[many] = sum(flat[head[many] + 1 + digits - d] << (r * np.uint64(d)) for d in range(digits)).astype(np.int64)
        top = np.uint64(self.segment << (64 - self.seg_bits)) if self.seg_bits else np.uint64(0)
        return top | (of[head].astype(np.uint64) << r) | flat[head], counts

    def to_bytes(self) -> bytes:
        return _HEAD.pack(self.seg_bits, self.q, self.segment, len(self.slots)) + np.packbits(self.occupied).tobytes() + np.packbits(self.runends).tobytes() + pack(self.slots, self.r)

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        seg_bits, q, segment, size = _HEAD.unpack_from(data)
        at, n, raw = _HEAD.size, (1 << q) // 8, np.frombuffer(data, np.uint8)
        occupied = np.unpackbits(raw[at : at + n]).astype(bool)
        runends = np.unpackbits(raw[at + n : at + n + (size + 7) // 8])[:size].astype(bool)
        return cls(segment, seg_bits, q, occupied, runends, unpack(raw[at + n + (size + 7) // 8 :], size, 64 - seg_bits - q))

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """Lossless: the sorted remainders of two at a time are merged, run after run, and equal ones' counts added."""
        parts = [f.items() for f in filters]
        while len(parts) > 1:
            pairs = [merge_sorted(*a, *b) for a, b in zip(parts[::2], parts[1::2], strict=False)]
            parts = pairs + parts[len(pairs) * 2 :]
        return cls.build(*parts[0], filters[0].segment, filters[0].seg_bits)
