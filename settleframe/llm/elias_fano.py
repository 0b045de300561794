"""Elias-Fano coded monotone sequences over numpy arrays, for many queries at once.

A sequence of n values below u keeps the low ``floor(log2(u / n))`` bits of each
packed, and the high parts in unary: bit ``high + i`` is set for value i, about two
bits a value. A small directory (set bits before each 64-bit word) makes access
and search fast. All arrays can be views of a memory-mapped file.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np

_ONE = np.uint64(1)


_L8, _H8 = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_IN_BYTE = np.zeros((256, 8), np.int64)     # place of the r-th set bit of a byte
for _b in range(256):
    _set = [i for i in range(8) if _b >> i & 1]
    _IN_BYTE[_b, :len(_set)] = _set


def _select_in_word(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the rank-th set bit of each word (which has one): its byte by
    prefix sums of the bytes' counts, then by a table."""
    x = words - ((words >> np.uint64(1)) & np.uint64(0x5555555555555555))
    x = (x & np.uint64(0x3333333333333333)) + ((x >> np.uint64(2)) & np.uint64(0x3333333333333333))
    x = ((x + (x >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _L8
    rank = rank.astype(np.uint64)
    shift = np.bitwise_count((((rank * _L8) | _H8) - x) & _H8).astype(np.uint64) << np.uint64(3)
    rank -= ((x << np.uint64(8)) >> shift) & np.uint64(255)
    return shift.astype(np.int64) + _IN_BYTE[((words >> shift) & np.uint64(255)).astype(np.int64), rank.astype(np.int64)]


def _next_in_word(words: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Place of the first set bit behind ``place`` in each word, or -1."""
    rest = (words >> (place & 63).astype(np.uint64)) >> _ONE
    return np.where(rest == 0, -1, place + 1 + np.bitwise_count((rest & -rest) - _ONE))


@dataclass
class EliasFano:
    n: int
    low_bits: int
    low: np.ndarray     # packed, uint64
    high: np.ndarray    # unary, uint64
    ones: np.ndarray    # set bits before each word of ``high``, uint32 or uint64

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        """``values``: non-decreasing, below ``universe``."""
        n = len(values)
        l = max(0, (universe // max(1, n)).bit_length() - 1)
        values = values.astype(np.uint64)
        low = np.zeros(n * l // 64 + 2, np.uint64)
        if l and n:
            part = values & np.uint64((1 << l) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(l)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(l) > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        tops = (values >> np.uint64(l)).astype(np.int64)
        size = n + ((universe >> l) + 2)
        high = np.zeros(size // 64 + 1, np.uint64)
        place = tops + np.arange(n)
        np.bitwise_or.at(high, place >> 6, _ONE << (place & 63).astype(np.uint64))
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high), dtype=np.int64)[:-1]))
        return cls(n, l, low, high, ones.astype(np.uint32 if n < 2**32 else np.uint64))

    def arrays(self) -> dict[str, np.ndarray]:
        return {"low": self.low, "high": self.high, "ones": self.ones}

    def _low(self, i: np.ndarray) -> np.ndarray:
        l = self.low_bits
        if not l:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(l)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        left = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> shift) | left) & np.uint64((1 << l) - 1)

    def _place(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each value's bit, and its word."""
        word = np.searchsorted(self.ones, i.astype(self.ones.dtype), "right") - 1
        return word * 64 + _select_in_word(self.high[word], i - self.ones[word].astype(np.int64)), word

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at places ``i`` (all within 0..n-1)."""
        return self._value(i, self._place(i)[0])

    def access_two(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values at places ``i`` and ``i + 1`` (all within 0..n-1)."""
        place, word = self._place(i)
        after = _next_in_word(self.high[word], place)
        far = np.flatnonzero(after < 0)
        after[far] = self._place(i[far] + 1)[0]
        return self._value(i, place), self._value(i + 1, after)

    def _value(self, i: np.ndarray, place: np.ndarray) -> np.ndarray:
        return ((place - i).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i)

    def _zeros(self) -> np.ndarray:
        known = self.__dict__.get("_zeros_before")
        if known is None:
            known = self.__dict__["_zeros_before"] = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones.astype(np.int64)
        return known

    def _zero(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the ``t``-th zero bit, and its word."""
        zeros = self._zeros()
        word = np.searchsorted(zeros, t, "right") - 1
        return word * 64 + _select_in_word(~self.high[word], t - zeros[word]), word

    def _bucket(self, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of values whose high part is below ``top``, and at most ``top``."""
        t = np.maximum(top - 1, 0)
        place, word = self._zero(t)
        after = np.where(top > 0, _next_in_word(~self.high[word], place), place)
        far = np.flatnonzero(after < 0)
        after[far] = self._zero(top[far])[0]
        return np.where(top > 0, place - t, 0), after - top

    def search(self, x: np.ndarray, lo: np.ndarray | int = 0, hi: np.ndarray | None = None) -> np.ndarray:
        """Place of each ``x`` among the values at lo..hi-1, or -1. The high part
        names a bucket of neighbouring values, its low bits are searched by halving."""
        if not self.n:
            return np.full(len(x), -1, np.int64)
        top = (x >> np.uint64(self.low_bits)).astype(np.int64)
        limit = int(len(self.high) * 64 - self.n - 1)
        fits = top < limit
        top = np.minimum(top, limit - 1)
        a, end = self._bucket(top)
        a, end = np.maximum(a, lo), np.minimum(end, self.n if hi is None else hi)
        want = x & np.uint64((1 << self.low_bits) - 1)
        b = end.copy()
        while True:
            live = np.flatnonzero(a < b)
            if not len(live):
                break
            mid = (a[live] + b[live]) >> 1
            below = self._low(mid) < want[live]
            a[live] = np.where(below, mid + 1, a[live])
            b[live] = np.where(below, b[live], mid)
        found = np.full(len(x), -1, np.int64)
        hit = np.flatnonzero(fits & (a < end))
        same = self._low(a[hit]) == want[hit]
        found[hit[same]] = a[hit[same]]
        return found


def pack_file(arrays: dict[str, np.ndarray], facts: dict) -> bytes:
    """One file: a header line (facts and the place of each array), then the
    arrays, each at a multiple of 64 bytes."""
    at, places, parts = 0, {}, []
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        places[name] = [a.dtype.str, len(a), at]
        parts.append(raw + b"\0" * (-len(raw) % 64))
        at += len(parts[-1])
    head = json.dumps({"facts": facts, "arrays": places}).encode()
    head += b" " * (-(len(head) + 1) % 64) + b"\n"
    return head + b"".join(parts)


def map_file(path: str) -> tuple[dict[str, np.ndarray], dict]:
    """Arrays of a packed file as views of a memory map, and its facts."""
    data = np.memmap(path, np.uint8, "r")
    with open(path, "rb") as f:
        head = f.readline()
    spec = json.loads(head)
    found = {}
    for name, (kind, n, at) in spec["arrays"].items():
        size = np.dtype(kind).itemsize * n
        found[name] = np.asarray(data[len(head) + at: len(head) + at + size]).view(kind)
    return found, spec["facts"]


def from_arrays(arrays: dict[str, np.ndarray], prefix: str, n: int, low_bits: int) -> EliasFano:
    return EliasFano(n, low_bits, *(arrays[f"{prefix}_{a}"] for a in ("low", "high", "ones")))
