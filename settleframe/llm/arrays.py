"""Array helpers used inside tasks: splitting Arrow text columns into words and
hashing them, many texts at a time.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``; bytes A-Z count
as a-z. As no byte of a multi-byte UTF-8 character falls in these ranges,
working on bytes equals working on characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20     # texts handled at once (one longer text goes alone)
HASH_BYTES = 1 << 20      # bytes hashed at once

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift, multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, seed: int = 1) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    start = np.uint64((seed * _GOLDEN) % 2**64)
    return mix(start + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_GOLDEN)) | np.uint64(1)


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = seeds(256, 7)
_VALUE[65:91] = _VALUE[97:123]
_VALUE[_BLANK] = 0
_POWERS = np.multiply.accumulate(np.full(256, _STEP, np.uint64))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = np.multiply.accumulate(np.full(1 << (n - 1).bit_length(), _STEP, np.uint64))
    return _POWERS


@dataclass
class Words:
    """Words of some texts in reading order: hash of each, and the index of the
    first word of each text (one more entry than texts)."""
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array (null: empty) and the offset of each text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def split_words(texts: pa.Array) -> Words:
    """Hashes of all words. Two words share a hash only by a 64-bit collision."""
    raw, offsets = text_buffer(texts)
    word = ~_BLANK[raw]
    opens = word.copy()
    opens[1:] &= ~word[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    opens[begins] = word[begins]
    starts = np.flatnonzero(opens)
    del opens
    hashes = np.empty(len(starts), np.uint64)
    edges = np.append(starts, len(raw))
    k = 0
    while k < len(starts):
        j = max(k + 1, int(np.searchsorted(edges, edges[k] + HASH_BYTES, "right")) - 1)
        a, b = int(edges[k]), int(edges[j])
        own = starts[k:j] - a
        gaps = np.diff(np.append(own, b - a))
        place = np.arange(b - a) - np.repeat(own, gaps)
        terms = _VALUE[raw[a:b]] * _powers(int(gaps.max()) + 1)[place]
        hashes[k:j] = np.add.reduceat(terms, own)
        k = j
    return Words(mix(hashes), np.searchsorted(starts, offsets))


def slices(batch: pa.RecordBatch, text_col: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most ``limit`` bytes of text, or of one row."""
    lengths = batch.column(text_col).cast(pa.large_string())
    ends = np.frombuffer(lengths.buffers()[1], np.int64)[lengths.offset: lengths.offset + len(lengths) + 1]
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(ends, ends[at] + limit, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def run_positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... for each run, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    base = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return base + np.arange(total)
