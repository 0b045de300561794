"""Language-model scoring with an Elias-Fano n-gram trie.

The model interpolates orders 1 to ``ORDER`` with absolute discounting:

    p1(w)     = (c(w) + 0.1) / (N + 0.1 (V + 1))
    pk(w | h) = max(c(h w) - D, 0) / c(h) + back(h) * p(k-1)(w | shorter h)

over the n-grams seen at least ``min_count`` times in training (orders 2 and up;
all words are kept; the registered query keeps all n-grams, ``min_count=1``). ``back(h)`` is what the kept n-grams leave over, so the
distribution sums to at most one, also after rounding to 8-bit codes.

The trie is built level by level. Tasks count the n-grams of their documents and
send sorted blocks (differences, compressed) to a level's segments; a segment
sums the counts, drops rare n-grams, and writes one file with

* the words' hashes (level 1) or the children (level 2 and up) as Elias-Fano
  sequences; a node's children are coded relative to the end of the node before
  it, which makes the whole level monotone, and pointers to each node's first
  child are a second monotone sequence;
* 8-bit codes of the discounted probabilities and, per node, of ``back``.

An n-gram can be frequent only if its two shorter parts are, so a level counts only
extensions of what the level before kept: nothing frequent is missed, and far
less is sent. Level k is segmented by ranges of parent nodes and by a class of the
child, so that the children of one very common word are spread over several
segments. Scoring tasks map the files (a shared folder's own files where it is a
local path, else a copy fetched once per worker) and look up a child by
successor search between its parent's pointers.

The files grow with the corpus: about 10 bytes a word and 6 a kept n-gram;
``min_count`` is the parameter to trade size for detail.

Defined results: null text counts as empty (the end token alone). A null id is
not held out. Repeated rows are learned and scored each. Without training rows
every word is unknown. Extra columns are not carried.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settleframe.llm.arrays import mix, slices, split_words
from settleframe.llm.elias_fano import EliasFano, from_arrays, map_file, pack_file
from settleframe.llm.workers import ship
from settleframe.session import scratch_path

ORDER = 3
MIN_COUNT = 2
DISCOUNT = 0.75
RANGE = 1 << 21            # parent nodes per segment, a power of two
CLASSES = 8                # child classes per range, a power of two
WORD_SEGMENT_BYTES = 1 << 25   # text bytes per segment of level 1
MAX_HELD = 1_500_000       # counted keys a task holds before it sends them
SLICE = 1 << 21
END = mix(np.array([0x0E2D], np.uint64))[0]
_Q_STEP, _BACK_STEP = 10.0, 32.0     # codes per halving

_BLOCKS = "segment int, class int, keys binary, counts binary, n long"
_FILES = "level int, segment int, class int, path string, n long, tokens long, sums binary, parents binary"


def _planes(values: np.ndarray) -> bytes:
    """Compressed little-endian bytes, all first bytes, then all second ones, ..."""
    return zlib.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes(), 1)


def _unplanes(data: bytes, kind: str, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(size, n).T).view(kind).reshape(n)


def _block(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, int]:
    return _planes(np.diff(keys, prepend=np.uint64(0))), _planes(counts.astype(np.uint32)), len(keys)


def _read_block(keys: bytes, counts: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(_unplanes(keys, "<u8", n), dtype=np.uint64), _unplanes(counts, "<u4", n).astype(np.int64)


def _sum_by_key(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _split(parent: np.ndarray, child: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """File (range and class), parent in its range, child in its class."""
    bits, classes = (RANGE - 1).bit_length(), (CLASSES - 1).bit_length()   # shifts: divisions take several times as long
    return ((parent >> bits) << classes) | (child & (CLASSES - 1)), parent & (RANGE - 1), child >> classes


def _packed(file: np.ndarray, parent: np.ndarray, child: np.ndarray) -> tuple[np.ndarray | None, int]:
    """One number for each (file, parent in its range, child), in that order, and the
    bits of the child; none where they do not fit 63 bits."""
    bits = int(child.max()).bit_length()
    both = bits + (RANGE - 1).bit_length()
    if int(file.max()).bit_length() + both > 63:
        return None, bits
    return (file << both) | (parent << bits) | child, bits


def _sum_by_file(file: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of equal (file, key), in that order."""
    packed, _ = _packed(file, (keys >> np.uint64(42)).astype(np.int64), (keys & np.uint64((1 << 42) - 1)).astype(np.int64))
    order = np.lexsort((keys, file)) if packed is None else np.argsort(packed)
    file, keys, counts = file[order], keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (file[1:] != file[:-1]))))
    return file[first], keys[first], np.add.reduceat(counts, first)


def _code(p: np.ndarray, step: float, up: bool) -> np.ndarray:
    """8-bit code of a probability in (0, 1]; ``up``: never a greater value."""
    x = -np.log2(np.maximum(p, 1e-30)) * step
    return np.clip(np.ceil(x - 1e-9) if up else np.round(x), 0, 255).astype(np.uint8)


_Q_VALUES = 2.0 ** (-np.arange(256) / _Q_STEP)
_BACK_VALUES = 2.0 ** (-np.arange(256) / _BACK_STEP)


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    uri = re.sub(r"^file:/(?=[^/])", "file:///", folder)
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def _write(folder: str, data: bytes) -> str:
    """A file under a fresh name; only names that reach the manifest count."""
    fs, base = _open(folder)
    name = f"{uuid.uuid4().hex}.bin"
    with fs.open_output_stream(f"{base}/{name}") as out:
        out.write(data)
    return name


_LOCAL: dict[str, str] = {}


def _local(folder: str, name: str) -> str:
    fs, base = _open(folder)
    if isinstance(fs, pafs.LocalFileSystem):
        return f"{base}/{name}"
    key = f"{folder}/{name}"
    if key not in _LOCAL:
        path = os.path.join(tempfile.mkdtemp(prefix="lm-"), name)
        with fs.open_input_stream(f"{base}/{name}") as src, open(path, "wb") as out:
            while chunk := src.read(1 << 22):
                out.write(chunk)
        _LOCAL[key] = path
    return _LOCAL[key]


@dataclass
class Segment:
    """A mapped file. Level 1: ``keys`` are word hashes without the segment's top
    bits. Level 2 and up: ``pointers`` and ``children``."""
    arrays: dict[str, np.ndarray]
    facts: dict

    def part(self, name: str) -> EliasFano:
        known = self.__dict__.get(name)
        if known is None:
            known = self.__dict__[name] = from_arrays(self.arrays, name, *self.facts[name])
        return known

    def find(self, parent: np.ndarray, child: np.ndarray) -> np.ndarray:
        """Place of (parent, child) in the segment or -1: the range between the
        parent's pointers, the child relative to the value before that range."""
        pointers, children = self.part("pointers"), self.part("children")
        found = np.full(len(parent), -1, np.int64)
        ok = np.flatnonzero(parent < pointers.n - 1)
        begin, end = (x.astype(np.int64) for x in pointers.access_two(parent[ok]))
        some = begin < end
        ok, begin, end = ok[some], begin[some], end[some]
        if len(ok):
            # the value before the range and its first child lie side by side; most nodes have one child
            at, opens = np.maximum(begin - 1, 0), begin == 0
            base, least = children.access_two(at) if children.n > 1 else (children.access(at),) * 2
            base, least = np.where(opens, np.uint64(0), base), np.where(opens, base, least)
            x = base + child[ok].astype(np.uint64) + np.uint64(1)
            got = np.where(least == x, begin, -1)
            more = np.flatnonzero((least < x) & (end - begin > 1))
            got[more] = children.search(x[more], begin[more] + 1, end[more])
            found[ok] = got
        return found


@dataclass
class Model:
    """Manifest of a trie: small facts only; the files are mapped where used."""
    folder: str
    word_bits: int                                   # top bits of a hash that name its level 1 segment
    tokens: int = 0
    words: int = 0
    levels: list[dict] = field(default_factory=list)   # per level: {(segment, class): (base, file)}
    sizes: list[int] = field(default_factory=list)
    backs: list[dict] = field(default_factory=list)    # per level: {range: file of codes}
    order: int = ORDER

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def segment(self, level: int, key: tuple[int, int]) -> tuple[int, Segment] | None:
        known = self.__dict__.setdefault("_open", {})
        if (level, key) not in known:
            entry = self.levels[level - 1].get(key)
            known[level, key] = None if entry is None else (entry[0], Segment(*map_file(_local(self.folder, entry[1]))))
        return known[level, key]

    def back(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """What the children of each node leave over; 1 for nodes without any."""
        out = np.ones(len(nodes))
        known = self.__dict__.setdefault("_backs", {})
        ranges = nodes // RANGE
        ranges = ranges.astype(np.uint16) if len(ranges) and ranges.max() < 1 << 16 else ranges   # sorted by radix
        order = np.argsort(ranges, kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(ranges[order]) != 0, [True]))) if len(order) else []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = order[a:b]
            r = int(ranges[own[0]])
            name = self.backs[level - 1].get(r)
            if name is None:
                continue
            if (level, r) not in known:
                known[level, r] = map_file(_local(self.folder, name))[0]["codes"]
            out[own] = _BACK_VALUES[known[level, r][nodes[own] % RANGE]]
        return out

    def word_ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id or -1, training count) of words."""
        distinct, which = np.unique(hashes, return_inverse=True)
        ids, counts = np.full(len(distinct), -1, np.int64), np.zeros(len(distinct), np.int64)
        shift = np.uint64(64 - self.word_bits)
        part = (distinct >> shift).astype(np.int64) if self.word_bits else np.zeros(len(distinct), np.int64)
        edges = np.searchsorted(part, np.arange((1 << self.word_bits) + 1))
        for s in np.unique(part):
            held = self.segment(1, (int(s), 0))
            if held is None:
                continue
            base, seg = held
            own = slice(edges[s], edges[s + 1])
            rest = distinct[own] & (np.uint64(2**64 - 1) >> np.uint64(self.word_bits))
            at = seg.part("keys").search(rest)
            hit = at >= 0
            ids[own] = np.where(hit, at + base, -1)
            counts[own] = np.where(hit, seg.arrays["counts"][np.maximum(at, 0)].astype(np.int64), 0)
        return ids[which], counts[which]

    def children(self, level: int, parents: np.ndarray, words: np.ndarray, want: str) -> tuple[np.ndarray, np.ndarray]:
        """(node or -1, value) of each (parent node of level - 1, word id), both
        -1 for none; ``want``: the array that gives the value."""
        node, value = np.full(len(parents), -1, np.int64), np.zeros(len(parents), np.int64)
        live = np.flatnonzero((parents >= 0) & (words >= 0))
        if not len(live):
            return node, value
        # equal questions are asked once, in the order of the files
        p, w = parents[live], words[live]
        file, own, child = _split(p, w)
        packed, _ = _packed(file, own, child)
        if packed is None:
            order = np.lexsort((child, own, file))
            new = np.concatenate(([True], (np.diff(file[order]) != 0) | (np.diff(own[order]) != 0) | (np.diff(child[order]) != 0)))
        else:
            order = np.argsort(packed)
            new = np.concatenate(([True], np.diff(packed[order]) != 0))
        first, which = order[new], np.cumsum(new) - 1
        file, p, w = file[first], own[first], child[first]
        n, v = np.full(len(p), -1, np.int64), np.zeros(len(p), np.int64)
        cuts = np.flatnonzero(np.concatenate(([True], file[1:] != file[:-1], [True])))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            held = self.segment(level, (int(file[a]) // CLASSES, int(file[a]) % CLASSES))
            if held is None:
                continue
            base, seg = held
            at = seg.find(p[a:b], w[a:b])
            hit = at >= 0
            n[a:b] = np.where(hit, at + base, -1)
            v[a:b] = np.where(hit, seg.arrays[want][np.maximum(at, 0)], 0)
        node[live[order]] = n[which]
        value[live[order]] = v[which]
        return node, value


def tokens_of(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text with the end token behind them, and the
    place of each text's first token (one more entry than texts)."""
    words = split_words(piece.column("text"))
    first = words.first + np.arange(len(words.first))
    out = np.empty(first[-1], np.uint64)
    ends = first[1:] - 1
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[keep] = words.hashes
    out[ends] = END
    return out, first


def _nodes(model: Model, ids: np.ndarray, first: np.ndarray, level: int, want: str = "q") -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order 2..level: node and value of the n-gram that ends at each token."""
    found, node = [], ids
    opens = np.zeros(len(ids), bool)
    opens[first[:-1]] = True
    for k in range(2, level + 1):
        before = np.concatenate(([-1], node[:-1]))
        before[opens] = -1
        node, value = model.children(k, before, ids, want)
        found.append((node, value))
    return found


def _count_words(word_bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        keys, counts = _sum_by_key(*(np.concatenate(x) for x in zip(*held, strict=True)))
        held.clear()
        part = (keys >> np.uint64(64 - word_bits)).astype(np.int64) if word_bits else np.zeros(len(keys), np.int64)
        yield from _blocks_by(part, np.zeros(len(keys), np.int64), keys & (np.uint64(2**64 - 1) >> np.uint64(word_bits)), counts)

    for batch in batches:
        for piece in slices(batch, limit=SLICE):
            tokens, _ = tokens_of(piece)
            held.append(np.unique(tokens, return_counts=True))
            if sum(len(k) for k, _ in held) > MAX_HELD:
                yield from flush()
    if held:
        yield from flush()


def _blocks_by(segment: np.ndarray, cls: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Blocks per (segment, class) of rows in the order of segment, class and key."""
    cuts = np.flatnonzero(np.concatenate(([True], (segment[1:] != segment[:-1]) | (cls[1:] != cls[:-1]), [True]))) if len(keys) else []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        k, c, n = _block(keys[a:b], counts[a:b])
        yield pa.RecordBatch.from_arrays([pa.array([int(segment[a])], pa.int32()), pa.array([int(cls[a])], pa.int32()),
                                          pa.array([k], pa.binary()), pa.array([c], pa.binary()), pa.array([n], pa.int64())],
                                         ["segment", "class", "keys", "counts", "n"])


def _count_ngrams(model, level: int, min_count: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Extensions of the nodes of ``level - 1`` by one word."""
    model, held = model.value, []

    def flush() -> Iterator[pa.RecordBatch]:
        file, keys, counts = _sum_by_file(*(np.concatenate(x) for x in zip(*held, strict=True)))
        held.clear()
        yield from _blocks_by(file // CLASSES, file % CLASSES, keys, counts)

    for batch in batches:
        for piece in slices(batch, limit=SLICE):
            tokens, first = tokens_of(piece)
            ids, counts = model.word_ids(tokens)
            ids = np.where(counts >= min_count, ids, -1)
            chain = _nodes(model, ids, first, level - 1)
            # parent: the (level-1)-gram that ends one token before; Apriori: the one that ends here is kept too
            here = chain[-1][0] if chain else ids
            parent = np.concatenate(([-1], here[:-1]))
            parent[first[:-1]] = -1
            live = np.flatnonzero((parent >= 0) & (here >= 0))
            if not len(live):
                continue
            p, w = parent[live], ids[live]
            file, own, child = _split(p, w)
            key = (own.astype(np.uint64) << np.uint64(42)) | child.astype(np.uint64)
            held.append(_sum_by_file(file, key, np.ones(len(key), np.int64)))
            if sum(len(x[0]) for x in held) > MAX_HELD:
                yield from flush()
    if held:
        yield from flush()


def _ngram_counter(model, level: int, min_count: int):
    return lambda batches: _count_ngrams(model, level, min_count, batches)


def _merged(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = zip(*(_read_block(k, c, n) for k, c, n in zip(rows["keys"], rows["counts"], rows["n"], strict=True)), strict=True)
    return _sum_by_key(np.concatenate(keys), np.concatenate(counts))


def _file_row(level: int, rows: pd.DataFrame, path: str, n: int, tokens: int, sums: bytes = b"", parents: bytes = b"") -> pd.DataFrame:
    return pd.DataFrame({"level": [level], "segment": [int(rows["segment"].iloc[0])], "class": [int(rows["class"].iloc[0])],
                         "path": [path], "n": [n], "tokens": [tokens], "sums": [sums], "parents": [parents]})


def _narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.uint32 if not len(counts) or counts.max() < 2**32 else np.uint64)


def _write_words(folder: str, word_bits: int, rows: pd.DataFrame) -> pd.DataFrame:
    keys, counts = _merged(rows)
    ef = EliasFano.encode(keys, 1 << (64 - word_bits))
    data = pack_file({f"keys_{k}": a for k, a in ef.arrays().items()} | {"counts": _narrow(counts)}, {"keys": [ef.n, ef.low_bits]})
    return _file_row(1, rows, _write(folder, data), len(keys), int(counts.sum()))


def _write_level(folder: str, level: int, min_count: int, model, rows: pd.DataFrame) -> pd.DataFrame:
    keys, counts = _merged(rows)
    keep = counts >= min_count
    keys, counts = keys[keep], counts[keep]
    if not len(keys):
        return _file_row(level, rows, "", 0, 0)
    segment = int(rows["segment"].iloc[0])
    parent = (keys >> np.uint64(42)).astype(np.int64)
    child = keys & np.uint64((1 << 42) - 1)
    pointers = np.searchsorted(parent, np.arange(int(parent[-1]) + 2))
    # a child is coded relative to the last value of the node before: + 1 keeps the level increasing
    first = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1])))
    last = np.append(first[1:] - 1, len(child) - 1)
    base = np.concatenate(([0], np.cumsum(child[last] + np.uint64(1), dtype=np.uint64)[:-1])).astype(np.uint64)
    values = child + np.uint64(1) + np.repeat(base, last - first + 1)
    contexts = _context_counts(model.value, level - 1, segment * RANGE + parent[first])
    share = (counts - DISCOUNT) / np.repeat(contexts, last - first + 1)
    codes = _code(share, _Q_STEP, up=False)
    sums = np.add.reduceat(_Q_VALUES[codes], first)
    p, c = EliasFano.encode(pointers, len(keys) + 1), EliasFano.encode(values, int(values[-1]) + 1)
    data = pack_file({f"pointers_{k}": a for k, a in p.arrays().items()} | {f"children_{k}": a for k, a in c.arrays().items()}
                     | {"q": codes, "counts": _narrow(counts)}, {"pointers": [p.n, p.low_bits], "children": [c.n, c.low_bits]})
    return _file_row(level, rows, _write(folder, data), len(keys), 0, _planes(sums.astype("<f8")), _planes(parent[first].astype("<u4")))


def _level_writer(folder: str, level: int, min_count: int, model):
    return lambda rows: _write_level(folder, level, min_count, model, rows)


def _context_counts(model: Model, level: int, nodes: np.ndarray) -> np.ndarray:
    """Training counts of nodes, from the files of their level."""
    entries = sorted((base, key) for key, (base, _) in model.levels[level - 1].items())
    bases, out = np.array([b for b, _ in entries]), np.zeros(len(nodes), np.int64)
    which = np.searchsorted(bases, nodes, "right") - 1
    for k in np.unique(which):
        base, seg = model.segment(level, entries[k][1])
        own = which == k
        out[own] = seg.arrays["counts"][nodes[own] - base]
    return out


def _write_back(folder: str, rows: pd.DataFrame) -> pd.DataFrame:
    """Codes of what is left over, for the parents of one range."""
    total = np.zeros(RANGE)
    for sums, parents, n in zip(rows["sums"], rows["parents"], rows["parents_n"], strict=True):
        np.add.at(total, _unplanes(parents, "<u4", n), _unplanes(sums, "<f8", n))
    size = int(np.flatnonzero(total)[-1]) + 1 if total.any() else 0
    back = np.zeros(RANGE, np.uint8)
    back[:size] = _code(np.maximum(1 - total[:size], 1e-3), _BACK_STEP, up=True)
    return pd.DataFrame({"segment": [int(rows["segment"].iloc[0])], "path": [_write(folder, pack_file({"codes": back}, {}))]})


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def train(docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, text_col: str = "text") -> Model:
    """Build the trie of the documents' n-grams in a fresh shared folder."""
    spark = docs.sparkSession
    ship(spark)
    folder = scratch_path(spark, "lm-trie")
    fs, base = _open(folder)
    fs.create_dir(base, recursive=True)
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first().b
    bits = max(0, (max(1, size // WORD_SEGMENT_BYTES)).bit_length())
    model = Model(folder, bits, order=order)

    def level_files(blocks: DataFrame, writer, level: int):
        path = f"{folder}/manifest-{level}"
        blocks.groupBy("segment", "class").applyInPandas(writer, _FILES).write.parquet(path)
        files = spark.read.schema(_FILES).parquet(path)
        entries, at = {}, 0
        # one small row per file: about one per two million keys
        for r in files.filter("n > 0").select("segment", "class", "path", "n", "tokens").orderBy("segment", "class").collect():
            entries[r.segment, r["class"]] = (at, r.path)
            at += r.n
            model.tokens += r.tokens
        model.levels.append(entries)
        model.sizes.append(at)
        return files

    level_files(texts.mapInArrow(lambda batches: _count_words(bits, batches), _BLOCKS),
                lambda rows: _write_words(folder, bits, rows), 1)
    model.words = model.sizes[0]
    for level in range(2, order + 1):
        shared = spark.sparkContext.broadcast(model)   # names of files only
        files = level_files(
            texts.mapInArrow(_ngram_counter(shared, level, min_count), _BLOCKS), _level_writer(folder, level, min_count, shared), level)
        path = f"{folder}/back-{level - 1}"
        (files.filter("n > 0").select("segment", "sums", "parents", _plane_rows("parents").alias("parents_n"))
         .groupBy("segment").applyInPandas(lambda rows: _write_back(folder, rows), "segment int, path string").write.parquet(path))
        model.backs.append({r.segment: r.path for r in spark.read.schema("segment int, path string").parquet(path).collect()})
    return model


def _plane_rows(column: str) -> Column:
    @F.pandas_udf("long")
    def rows(data: pd.Series) -> pd.Series:
        return data.map(lambda x: len(zlib.decompress(x)) // 4).astype("int64")
    return rows(F.col(column))


def _score_piece(model: Model, piece: pa.RecordBatch) -> dict[str, np.ndarray]:
    tokens, first = tokens_of(piece)
    ids, counts = model.word_ids(tokens)
    unigram = (counts + 0.1) / (model.tokens + 0.1 * (model.words + 1))
    p, before = unigram, ids
    opens = np.zeros(len(ids), bool)
    opens[first[:-1]] = True
    for k, (node, code) in enumerate(_nodes(model, ids, first, model.order), start=2):
        context = np.concatenate(([-1], before[:-1]))
        context[opens] = -1
        known = context >= 0
        back = np.ones(len(ids))
        back[known] = model.back(k - 1, context[known])
        p = np.where(known, np.where(node >= 0, _Q_VALUES[code], 0.0) + back * p, p)
        before = node
    per = lambda x: np.add.reduceat(x, first[:-1]) if len(first) > 1 else x[:0]
    return {"n_tokens": np.diff(first), "n_known": per((counts > 0).astype(np.int64)),
            "base_score": per(np.log10(unigram)), "score": per(np.log10(p))}


def score(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    names = ["n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, limit=SLICE):
                got = _score_piece(shared.value, piece)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *(pa.array(got[n]) for n in names)], ["doc_id", *names])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return (rows.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
            .withColumn("train_tokens", F.lit(model.tokens).cast("long")))


def train_and_score(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """Train on the documents that are not held out, score all."""
    model = train(docs.filter(~held_out(F.col(f"`{id_col}`"))), text_col=text_col, **options)
    return score(docs, model, text_col, id_col).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
