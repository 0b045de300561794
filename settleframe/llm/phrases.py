"""Collocations: phrases of two to five words that occur together more often than
their parts suggest, counted per language.

A text in lower case is cut into pieces at punctuation and line ends, pieces into
words. A phrase's count is the number of its contiguous occurrences within pieces.
Counting follows the external layout of n-gram estimation: nothing is looked up, all
counts come from sorted streams that are read once, side by side.

1. Each position gives one window, the longest run of up to five words from there that
   can hold a frequent phrase. Tasks combine equal windows and store them: the count
   stream.
2. In prefix order (range-partitioned, sorted) all windows with the same first words
   lie together, so one pass adds up every phrase of every length. Phrases that reach
   over the edge of a range leave it as parts and are summed up by a small grouping.
3. Frequent phrases are read in prefix order, where the first words of a phrase are
   rows before it and its extensions to the right are rows behind it, and once more in
   suffix order (words reversed) for last words and extensions to the left. A range
   begins with a copy of the rows that its first phrase still needs, at most four.
4. The two passes meet phrase by phrase, and built-in decimals give the scores.

A window holds only pairs and triples that may be frequent: passes before add up their
occurrences in cells, a table whose size follows the corpus up to 2**27
cells. A cell below the threshold proves that everything in it is rare; a cell at
or above it proves nothing and only lets more windows travel. Results do not depend on
the table.

Defined results: null and empty texts have no words. A null language is ``und``, and so
is one with that name. Repeated rows count each. Very long texts are split alone, one
at a time. An empty table gives no phrases. Ids and extra columns play no part.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settleframe.llm.arrays import mix, run_positions, seeds, slices, text_buffer
from settleframe.llm.ranks import stored
from settleframe.llm.workers import ship

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
SIEVED = 3                 # longest phrases that the sieves cover, from two words on
CELL_BITS = (16, 27)       # least and greatest size of the table
SEGMENT_BITS = 16
HELD_CELLS = 3_000_000     # cells a task holds before it sends them
HELD_WINDOWS = 400_000     # windows a task holds before it combines them
SALTS = 16

# What separates pieces and words.
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(BREAKS)] = 2
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_VALUE = seeds(256, 31)
_VALUE[_KIND > 0] = 0
_STEP = np.uint64(0xD1342543DE82EF95)
_FACTORS = seeds(8, 37)
_HASHED = 1 << 20


@dataclass
class Pieces:
    """Words of some texts in reading order: their bytes are ``raw[start:end]`` (in
    lower case), ``left`` counts the words from one to the end of its piece."""
    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    left: np.ndarray
    first: np.ndarray      # of each text, one more entry than texts


def split_pieces(texts: pa.Array) -> Pieces:
    raw, offsets = text_buffer(texts)
    raw = np.append(_FOLD[raw], np.uint8(32))
    word = _KIND[raw[:-1]] == 0
    opens = word.copy()
    opens[1:] &= ~word[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    opens[begins] = word[begins]
    start = np.flatnonzero(opens)
    closes = word.copy()
    closes[:-1] &= ~word[1:]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    closes[last] = word[last]
    end = np.flatnonzero(closes) + 1
    first = np.searchsorted(start, offsets)
    # words of a piece share the number of breaks before them; a text begins a piece
    piece = np.cumsum(_KIND[raw] == 2)[start]
    opens_piece = np.ones(len(start), bool)
    opens_piece[1:] = piece[1:] != piece[:-1]
    opens_piece[first[:-1][first[:-1] < len(start)]] = True
    heads = np.flatnonzero(opens_piece)
    sizes = np.diff(np.append(heads, len(start)))
    left = np.repeat(heads + sizes, sizes) - np.arange(len(start))
    return Pieces(raw, start, end, _hash(raw, start, end), left, first)


def _hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words, for the cells alone."""
    out = np.empty(len(start), np.uint64)
    bounds = np.append(start, len(raw))
    k = 0
    while k < len(start):
        j = max(k + 1, int(np.searchsorted(bounds, bounds[k] + _HASHED, "right")) - 1)
        a, b = int(bounds[k]), int(bounds[j])
        own = start[k:j] - a
        gaps = np.diff(np.append(own, b - a))
        place = np.arange(b - a) - np.repeat(own, gaps)
        powers = np.multiply.accumulate(np.full(int(gaps.max()), _STEP, np.uint64))
        out[k:j] = np.add.reduceat(_VALUE[raw[a:b]] * powers[place], own)
        k = j
    return mix(out)


def _cells(words: Pieces, langs: list[str], length: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the phrases of a length within pieces, and their cells."""
    at = np.flatnonzero(words.left >= length)
    seed = np.array([zlib.crc32(x.encode()) for x in langs], np.uint64) * _FACTORS[7] + np.uint64(length)
    acc = np.repeat(seed, np.diff(words.first))[at]
    for j in range(length):
        acc += words.hashes[at + j] * _FACTORS[j]
    return at, (mix(acc) >> np.uint64(64 - bits)).astype(np.int64)


def _passes(words: Pieces, langs: list[str], sieves: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """For each length up to the longest sieved one: whether the phrase from a word
    may be frequent (single words always). All phrases within it may be, too."""
    out = [np.ones(len(words.start), bool)]
    for length, sieve in enumerate(sieves, start=2):
        at, cells = _cells(words, langs, length, bits)
        shorter = out[-1][at] & out[-1][at + 1]
        at, cells = at[shorter], cells[shorter]
        ok = np.zeros(len(words.start), bool)
        ok[at] = (sieve[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1
        out.append(ok)
    return out


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Pieces, list[str]]]:
    for batch in batches:
        for piece in slices(batch):
            yield split_pieces(piece.column("text")), piece.column("lang").to_pylist()


_CELLS = "segment int, part int, cells binary, counts binary"


def _pack_cells(segment: int, part: int, cells: np.ndarray, counts: np.ndarray) -> tuple[int, int, bytes, bytes]:
    return (segment, part, zlib.compress(np.diff(cells, prepend=cells[:1] * 0).astype(np.uint16).tobytes(), 1),
            zlib.compress(np.minimum(counts, 65535).astype(np.uint16).tobytes(), 1))


def _cell_counter(length: int, sieves: list[Broadcast], bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        part = TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            cells, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            segment = cells >> SEGMENT_BITS
            cuts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1], [True])))
            rows = [_pack_cells(int(segment[a]), part, cells[a:b] & ((1 << SEGMENT_BITS) - 1), counts[a:b])
                    for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                              ["segment", "part", "cells", "counts"])

        for words, langs in _split(batches):
            known = _passes(words, langs, [s.value for s in sieves], bits)
            at, cells = _cells(words, langs, length, bits)
            cells = cells[known[-1][at] & known[-1][at + 1]]
            if len(cells):
                held.append(cells)
            if sum(map(len, held)) > HELD_CELLS:
                yield flush()
        if held:
            yield flush()
    return run


def _segment_counts(rows: pd.DataFrame) -> np.ndarray:
    total = np.zeros(1 << SEGMENT_BITS, np.int64)
    for cells, counts in zip(rows["cells"], rows["counts"], strict=True):
        places = np.cumsum(np.frombuffer(zlib.decompress(cells), np.uint16), dtype=np.int64)
        total[places] += np.frombuffer(zlib.decompress(counts), np.uint16)
    return total


def _add_cells(rows: pd.DataFrame) -> pd.DataFrame:
    total = _segment_counts(rows)
    places = np.flatnonzero(total)
    row = _pack_cells(int(rows["segment"].iloc[0]), int(rows["part"].iloc[0]), places, total[places])
    return pd.DataFrame([row], columns=["segment", "part", "cells", "counts"])


def _sieve(slim: DataFrame, length: int, sieves: list[Broadcast], bits: int, min_count: int) -> np.ndarray:
    """One bit a cell: whether the phrases of a length that fall into it add up to
    the threshold. Cells are added in two steps, so no group is as long as there are
    tasks."""
    def full(rows: pd.DataFrame) -> pd.DataFrame:
        enough = np.packbits(_segment_counts(rows) >= min(min_count, 65535), bitorder="little")
        return pd.DataFrame({"segment": [int(rows["segment"].iloc[0])], "bits": [enough.tobytes()]})

    sent = slim.mapInArrow(_cell_counter(length, sieves, bits), _CELLS)
    fan = max(1, math.isqrt(slim.rdd.getNumPartitions()))
    half = sent.withColumn("part", F.col("part") % fan).groupBy("segment", "part").applyInPandas(_add_cells, _CELLS)
    table = np.zeros(1 << (bits - 3), np.uint8)
    for r in half.groupBy("segment").applyInPandas(full, "segment int, bits binary").toLocalIterator():   # 2**24 bytes at most
        at = r.segment << (SEGMENT_BITS - 3)
        table[at: at + len(r.bits)] = np.frombuffer(bytes(r.bits), np.uint8)
    return table


def _phrase_texts(words: Pieces, at: np.ndarray, length: np.ndarray) -> pa.Array:
    """Windows as text, a space behind each word."""
    own = run_positions(at, length)
    size = words.end[own] - words.start[own] + 1
    raw = words.raw[run_positions(words.start[own], size)]
    raw[np.cumsum(size) - 1] = 32
    heads = np.cumsum(length) - length
    offsets = np.append(0, np.cumsum(np.add.reduceat(size, heads)) if len(heads) else []).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(raw))


def _combined(parts: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(parts).group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
    return out.select(["lang", "phrase", "n_sum"]).rename_columns(["lang", "phrase", "n"])


_STREAM = "lang string, phrase string, n long"


def _windows(sieves: list[Broadcast], bits: int):
    """The count stream of some texts, and per language the number of words (of the
    empty phrase)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def send(table: pa.Table) -> Iterator[pa.RecordBatch]:
            yield from table.cast(pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])).to_batches(max_chunksize=20_000)

        for words, langs in _split(batches):
            passes = _passes(words, langs, [s.value for s in sieves], bits)
            length = passes[0].astype(np.int64)
            for ok in passes[1:]:
                length[ok] += 1
            # beyond the sieved lengths, as far as the longest ones follow each other
            run_, last = passes[-1], len(passes[-1]) - 1
            for step in range(1, LONGEST - len(passes) + 1):
                run_ = run_ & passes[-1][np.minimum(np.arange(last + 1) + step, max(last, 0))]
                length[run_ & (words.left >= len(passes) + step)] += 1
            at = np.flatnonzero(length)
            names = pa.array(langs, pa.large_string())
            of = np.repeat(np.arange(len(langs)), np.diff(words.first))[at]
            texts = pa.concat_arrays([_phrase_texts(words, at, length[at]), pa.array([""] * len(langs), pa.large_string())])
            counts = pa.array(np.append(np.ones(len(at), np.int64), np.diff(words.first)))
            held.append(_combined([pa.table({"lang": pa.concat_arrays([names.take(pa.array(of)), names]), "phrase": texts, "n": counts})]))
            if sum(t.num_rows for t in held) > HELD_WINDOWS:
                held = [_combined(held)]
                if held[0].num_rows > HELD_WINDOWS // 2:
                    yield from send(held.pop())
        if held:
            yield from send(_combined(held))
    return run


def _word_codes(phrases: pa.Array) -> np.ndarray:
    """Words of each phrase as numbers (equal within the batch for equal words), -1 behind the last."""
    split = pc.split_pattern(pc.utf8_rtrim(phrases, " "), " ")
    size = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    codes = split.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    out = np.full((len(size), LONGEST), -1, np.int64)
    out[np.repeat(np.arange(len(size)), size), run_positions(np.zeros(len(size), np.int64), size)] = codes
    return out


_COUNTS = "lang string, phrase string, a long, whole boolean"


def _add_up(min_count: int):
    """Counts of all phrases from a range of the count stream in prefix order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, str, int, bool]] = []
        before: tuple[str, str] | None = None      # row before, and what is open behind it
        open_sum, open_edge = [0] * (LONGEST + 1), [False] * (LONGEST + 1)

        def give() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                pa.string(), pa.string(), pa.int64(), pa.bool_()), strict=True)], ["lang", "phrase", "a", "whole"])
            rows.clear()
            return batch

        cut = lambda phrase, k: " ".join(phrase.split(" ", k)[:k]) + " "
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, phrase, n = (batch.column(c) for c in ("lang", "phrase", "n"))
            n = n.to_numpy()
            if before is not None:
                lang = pa.concat_arrays([pa.array([before[0]], lang.type), lang])
                phrase = pa.concat_arrays([pa.array([before[1]], phrase.type), phrase])
                n = np.append(0, n)
            codes = _word_codes(phrase)
            same = np.ones(len(n), bool)
            same[1:] = np.diff(lang.dictionary_encode().indices.to_numpy(zero_copy_only=False)) == 0
            same[0] = False
            for k in range(1, LONGEST + 1):
                held = codes[:, k - 1] >= 0
                same[1:] &= codes[1:, k - 1] == codes[:-1, k - 1]
                starts = np.flatnonzero(held & ~same)
                if not len(starts):
                    continue
                sums = np.add.reduceat(np.where(held, n, 0), starts)
                edge = np.zeros(len(starts), bool)
                if starts[0] == 0:
                    sums[0] += open_sum[k]
                    edge[0] = open_edge[k] or before is None
                open_sum[k], open_edge[k] = (int(sums[-1]), bool(edge[-1])) if held[-1] else (0, False)
                if held[-1]:
                    sums, edge, starts = sums[:-1], edge[:-1], starts[:-1]
                for i in np.flatnonzero(edge | (sums >= min_count)):
                    at = int(starts[i])
                    rows.append((lang[at].as_py(), cut(phrase[at].as_py(), k), int(sums[i]), not edge[i]))
            before = lang[-1].as_py(), phrase[-1].as_py()
            if len(rows) > 10_000:
                yield give()
        if before is not None:
            depth = before[1].count(" ")
            rows += [(before[0], cut(before[1], k), open_sum[k], False) for k in range(1, depth + 1)]
        if rows:
            yield give()
    return run


def _counted(windows: DataFrame, min_count: int) -> DataFrame:
    """All frequent phrases: lang, phrase (a space behind each word), a."""
    order = ["lang", "phrase"]
    sorted_ = windows.filter("phrase != ''").repartitionByRange(*order).sortWithinPartitions(*order)
    sums = stored(sorted_.mapInArrow(_add_up(min_count), _COUNTS), "phrases-sums")
    edges = sums.filter("not whole").groupBy("lang", "phrase").agg(F.sum("a").alias("a")).filter(F.col("a") >= min_count)
    return sums.filter("whole").select("lang", "phrase", "a").unionByName(edges)


_SIDE = "lang string, phrase string, a long, cuts array<long>, wider long"


def _lockstep(table: pa.Table) -> pa.Table:
    """A range in order: of each phrase the counts of its shorter beginnings, which are
    the last rows of their lengths before it, and the greatest count among its
    extensions by a word."""
    table = table.sort_by([("lang", "ascending"), ("key", "ascending")])
    a, depth, own = (table.column(c).to_numpy() for c in ("a", "depth", "own"))
    place, wider = np.arange(len(a)), np.zeros(len(a), np.int64)
    last = [np.maximum.accumulate(np.where(depth == k, place, -1)) for k in range(1, LONGEST)]
    sizes = depth - 1
    cuts = np.empty(int(sizes.sum()), np.int64)
    heads = np.cumsum(sizes) - sizes
    for k in range(1, LONGEST):
        longer = np.flatnonzero(depth > k)
        cuts[heads[longer] + k - 1] = a[last[k - 1][longer]]
        children = np.flatnonzero(depth == k + 1)
        np.maximum.at(wider, last[k - 1][children], a[children])
    lists = pa.ListArray.from_arrays(pa.array(np.append(heads, len(cuts)), pa.int32()), pa.array(cuts))
    none = pa.array(~own)   # copies at the head of a range bring only what they are extended to
    return pa.table({"lang": table.column("lang"), "phrase": table.column("phrase"),
                     "a": pc.if_else(none, pa.scalar(None, pa.int64()), table.column("a")),
                     "cuts": pc.if_else(none, pa.scalar(None, pa.list_(pa.int64())), lists), "wider": pa.array(wider)})


def _side(counted: DataFrame, suffix: bool, label: str) -> DataFrame:
    """The lockstep pass in prefix or suffix order."""
    words = F.split(F.rtrim("phrase"), " ")
    words = F.reverse(words) if suffix else words
    keyed = counted.select("lang", "phrase", "a", F.concat(F.array_join(words, " "), F.lit(" ")).alias("key"), F.size(words).alias("depth"))
    parts = stored(keyed.repartitionByRange("lang", "key").withColumn("part", F.spark_partition_id()), label)
    # The beginnings of each range's first phrase lie in ranges before: four rows at most for a range.
    first = parts.groupBy("part").agg(F.min(F.struct("lang", "key")).alias("f")).select("part", "f.*")
    heads = F.split(F.rtrim("key"), " ")
    needed = (first.withColumn("w", heads).filter(F.size("w") > 1)
              .select("part", "lang", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda k: F.concat(
                  F.array_join(F.slice("w", F.lit(1), k), " "), F.lit(" ")))).alias("key")))
    copies = needed.join(parts.drop("part"), ["lang", "key"]).withColumn("own", F.lit(False))
    whole = parts.withColumn("own", F.lit(True)).unionByName(copies)
    return whole.groupBy("part").applyInArrow(_lockstep, _SIDE)


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(phrases, words): the stored frequent phrases of one to five words (lang, phrase
    with a space behind each word, a) and the number of words of each language."""
    spark = docs.sparkSession
    ship(spark)
    slim = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    size = slim.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first().b
    bits = min(max((size // 16).bit_length(), CELL_BITS[0]), CELL_BITS[1])
    sieves: list[Broadcast] = []
    for length in range(2, SIEVED + 1):
        sieves.append(spark.sparkContext.broadcast(_sieve(slim, length, sieves, bits, min_count)))
    windows = stored(slim.mapInArrow(_windows(sieves, bits), _STREAM), "phrases-windows")
    counted = stored(_counted(windows, min_count), "phrases-counted")
    return counted, windows.filter("phrase = ''").groupBy("lang").agg(F.sum("n").alias("n"))


def mine(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, **columns) -> DataFrame:
    """Per language the first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    The cut that scores lowest counts (the earliest of equals); phrases that occur only
    inside one longer phrase are left out. It is enough to look one word to each side:
    what a longer phrase holds occurs at least as often, so with it an extension by one
    word occurs as often as the phrase itself."""
    counted, words = phrase_counts(docs, min_count, **columns)
    left = _side(counted, False, "phrases-prefix").withColumnRenamed("cuts", "lefts")
    right = _side(counted, True, "phrases-suffix").withColumnRenamed("cuts", "rights")
    both = (left.unionByName(right, allowMissingColumns=True).groupBy("lang", "phrase")
            .agg(*(F.max(c).alias(c) for c in ("a", "lefts", "rights", "wider")))
            .filter("size(lefts) > 0 and wider < a"))
    # 19 digits each: products are exact in 38.
    cut = F.expr("""array_min(transform(sequence(1, size(lefts)), k -> struct(
        (cast(1000 * a as decimal(19, 0)) * cast(n as decimal(19, 0)))
          div (cast(lefts[k - 1] as decimal(19, 0)) * cast(rights[size(lefts) - k] as decimal(19, 0))) as score,
        k, lefts[k - 1] as l, rights[size(lefts) - k] as r)))""")
    scored = both.join(words, "lang").select("lang", F.rtrim("phrase").alias("phrase"), "a", "n", cut.alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # In two steps, so that no language is one task.
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
