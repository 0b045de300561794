"""N-gram Jaccard join with several global token orders.

A document's set holds the 64-bit hashes of its distinct word shingles. Two sets
with Jaccard similarity of at least t share a token among the first
``n - ceil(t n) + 1`` tokens of each, under any global order of the tokens. Three
orders are used: each puts rare tokens first (by a bounded table of counts over
all documents) and breaks ties by another hash. The first order is the index;
a candidate pair must also share prefix tokens under the other two, which is
tested on short rows before the sets themselves are fetched and compared.

Large groups are never expanded into all pairs:

* equal sets are one node from the start (the class);
* in each index token's group every member is compared with one leader only, the
  links are contracted into components, and groups that have become one
  component, or all of whose pairs have been compared, are done;
* this is repeated with other leaders, some at a time, so that a large group whose
  members are just about similar grows together at a cost in proportion to it;
* what is left, members of a group in different components, is joined pair by pair with the size and
  position bounds in the join condition, each pair at the first token that both sets have rather
  than at every one. So no link that could join two components is lost; only pairs
  already connected are left out.

Rows that travel are (token, set id, size, position) for tokens that occur in at
least two sets (a Bloom filter drops the rest where they arise). Sets that share such
a token are described where they arise: by a sketch of ``SKETCH_BITS`` parities, by their
prefixes under the other orders, and by a signature of some bits for each token. The
bits in which two sketches or signatures differ are a lower bound of the sets'
difference, so most pairs fall by their sketches (in the remainder where they are made),
then by prefixes and signatures. Whole sets are not stored: those of the few
candidates left are made again from their texts.

Defined results: null, empty and blank texts have an empty set and link with
nothing: their component is their own id. Repeated rows are equal sets; null ids
are ignored for the smallest id of a component (null if all are). With fewer words than
a shingle the whole sequence is the one shingle. Extra columns pass through
``drop_near_duplicates``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from settleframe.llm.arrays import Words, mix, run_positions, seeds, slices, split_words
from settleframe.llm.bloom import FETCHES, BloomFilter, bit_positions
from settleframe.llm.components import components
from settleframe.llm.workers import ship
from settleframe.session import scratch_path

SHINGLE = 4
PERCENT = 85
ORDERS = 3
LEADERS = (1, 16)         # of a group, round by round, with which its members are compared
BEFORE = 8                # tokens in front of a token by which a pair is known to have met before
CELL_BITS = 22             # count table: 2**22 cells of one byte, whatever the corpus
SEGMENT = 1 << 16
SIGNATURE_BITS = 1 << 17   # longest signature of a set; those of larger sets still tell, less sharply
SKETCH_BITS = 512
_FACTORS = seeds(64, 11)


def shingle_sets(words: Words, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    counts, first, h = words.counts, words.first[:-1], words.hashes
    full = np.maximum(counts - k + 1, 0)
    at = run_positions(first, full)
    acc = np.zeros(len(at), np.uint64)
    for j in range(k):
        acc += h[at + j] * _FACTORS[j]
    acc = mix(acc)
    ends = np.cumsum(full)
    for i, n in enumerate(counts.tolist()):
        if n >= k:
            yield np.unique(acc[ends[i] - full[i]: ends[i]])
        elif n:
            own = h[first[i]: first[i] + n] * _FACTORS[:n]
            yield mix(own.sum(dtype=np.uint64, keepdims=True) + _FACTORS[k + n])
        else:
            yield np.zeros(0, np.uint64)


def set_ids(tokens: np.ndarray, seed: int) -> tuple[int, int]:
    """Two independent 64-bit hashes of a set."""
    a, b = seeds(2, 100 + seed)
    n = np.uint64(len(tokens))
    one = mix(mix(tokens ^ a).sum(dtype=np.uint64, keepdims=True) + n)
    two = mix(mix(tokens ^ b).sum(dtype=np.uint64, keepdims=True) + n)
    return int(one.view(np.int64)[0]), int(two.view(np.int64)[0])


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1


def order_keys(tokens: np.ndarray, levels: np.ndarray, order: int) -> np.ndarray:
    """Sort keys of a global order: rare first, then by the order's own hash."""
    level = levels[(tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)].astype(np.uint64)
    return (level << np.uint64(56)) | (mix(tokens ^ _FACTORS[32 + order]) >> np.uint64(8))


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[tuple[int | None, int], np.ndarray]]:
    for batch in batches:
        for piece in slices(batch):
            yield from zip(zip(piece.column("doc_id").to_pylist(), piece.column("th").to_pylist(), strict=True),
                           shingle_sets(split_words(piece.column("text")), k), strict=True)


_SKETCH = "kind int, doc_id long, th long, n long, sid long, check long, part int, segment int, counts binary"


def _sketcher(k: int, seed: int):
    names = ["kind", "doc_id", "th", "n", "sid", "check", "part", "segment", "counts"]
    kinds = [pa.int32(), *[pa.int64()] * 5, pa.int32(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, known, rows = np.zeros(1 << CELL_BITS, np.uint32), set(), []
        pack = lambda r: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*r, strict=True), kinds, strict=True)], names)
        for (doc_id, th), tokens in _sets(batches, k):
            sid = check = None
            if len(tokens):
                sid, check = set_ids(tokens, seed)
                if sid not in known:  # copies of a set count once in a task
                    known.add(sid)
                    np.add.at(counts, (tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64), 1)
            rows.append((0, doc_id, th, len(tokens), sid, check, None, None, None))
            if len(rows) == 8192:
                yield pack(rows)
                rows = []
        part = TaskContext.get().partitionId()
        for s in range(len(counts) // SEGMENT):
            own = counts[s * SEGMENT:(s + 1) * SEGMENT]
            if own.any():
                rows.append((1, None, None, None, None, None, part, s, zlib.compress(np.minimum(own, 65535).astype(np.uint16).tobytes(), 1)))
        if rows:
            yield pack(rows)
    return run


def _sum_counts(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(SEGMENT, np.uint32)
    for c in rows["counts"]:
        total += np.frombuffer(zlib.decompress(c), np.uint16)
    return pd.DataFrame({"part": [int(rows["part"].iloc[0])], "segment": [int(rows["segment"].iloc[0])],
                         "counts": [zlib.compress(np.minimum(total, 65535).astype(np.uint16).tobytes(), 1)]})


def _levels(sketch: DataFrame) -> np.ndarray:
    """Merged counts as one byte a cell, eight steps per doubling. Any table
    gives valid orders; a good one puts common tokens last."""
    schema = "part int, segment int, counts binary"
    rows = sketch.filter("kind = 1").select("part", "segment", "counts")
    fan = max(1, math.isqrt(max(1, sketch.rdd.getNumPartitions())))  # as many tasks in a group as groups
    half = rows.withColumn("part", F.col("part") % fan).groupBy("segment", "part").applyInPandas(_sum_counts, schema)
    merged = half.groupBy("segment").applyInPandas(_sum_counts, schema)
    levels = np.zeros(1 << CELL_BITS, np.uint8)
    for r in merged.coalesce(FETCHES).toLocalIterator():  # 2**22 cells at most; a job per partition
        counts = np.frombuffer(zlib.decompress(bytes(r.counts)), np.uint16)
        levels[r.segment * SEGMENT:(r.segment + 1) * SEGMENT] = np.round(8 * np.log2(1.0 + counts))
    return levels


def _first(tokens: np.ndarray, levels: np.ndarray, order: int, p: int) -> np.ndarray:
    """Places of the first ``p`` tokens under an order, in that order."""
    keys = order_keys(tokens, levels, order)
    first = np.sort(np.argpartition(keys, p - 1)[:p]) if p < len(tokens) else np.arange(len(tokens))
    return first[np.argsort(keys[first], kind="stable")]


def _member(values: np.ndarray, bits: int, bitmap: np.ndarray) -> np.ndarray:
    where = bit_positions(values, bits)
    return ((bitmap[(where >> np.uint64(3)).astype(np.int64)] >> (where & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1).astype(bool)


def _distinct_sets(batches: Iterator[pa.RecordBatch], k: int, seed: int) -> Iterator[tuple[int, np.ndarray]]:
    """(set id, tokens) of the non-empty sets of a task, copies once."""
    known = set()
    for _, tokens in _sets(batches, k):
        if len(tokens) and (sid := set_ids(tokens, seed)[0]) not in known:
            known.add(sid)
            yield sid, tokens


def signature(tokens: np.ndarray) -> np.ndarray:
    """One bit per bucket of tokens, four to eight buckets a token. Where two
    signatures differ, a token of one set is not in the other, so their differing bits
    never exceed the sets' difference."""
    size = min(max(1 << (4 * len(tokens) - 1).bit_length(), 64), SIGNATURE_BITS)
    bits = np.zeros(size, np.uint8)
    bits[(mix(tokens ^ _FACTORS[63]) & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<i8")


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """Whether an odd number of tokens falls in each of ``SKETCH_BITS`` buckets. A token of
    one of two sets changes one bit, so the bits in which their sketches differ never
    exceed the sets' difference."""
    held = np.bincount((mix(tokens ^ _FACTORS[62]) & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((held & 1).astype(np.uint8), bitorder="little").view("<i8")


_INDEX = "kind int, token long, sid long, n int, at int, filters array<array<int>>, signature array<long>, sketch array<long>"


def _indexer(k: int, seed: int, percent: int, levels: Broadcast, orders: int = 0, bits: int = 0, wanted: Broadcast | None = None):
    """Rows of kind 0: (token, sid, n, at) of the first order's prefixes, with a
    filter only tokens that may be in it. With ``orders``, a row of kind 1 for each
    set that has such a token: (sid, n, 32-bit prefixes under the other orders,
    signature, sketch)."""
    names, short, long = ["kind", "token", "sid", "n", "at", "filters", "signature", "sketch"], pa.list_(pa.list_(pa.int32())), pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, out, rows, held = levels.value, [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if out:
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                n = len(columns[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), *map(pa.array, columns), pa.nulls(n, short),
                                                  pa.nulls(n, long), pa.nulls(n, long)], names)
            if rows:
                sid, n, filters, signatures, sketches = zip(*rows, strict=True)
                none = pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(rows), np.int32)), none[0], pa.array(sid, pa.int64()),
                                                  pa.array(n, pa.int32()), none[1], pa.array(filters, short),
                                                  pa.array(signatures, long), pa.array(sketches, long)], names)
            out.clear()
            rows.clear()

        for sid, tokens in _distinct_sets(batches, k, seed):
            p = prefix_length(len(tokens), percent)
            prefix, at = tokens[_first(tokens, table, 0, p)], np.arange(p, dtype=np.int32)
            if wanted is not None:
                hit = _member(prefix, bits, wanted.value)
                prefix, at = prefix[hit], at[hit]
            if not len(prefix):
                continue
            out.append((prefix.view(np.int64), np.full(len(prefix), sid, np.int64), np.full(len(prefix), len(tokens), np.int32), at))
            if orders:
                rows.append((sid, len(tokens), [np.sort((tokens[_first(tokens, table, o, p)] >> np.uint64(8)).astype(np.uint32).view(np.int32))
                                                for o in range(1, orders)], signature(tokens), parity_sketch(tokens)))
                held += len(tokens) // 8
            held += p * max(1, orders)
            if held > 200_000:
                yield from flush()
                held = 0
        yield from flush()
    return run


def _stored(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    path = scratch_path(df.sparkSession, f"jaccard-{label}")
    schema = df.schema
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _enough(overlap: Column, nx: Column, ny: Column, percent: int) -> Column:
    """100 * intersection >= percent * union."""
    return overlap * (100 + percent) >= (nx + ny) * percent


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


@dataclass
class JaccardJoin:
    """Result tables: ``documents`` (doc_id, th: hash of the text, n, sid: set
    id), ``labels`` (u, v): set id to its component's least set id, for sets
    linked to another."""
    documents: DataFrame
    labels: DataFrame

    def component_ids(self) -> DataFrame:
        """(sid, component, first, rows): the component of each set, its first
        row (smallest id, nulls last, then text hash) and its number of rows;
        map-side combined."""
        row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
        least = self.documents.filter("sid is not null").groupBy("sid").agg(F.min(row).alias("least"), F.count(F.lit(1)).alias("c"))
        named = (least.join(self.labels, least["sid"] == self.labels["u"], "left")
                 .select("sid", F.coalesce("v", "sid").alias("component"), "least", "c"))
        ids = named.groupBy("component").agg(F.min("least").alias("first"), F.sum("c").alias("rows"))
        return named.join(ids, "component").select("sid", "component", "first", "rows")


def _side(df: DataFrame, c: str) -> DataFrame:
    return df.select(F.col("sid").alias(c), *(F.col(f).alias(f"{c}_{f}") for f in df.columns if f != "sid"))


def _unlike(a: str, b: str) -> Column:
    """In how many bits two sketches differ."""
    return sum((F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))) for i in range(1, SKETCH_BITS // 64)),
               F.bit_count(F.col(f"{a}.s0").bitwiseXOR(F.col(f"{b}.s0"))))


def _within(differ: Column, nx: Column, ny: Column, percent: int) -> Column:
    """May sets of these sizes that differ in so many tokens or more be linked?"""
    return differ * (100 + percent) <= (nx + ny) * (100 - percent)


def _candidates(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) that can reach the threshold by their sizes and sketches."""
    return (pairs.join(_side(sketches, "y"), "y").join(_side(sketches, "x"), "x")
            .filter(_enough(F.least("x_n", "y_n"), F.col("x_n"), F.col("y_n"), percent))
            .filter(_within(_unlike("x_sketch", "y_sketch"), F.col("x_n"), F.col("y_n"), percent)).select("x", "y"))


def _of(found: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of the sets in stored pairs (and a few others): a Bloom filter
    keeps the rest from being shuffled."""
    ids = found.select("x").unionAll(found.select("y")).toDF("sid")
    bloom = BloomFilter.build(ids, "sid", 2 * found.count())
    return rows.filter(F.col("sid").isNotNull() & bloom.member(F.coalesce("sid", F.lit(0))))   # a null would make the column inexact


def _near(found: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs that share prefix tokens under every other order, where
    ``signatures`` has the ``filters``, and whose signatures do not differ in more bits
    than the difference of two linked sets of their sizes allows."""
    def folded(a: str, b: str) -> Column:
        """The signature ``a``, as long as ``b`` or shorter: sizes of sets that can be
        linked, and so their signatures, are at most a doubling apart."""
        half = (F.size(a) / 2).cast("int")
        return F.when(F.size(a) > F.size(b), F.zip_with(F.slice(a, F.lit(1), half), F.slice(a, half + 1, half), lambda x, y: x.bitwiseOR(y))).otherwise(F.col(a))

    differ = F.aggregate(F.zip_with(folded("x_signature", "y_signature"), folded("y_signature", "x_signature"), lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda acc, c: acc + c)
    met = F.forall(F.arrays_zip(F.col("x_filters").alias("a"), F.col("y_filters").alias("b")),
                   lambda z: F.arrays_overlap(z["a"], z["b"])) if "filters" in signatures.columns else F.lit(True)
    return (found.join(_side(signatures, "y"), "y").join(_side(signatures, "x"), "x")
            .filter(met & _within(differ, F.col("x_n"), F.col("y_n"), percent)).select("x", "y"))


def _set_maker(k: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def pack() -> pa.RecordBatch:
            sid, tokens = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(sid, pa.int64()), pa.array(map(len, tokens), pa.int32()),
                                               pa.array(tokens, pa.list_(pa.int64()))], ["sid", "n", "tokens"])

        for sid, tokens in _distinct_sets(batches, k, seed):
            rows.append((sid, tokens.view(np.int64)))
            held += len(tokens)
            if held > 200_000:
                yield pack()
                rows, held = [], 0
        if rows:
            yield pack()
    return run


def _sets_of(found: DataFrame, documents: DataFrame, slim: DataFrame, k: int, seed: int) -> DataFrame:
    """(sid, n, tokens) of the sets in stored pairs, made again from one text of each; a
    Bloom filter of those rows keeps all other texts from being split."""
    row = F.xxhash64("doc_id", "th")
    wanted = _stored(_of(found, documents).groupBy("sid").agg(F.min(row).alias("row")).select("row"), "wanted")
    bloom = BloomFilter.build(wanted, "row", wanted.count())
    made = slim.filter(bloom.member(row)).mapInArrow(_set_maker(k, seed), "sid long, n int, tokens array<long>")
    return made.groupBy("sid").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))   # equal for equal ids


def _verified(found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among candidate pairs, by the sets themselves."""
    return (found.join(_side(sets, "y"), "y").join(_side(sets, "x"), "x")
            .filter(_enough(F.size(F.array_intersect("x_tokens", "y_tokens")), F.col("x_n"), F.col("y_n"), percent))
            .select(F.col("x").alias("u"), F.col("y").alias("v")))


def _preceded(rows: DataFrame) -> DataFrame:
    """With ``before``: the ``BEFORE`` tokens in front of each in its set's prefix. Two
    rows of a token that share one of them have met at that token already, so their
    pair need not be made again; at the first token that both sets have it always is."""
    along = Window.partitionBy("sid").orderBy("at").rowsBetween(-BEFORE, -1)
    return rows.withColumn("before", F.collect_list("token").over(along))


def _apart(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of rows of a token in different components that can reach the
    threshold by their sizes, places and (where ``rows`` has them) sketches, from the
    first token that both sets have (and others only where neither has one of the other's
    last ``BEFORE`` tokens)."""
    a, b = rows.alias("a"), rows.alias("b")
    alike = _within(_unlike("a.sketch", "b.sketch"), F.col("a.n"), F.col("b.n"), percent) if "sketch" in rows.columns else F.lit(True)
    bound = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    return (a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.sid") < F.col("b.sid"))
                   & (F.col("a.component") != F.col("b.component"))
                   & _enough(bound, F.col("a.n"), F.col("b.n"), percent) & alike
                   & ~F.arrays_overlap("a.before", "b.before"))
            .select(F.col("a.sid").alias("x"), F.col("b.sid").alias("y")))


def jaccard_join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, orders: int = ORDERS,
                 leaders: tuple[int, ...] = LEADERS, text_col: str = "text", id_col: str = "doc_id", seed: int = 0) -> JaccardJoin:
    """Sets, links and components of the documents."""
    spark: SparkSession = docs.sparkSession
    ship(spark)
    text = F.col(f"`{text_col}`")
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), _text_hash(text).alias("th"), text.alias("text"))

    # Sets and counts; another seed if two different sets should share an id.
    while True:
        sketch = _stored(slim.mapInArrow(_sketcher(shingle, seed), _SKETCH), "sketch")
        documents = sketch.filter("kind = 0").select("doc_id", "th", "n", "sid", "check")
        clash = (documents.filter("sid is not null").groupBy("sid")
                 .agg(F.min("check").alias("a"), F.max("check").alias("b"), F.min("n").alias("c"), F.max("n").alias("d"))
                 .filter("a != b or c != d"))
        if clash.isEmpty():
            break
        seed += 1
    documents = documents.drop("check")
    levels = spark.sparkContext.broadcast(_levels(sketch))

    # Tokens of the first order's prefixes that two sets have.
    shared = (slim.mapInArrow(_indexer(shingle, seed, percent, levels), _INDEX)
              .groupBy("token").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).filter("lo != hi").select("token"))
    shared = _stored(shared, "shared")
    bloom = BloomFilter.build(shared, "token", shared.count())
    both = _stored(slim.mapInArrow(_indexer(shingle, seed, percent, levels, orders, bloom.bits, bloom.seen), _INDEX), "both", ["kind"])
    index = (both.filter("kind = 0").select("token", "sid", "n", "at")
             .join(shared, "token", "left_semi").distinct())
    index = _stored(index, "index")
    described = both.filter("kind = 1")
    once = lambda rows, *c: rows.groupBy("sid").agg(*(F.first(x).alias(x) for x in ("n", *c)))  # noqa: E731  equal for equal ids
    parts = F.struct(*(F.col("sketch")[i].alias(f"s{i}") for i in range(SKETCH_BITS // 64))).alias("sketch")
    sketches = _stored(once(described.select("sid", "n", parts), "sketch"), "sketches")

    labels = spark.createDataFrame([], "u long, v long")
    links = None
    for r in range(len(leaders) + 1):
        # Groups still in several components.
        state = index.join(labels, index["sid"] == labels["u"], "left").select(
            "token", "sid", "n", "at", F.coalesce("v", "sid").alias("component"))
        several = leaders[r] if r < len(leaders) else 1
        part = F.pmod(F.xxhash64(F.lit(r), F.lit("part"), "sid"), F.lit(several))
        leader = F.min(F.struct(F.xxhash64(F.lit(r), "sid").alias("h"), "sid", "component", "n"))
        open_groups = (state.groupBy("token", part.alias("part")).agg(F.min("component").alias("lo"), F.max("component").alias("hi"), leader.alias("lead"), F.count(F.lit(1)).alias("rows"))
                       .groupBy("token").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.collect_list("lead").alias("leads"), F.sum("rows").alias("rows"))
                       .filter("lo != hi").select("token", "leads", "rows"))
        open_groups = _stored(open_groups, "open")
        if open_groups.isEmpty():
            break
        if r < len(leaders):
            pairs = (state.join(open_groups, "token").withColumn("lead", F.explode("leads"))
                     .filter((F.col("component") != F.col("lead.component")) & _enough(F.least("n", "lead.n"), F.col("n"), F.col("lead.n"), percent))
                     .select(F.least("sid", "lead.sid").alias("x"), F.greatest("sid", "lead.sid").alias("y")))
        else:
            rest = _preceded(state.join(open_groups.select("token"), "token", "left_semi"))
            rest = _stored(rest.join(sketches.drop("n"), "sid"), "rest")
            pairs = _apart(rest, percent)
        found = _stored(_candidates(pairs.distinct(), sketches, percent), "candidates")
        found = _stored(_near(found, once(_of(found, described), "filters", "signature"), percent), "near")
        new = _stored(_verified(found, _sets_of(found, documents, slim, shingle, seed), percent), "links")
        links = new if links is None else links.unionByName(new)
        labels = components(links)
        if r < len(leaders):   # with at most one member that leads nothing, all pairs of a group have been compared
            index = _stored(index.join(open_groups.filter(F.col("rows") - F.size("leads") > 1).select("token"), "token", "left_semi"), "index")
    return JaccardJoin(documents, labels)


def document_components(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    join = jaccard_join(docs, **options)
    ids = join.component_ids().select("sid", F.col("first.doc_id").alias("component_id"))
    return (join.documents.join(ids, "sid", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def drop_near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """One document of each component, with the input's columns: the one with the
    smallest id, then text hash (of rows equal in both, one by a hash of the
    row). Documents with an empty set all stay.

    A Bloom filter over the ids in components of several rows lets all other
    documents through without a shuffle.
    """
    join = jaccard_join(docs, text_col=text_col, id_col=id_col, **options)
    several = join.component_ids().filter("rows > 1").select("sid", "first")
    key = lambda c: [F.coalesce(c, F.lit(0)).alias("k"), c.isNull().alias("none")]
    members = _stored(join.documents.join(several, "sid").select(
        *key(F.col("doc_id")), "th", (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))).alias("wins")
    ).distinct(), "members")
    bloom = BloomFilter.build(members.select(F.xxhash64("k").alias("h")), "h", members.count())
    row, id_ = F.struct(*(F.col(f"`{c}`") for c in docs.columns)), F.col(f"`{id_col}`").cast("long")
    tested = docs.select(row.alias("row"), *key(id_), F.col(f"`{text_col}`").alias("t"),
                         bloom.member(F.xxhash64(F.coalesce(id_, F.lit(0)))).alias("maybe"))
    through = tested.filter(~F.col("maybe")).select("row.*")
    exact = (tested.filter("maybe").withColumn("th", _text_hash(F.col("t"))).drop("t", "maybe")
             .join(members, ["k", "none", "th"], "left").filter("wins is null or wins"))
    first = Window.partitionBy("k", "none", "th").orderBy(F.xxhash64("row"))
    one = exact.withColumn("nth", F.row_number().over(first)).filter("nth = 1 or wins is null").select("row.*")
    return through.unionByName(one)
