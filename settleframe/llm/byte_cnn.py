"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it.
Learned filters (a table of weights per tap and byte value, which is a
convolution over one-hot bytes) run over every position of a chunk and are
max-pooled; mean, least and greatest of the pooled values over a document's
chunks go through one hidden layer to one probability.

Training: the driver fits the network (Adam, logistic loss) on a bounded sample
of labelled documents, ``TRAIN_ROWS`` at most, half per label as far as there
are enough, each of at most ``TRAIN_BYTES`` bytes, chosen by a hash of the id.
The network sees bytes only. Both labels weigh the same in the loss, and the
output bias is shifted afterwards to the share of labels among all training rows.
Scoring runs on Spark over every whole text, in bounded memory: chunks are pooled
a few hundred at a time.

Defined results: null text counts as empty; an empty text is one chunk of zero
bytes and has a score like any other. Labels that are null or contradict each
other for an id are not used; without any label of one kind every score is the
share of label 1 (0.5 without labels). Repeated rows are scored each. Extra
columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settleframe.llm.arrays import slices, text_buffer
from settleframe.llm.workers import ship

CHUNK = 256
OVERLAP = 32
TAPS = 5
FILTERS = 24
HIDDEN = 16
TRAIN_ROWS = 3000
TRAIN_BYTES = 1 << 16
STEPS = 900        # whatever the number of rows
BATCH = 32
SEED = 5
_POOL = 128        # chunks convolved at once


def chunk_starts(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, start) of every chunk: as many as it takes to reach the end."""
    counts = np.maximum(1, -(-(lengths - OVERLAP) // (CHUNK - OVERLAP)))
    text = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    return text, nth * (CHUNK - OVERLAP)


def chunk_bytes(raw: np.ndarray, offsets: np.ndarray, text: np.ndarray, start: np.ndarray) -> np.ndarray:
    """(chunks, CHUNK) bytes, zero behind a text's end."""
    at = (offsets[text] + start)[:, None] + np.arange(CHUNK)
    inside = at < offsets[text + 1][:, None]
    if not len(raw):
        return np.zeros(at.shape, np.uint8)
    return np.where(inside, raw[np.minimum(at, len(raw) - 1)], np.uint8(0))


@dataclass
class Network:
    taps: np.ndarray      # (TAPS, 256, FILTERS)
    bias: np.ndarray      # (FILTERS,)
    w1: np.ndarray        # (3 * FILTERS, HIDDEN)
    b1: np.ndarray
    w2: np.ndarray        # (HIDDEN,)
    b2: np.ndarray        # (1,)
    constant: float | None = None   # the score of every text, where nothing could be learned

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        f = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return cls(f(TAPS, 256, FILTERS, scale=0.3), np.zeros(FILTERS, np.float32), f(3 * FILTERS, HIDDEN, scale=0.15),
                   np.zeros(HIDDEN, np.float32), f(HIDDEN, scale=0.25), np.zeros(1, np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.taps, self.bias, self.w1, self.b1, self.w2, self.b2]

    def pool(self, chunks: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Max-pooled filter outputs of chunks (ReLU), and where the maxima are."""
        span = CHUNK - TAPS + 1
        out = np.empty((len(chunks), FILTERS), np.float32)
        place = np.empty((len(chunks), FILTERS), np.int32) if where else None
        for a in range(0, len(chunks), _POOL):
            own = chunks[a:a + _POOL]
            acc = self.taps[0].take(own[:, :span], axis=0)
            for t in range(1, TAPS):
                acc += self.taps[t].take(own[:, t:t + span], axis=0)
            if where:
                best = acc.argmax(axis=1)
                place[a:a + _POOL] = best
                out[a:a + _POOL] = np.take_along_axis(acc, best[:, None], axis=1)[:, 0]
            else:
                out[a:a + _POOL] = acc.max(axis=1)
        return np.maximum(out + self.bias, 0), place

    def head(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(v @ self.w1 + self.b1)
        return hidden, hidden @ self.w2 + self.b2[0]


def combine(pooled: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: mean, least and greatest of its chunks' pooled values."""
    counts = np.diff(np.append(first, len(pooled)))[:, None]
    return np.concatenate([np.add.reduceat(pooled, first, axis=0) / counts, np.minimum.reduceat(pooled, first, axis=0),
                           np.maximum.reduceat(pooled, first, axis=0)], axis=1)


def probabilities(net: Network, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Scores of the texts in a buffer; chunk values are pooled a part at a time."""
    n = len(offsets) - 1
    if net.constant is not None:
        return np.full(n, net.constant)
    text, start = chunk_starts(np.diff(offsets))
    pooled = np.concatenate([net.pool(chunk_bytes(raw, offsets, text[a:a + 2048], start[a:a + 2048]))[0]
                             for a in range(0, len(text), 2048)])
    logit = net.head(combine(pooled, np.searchsorted(text, np.arange(n))))[1].astype(np.float64)
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def train(texts: list[bytes], labels: np.ndarray, share: float, steps: int = STEPS, seed: int = SEED) -> Network:
    """Fit on whole texts; ``share`` is that of label 1 among all training rows.
    Both labels weigh the same in the loss."""
    rng = np.random.default_rng(seed)
    net = Network.fresh(rng)
    if not len(labels) or labels.min() == labels.max():
        net.constant = share
        return net
    params = net.parameters()
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    weight = np.where(labels > 0.5, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())).astype(np.float32)
    step = 0
    while step < steps:
        order = rng.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            rows = order[a:a + BATCH]
            offsets = np.concatenate(([0], np.cumsum([len(texts[i]) for i in rows])))
            raw = np.frombuffer(b"".join(texts[i] for i in rows), np.uint8)
            text, start = chunk_starts(np.diff(offsets))
            chunks = chunk_bytes(raw, offsets, text, start)
            pooled, place = net.pool(chunks, where=True)
            first = np.searchsorted(text, np.arange(len(rows)))
            vec = combine(pooled, first)
            hidden, logit = net.head(vec)
            d = ((1 / (1 + np.exp(-logit)) - labels[rows]) * weight[rows] / len(rows)).astype(np.float32)
            dh = d[:, None] * net.w2 * (1 - hidden ** 2)
            dv = dh @ net.w1.T
            mean, low, high = np.split(dv, 3, axis=1)
            counts = np.diff(np.append(first, len(pooled)))
            dz = (mean / counts[:, None])[text]
            for part, g in ((vec[:, FILTERS:2 * FILTERS], low), (vec[:, 2 * FILTERS:], high)):
                hit = pooled == part[text]
                dz = dz + hit * g[text] / np.maximum(np.add.reduceat(hit, first, axis=0, dtype=np.float32), 1)[text]
            dz = np.where(pooled > 0, dz, 0).astype(np.float32)
            c, f = np.nonzero(dz)
            taps = np.stack([np.bincount(chunks[c, place[c, f] + t].astype(np.int64) * FILTERS + f, dz[c, f], 256 * FILTERS)
                             .reshape(256, FILTERS) for t in range(TAPS)])
            grads = [taps, dz.sum(axis=0), vec.T @ dh, dh.sum(axis=0), hidden.T @ d, d.sum(keepdims=True)]
            step += 1
            rate = 0.01 * max(0.1, 1 - step / steps)
            for p, g, mm, vv in zip(params, grads, m, v, strict=True):
                mm += 0.1 * (g - mm)
                vv += 0.001 * (g * g - vv)
                p -= (rate * (mm / (1 - 0.9 ** step) / (np.sqrt(vv / (1 - 0.999 ** step)) + 1e-8))).astype(np.float32)
    net.b2 += np.float32(np.log(share / (1 - share)))
    return net


def held_out(id_: Column) -> Column:
    return F.crc32(id_.cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, max_bytes: int = TRAIN_BYTES,
        text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality") -> Network:
    """Network from the labelled documents that are not held out."""
    spark = docs.sparkSession
    own = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("y"))
           .filter("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("z"))
           .filter((F.col("y") == F.col("z")) & ~held_out(F.col("id"))).select("id", "y"))
    known = {r.y: r.n for r in own.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = known.get(1, 0) / sum(known.values()) if known else 0.5
    # More ids than wanted, because some texts are too long or missing; still bounded.
    pick = own.filter("y = 0").orderBy(F.xxhash64("id")).limit(rows).unionByName(
        own.filter("y = 1").orderBy(F.xxhash64("id")).limit(rows))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    found = (docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).filter(F.octet_length("text") <= max_bytes)
             .join(F.broadcast(pick), "id").dropDuplicates(["id"]))
    sample = (found.filter("y = 0").orderBy(F.xxhash64("id")).limit(rows // 2)
              .unionByName(found.filter("y = 1").orderBy(F.xxhash64("id")).limit(rows // 2))).toPandas()
    sample = sample.sort_values("id", kind="stable")
    ship(spark)
    return train([t.encode() for t in sample["text"]], sample["y"].to_numpy(np.float32), share)


def score(docs: DataFrame, net: Network, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(net)  # some hundred KB, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, limit=1 << 19):
                p = probabilities(shared.value, *text_buffer(piece.column("text")))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(p, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return (rows.mapInArrow(run, "doc_id long, score double")
            .select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))
