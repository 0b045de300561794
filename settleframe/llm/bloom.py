"""Two-bit Bloom filter built by Spark tasks: which 64-bit hashes may occur more
than once, and plain membership of a set of hashes.

The filter is cut into segments of ``SEGMENT_BITS`` bits; all bits of a hash lie
in one segment. Every bit has two states kept as two bitmaps: *seen* and *seen
again*. A task fills its own bitmaps, emits the segments it touched, and two
grouped steps merge them (a bit seen by two tasks is seen again). A hash that
occurs twice has all its bits in *seen again*, so nothing repeated is missed;
the reverse can be a false alarm.

Size: 16 bits a row, rounded up to a power of two, at most ``max_bits``
(2**29 bits, 64 MB, a bound that does not depend on the data). Past
that the share of false alarms rises and more slim rows take the exact path;
the results stay the same.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from settleframe.llm.arrays import mix
from settleframe.llm.workers import ship

SEGMENT_BITS = 1 << 16
HASHES = 4
MAX_BITS = 1 << 29
FETCHES = 8               # jobs in which merged segments reach the driver, each an eighth of them
_SCHEMA = "segment int, part int, seen binary, again binary"


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    return min(max_bits, max(SEGMENT_BITS, 1 << max(0, math.ceil(math.log2(max(1, 16 * rows))))))


def bit_positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """(rows, HASHES) positions; those of one hash share a segment."""
    h = mix(hashes.astype(np.uint64))
    base = (h % np.uint64(bits // SEGMENT_BITS)) * np.uint64(SEGMENT_BITS)
    g = mix(h + np.uint64(0x9E3779B97F4A7C15))
    return np.stack([base + ((g >> np.uint64(16 * k)) & np.uint64(SEGMENT_BITS - 1)) for k in range(HASHES)], axis=1)


def _fill(bits: int, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            at, times = np.unique(bit_positions(h, bits), return_counts=True)
            byte, mask = (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)
            twice = (times > 1) | ((seen[byte] & mask) != 0)
            np.bitwise_or.at(again, byte[twice], mask[twice])
            np.bitwise_or.at(seen, byte, mask)
        size = SEGMENT_BITS // 8
        part = TaskContext.get().partitionId()
        for k in range(0, bits // SEGMENT_BITS, 256):
            own = [s for s in range(k, min(k + 256, bits // SEGMENT_BITS)) if seen[s * size:(s + 1) * size].any()]
            if own:
                cut = lambda x, s: zlib.compress(x[s * size:(s + 1) * size].tobytes(), 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), pa.array([part] * len(own), pa.int32()),
                     pa.array([cut(seen, s) for s in own], pa.binary()), pa.array([cut(again, s) for s in own], pa.binary())],
                    ["segment", "part", "seen", "again"])
    return run


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    seen, again = (np.zeros(SEGMENT_BITS // 8, np.uint8) for _ in range(2))
    for a, b in zip(rows["seen"], rows["again"], strict=True):
        x, y = np.frombuffer(zlib.decompress(a), np.uint8), np.frombuffer(zlib.decompress(b), np.uint8)
        again |= y | (seen & x)
        seen |= x
    return pd.DataFrame({"segment": [int(rows["segment"].iloc[0])], "part": [int(rows["part"].iloc[0])],
                         "seen": [zlib.compress(seen.tobytes(), 1)], "again": [zlib.compress(again.tobytes(), 1)]})


class BloomFilter:
    """Bitmaps of a column of 64-bit hashes; ``repeated`` and ``member`` give the
    test as a column. Only the hash column crosses to Python."""

    def __init__(self, spark: SparkSession, bits: int, seen: np.ndarray, again: np.ndarray):
        self.bits = bits
        self.seen, self.again = spark.sparkContext.broadcast(seen), spark.sparkContext.broadcast(again)

    @classmethod
    def build(cls, hashes: DataFrame, column: str, rows: int, max_bits: int = MAX_BITS) -> BloomFilter:
        """``hashes``: one bigint column without nulls; ``rows``: its row count."""
        spark, bits = hashes.sparkSession, filter_bits(rows, max_bits)
        ship(spark)
        parts = hashes.select(column).mapInArrow(_fill(bits, column), _SCHEMA)
        # Two merge steps of about the square root of the number of tasks each:
        # no group holds more than that many bitmaps of one segment.
        fan = max(1, math.isqrt(max(1, hashes.rdd.getNumPartitions())))
        half = (parts.withColumn("part", F.col("part") % F.lit(fan))
                .groupBy("segment", "part").applyInPandas(_merge, _SCHEMA))
        merged = half.groupBy("segment").applyInPandas(_merge, _SCHEMA)
        seen, again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        size = SEGMENT_BITS // 8
        # at most bits / 8 bytes, bounded above; a job per partition, each an entry in the driver's memory
        for r in merged.select("segment", "seen", "again").coalesce(FETCHES).toLocalIterator():
            at = slice(r.segment * size, (r.segment + 1) * size)
            seen[at] = np.frombuffer(zlib.decompress(bytes(r.seen)), np.uint8)
            again[at] = np.frombuffer(zlib.decompress(bytes(r.again)), np.uint8)
        return cls(spark, bits, seen, again)

    def _test(self, shared, column: Column) -> Column:
        bits = self.bits

        @F.pandas_udf(BooleanType())
        def test(h: pd.Series) -> pd.Series:
            if not len(h):
                return pd.Series([], dtype=bool)
            at = bit_positions(h.to_numpy(np.int64).view(np.uint64), bits)
            mask = np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)
            return pd.Series(((shared.value[(at >> np.uint64(3)).astype(np.int64)] & mask) != 0).all(axis=1))

        return test(column)

    def repeated(self, column: Column) -> Column:
        """May the hash occur more than once? Never false for one that does."""
        return self._test(self.again, column)

    def member(self, column: Column) -> Column:
        """May the hash be among those added? Never false for one that is."""
        return self._test(self.seen, column)
