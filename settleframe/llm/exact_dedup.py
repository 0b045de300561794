"""Exact deduplication with two Bloom passes.

Texts are equal when identical after deleting every character of
``[\\x20\\x09-\\x0D]``. The first pass writes a slim table (id, code points,
SHA-256 of the normalised text) and fills a two-bit Bloom filter with its
hashes; the second tests every row. Rows whose hash cannot repeat pass straight
through; only the others are shuffled, and only as slim rows. Winners are a
map-side combined maximum per hash, so a class that holds a third of all rows
sends one row per task; the join that hands the winner back is an equi-join AQE
can split.

Defined results: null text counts as empty. The row with the most code points
in the original text stays, then the smallest doc_id (a null id last). Of
repeated rows (same id and text) exactly one is kept. An empty table gives an
empty result. ``deduplicate`` returns exactly the input's columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settleframe.llm.bloom import MAX_BITS, BloomFilter
from settleframe.session import scratch_path

NORMALIZE = r"[\x20\x09-\x0D]+"


def text_digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), NORMALIZE, "").cast("binary"), 256)


def _text_points(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit(""))).cast("long")


def decide(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", max_filter_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, points (code points), text_sha256, keep_id,
    group_size, kept, shuffled (whether the row took the exact path)."""
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`")
    path = scratch_path(spark, "exact-dedup-slim")
    (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), _text_points(text).alias("points"),
                 text_digest(text).alias("text_sha256"))
     .withColumn("h", F.xxhash64("text_sha256")).write.parquet(path))
    slim = spark.read.parquet(path)
    bloom = BloomFilter.build(slim.select("h"), "h", slim.count(), max_filter_bits)
    flagged_path = scratch_path(spark, "exact-dedup-flagged")
    slim.withColumn("shuffled", bloom.repeated(F.col("h"))).drop("h").write.partitionBy("shuffled").parquet(flagged_path)
    flagged = spark.read.schema("doc_id long, points long, text_sha256 string, shuffled boolean").parquet(flagged_path)

    single = (flagged.filter(~F.col("shuffled"))
              .select("doc_id", "points", "text_sha256", F.col("doc_id").alias("keep_id"),
                      F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "shuffled"))
    maybe = flagged.filter("shuffled")
    winners = (maybe.groupBy("text_sha256")
               .agg(F.max(F.struct("points", F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("rank"))).alias("w"),
                    F.count(F.lit(1)).alias("group_size"))
               .select("text_sha256", (-F.col("w.rank")).alias("keep_id"), F.col("w.points").alias("keep_points"), "group_size"))
    # Stored, so that both sides of the join below are plain exchanges.
    winners_path = scratch_path(spark, "exact-dedup-winners")
    winners.write.parquet(winners_path)
    winners = spark.read.schema("text_sha256 string, keep_id long, keep_points long, group_size long").parquet(winners_path)
    # Repeated rows (same id and text) are numbered on their own key, before the
    # join, so that the join stays free of grouping above it and can be split.
    again = Window.partitionBy("text_sha256", "doc_id", "points").orderBy("points")
    numbered = maybe.withColumn("nth", F.row_number().over(again))
    joined = numbered.join(winners, "text_sha256").select(
        "doc_id", "points", "text_sha256", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points")) & (F.col("nth") == 1)).alias("kept"),
        "shuffled")
    return single.unionByName(joined)


def deduplicate(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", max_filter_bits: int = MAX_BITS) -> DataFrame:
    """The documents that stay, with the input's columns.

    A second Bloom filter, over the ids of the dropped rows, lets every other
    document through without a shuffle or a hash of its text; the few that may
    have a dropped row are matched exactly on (id, code points, digest).
    """
    spark, cols = docs.sparkSession, docs.columns
    path = scratch_path(spark, "exact-dedup-decided")
    decide(docs, text_col, id_col, max_filter_bits).write.parquet(path)
    decided = spark.read.parquet(path)
    key = lambda c: F.xxhash64(F.coalesce(c.cast("long"), F.lit(-1)))
    dropped = decided.filter(~F.col("kept")).select(key(F.col("doc_id")).alias("h"))
    bloom = BloomFilter.build(dropped, "h", dropped.count(), max_filter_bits)
    row, text = F.struct(*(F.col(f"`{c}`") for c in cols)), F.col(f"`{text_col}`")
    tested = docs.select(row.alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("t"),
                         bloom.member(key(F.col(f"`{id_col}`"))).alias("maybe"))
    through = tested.filter(~F.col("maybe")).select("row.*")
    # null ids take a value of their own beside the flag, so the keys are plain equalities
    exact = (tested.filter("maybe")
             .select("row", F.coalesce("id", F.lit(0)).alias("k"), F.col("id").isNull().alias("none"),
                     _text_points(F.col("t")).alias("p"), text_digest(F.col("t")).alias("s")))
    stay = (decided.filter("kept").select(F.coalesce("doc_id", F.lit(0)).alias("k"), F.col("doc_id").isNull().alias("none"),
                                          F.col("points").alias("p"), F.col("text_sha256").alias("s")))
    order = Window.partitionBy("k", "none", "p", "s").orderBy(F.xxhash64("row"))
    one = (exact.withColumn("nth", F.row_number().over(order)).filter("nth = 1").drop("nth")
           .join(stay, ["k", "none", "p", "s"], "left_semi").select("row.*"))
    return through.unionByName(one)
