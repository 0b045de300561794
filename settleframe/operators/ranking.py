"""Ranking over a whole table.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one task.
``global_rank`` computes the same ``rank()`` (ties share a rank, gaps follow,
nulls last) without that funnel:

1. collapse equal values: ``groupBy(value).count()`` (map-side combine, so a
   value shared by a third of the rows becomes one row);
2. range-partition the distinct values and checkpoint them, which fixes each
   value's partition id;
3. rows before each partition: a running sum over one row per partition
   (bounded by the partition count, so broadcasting it is safe);
4. within a partition (one range part per task): running sum of the counts
   of better values;
5. join ranks back to the rows on the value (null-safe). AQE turns this into
   a broadcast only when the runtime size allows it, and splits a hot value's
   partition with its skew-join handling.

``top_ranked`` is the top-k report. It needs none of this: a heap per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settleframe.session import work_dir


def _order(col: str, descending: bool) -> Column:
    return F.col(col).desc_nulls_last() if descending else F.col(col).asc_nulls_last()


def global_rank(df: DataFrame, order_col: str, rank_col: str = "rank", descending: bool = True,
                partitions: int | None = None, materialize: bool = True) -> DataFrame:
    """``rank() OVER (ORDER BY order_col [DESC] NULLS LAST)``.

    The input is read more than once, so by default it is checkpointed to
    ``spark.checkpoint.dir`` (right for computed inputs such as a per-entity
    summary); pass ``materialize=False`` for a stored table that is cheaper
    to re-read than to copy. No task holds more than its range part.
    """
    work_dir(df.sparkSession)
    key, n, part = "__key", "__n", "__part"
    order = _order(key, descending)

    base = df.checkpoint(eager=True) if materialize else df
    distinct_values = base.groupBy(F.col(order_col).alias(key)).agg(F.count(F.lit(1)).alias(n))
    # Without an explicit count AQE may merge adjacent range partitions, which
    # keeps partition ids in value order; the checkpoint pins them.
    ranged = (distinct_values.repartitionByRange(partitions, order) if partitions
              else distinct_values.repartitionByRange(order))
    values = ranged.withColumn(part, F.spark_partition_id()).checkpoint(eager=True)
    before_part = (values.groupBy(part).agg(F.sum(n).alias("__cnt"))
                   .withColumn("__before", F.coalesce(
                       F.sum("__cnt").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0)))
                   .select(part, "__before"))
    better_in_part = Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # One range part per task: every checkpoint partition holds a single part
    # id, so a range exchange on the id maps parts one-to-one onto tasks (a
    # hash exchange could put several parts in one task). It also satisfies
    # the window's clustering, so no second exchange is planned.
    by_part = values.repartitionByRange(values.rdd.getNumPartitions(), part)
    ranks = (by_part.join(F.broadcast(before_part), part)
             .select(key, (F.lit(1) + F.col("__before") + F.coalesce(F.sum(n).over(better_in_part), F.lit(0)))
                     .cast("int").alias(rank_col)))
    return base.join(ranks, base[order_col].eqNullSafe(ranks[key])).drop(key)


def top_ranked(df: DataFrame, order_col: str, n: int, rank_col: str = "rank", descending: bool = True) -> DataFrame:
    """Rows whose ``rank()`` is at most ``n``; ties at the boundary are kept.

    Every task keeps its best ``n`` values on a heap, the best of those are at most ``n``
    rows, and their ranks among themselves are those among all, as every better row is
    one of them. Joining them back on the value (a broadcast of ``n`` rows) keeps
    all ties, however many. Nothing is ranked or sorted as a whole."""
    if n < 1:
        raise ValueError("n must be >= 1")
    order = _order("__key", descending)
    best = df.select(F.col(order_col).alias("__key")).orderBy(order).limit(n)
    ranks = best.select("__key", F.rank().over(Window.orderBy(order)).alias(rank_col)).distinct()
    return df.join(F.broadcast(ranks), df[order_col].eqNullSafe(ranks["__key"])).drop("__key")
