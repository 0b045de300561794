"""Places of rows in an order within groups, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settleframe.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared work folder and read back under its schema."""
    path, schema = scratch_path(df.sparkSession, label), df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def positions(df: DataFrame, group: str, order: list[Column], label: str) -> DataFrame:
    """Adds ``rank`` (from 0) and ``total`` (rows of the group) under ``order``
    within ``group``; equal rows take any of their places.

    ``df`` is a stored table, as it is read twice: range partitioning samples it.
    The rows are range-partitioned by group and order, with a last key that splits
    equal rows; a place is the number of rows in the parts before (one row per part
    and group) and the number within the part. A group with most rows is many
    parts.
    """
    keyed = df.withColumn("__tie", F.monotonically_increasing_id())
    parts = stored(keyed.repartitionByRange(F.col(group), *order, F.col("__tie"))
                   .withColumn("__part", F.spark_partition_id()), label)
    counts = parts.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(group)
    before = F.sum("n").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(group, "__part", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("n").over(whole).alias("total"))
    within = F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order, "__tie"))
    return (parts.join(starts, [group, "__part"])
            .withColumn("rank", F.col("__before") + within - 1).drop("__part", "__before", "__tie"))
