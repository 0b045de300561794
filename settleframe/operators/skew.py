"""Equi-joins on a key of which a few values hold much of one side.

A sketch of one column finds the values that hold more than a share of the rows (a
mergeable summary of bounded size; at most as many values as the share allows). Their
rows are spread over salts, and the other side's rows of these values repeated once
per salt, so one value is many tasks. All other rows join as they are. Which values are
taken as hot never changes the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 64       # a value with more than a 64th of the rows is hot
SALTS = 64
TRACKED = 1024       # values the sketch follows
SALT = "__salt"


def hot_values(df: DataFrame, key: str) -> DataFrame:
    """Values (``key``, null among them) with more than 1 / ``HOT_SHARE`` of the rows, by
    upper estimate: at most ``HOT_SHARE`` rows or little more."""
    found = df.agg(F.expr(f"approx_top_k(`{key}`, {2 * HOT_SHARE}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n"))
    return (found.select("n", F.explode("top").alias("t")).filter(F.col("t.count") * HOT_SHARE > F.col("n"))
            .select(F.col("t.item").alias(key)))


def join_skewed(many: DataFrame, one: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``many.join(one, key, how)`` for a left, inner, semi or anti join, with the hot
    values of ``many`` spread."""
    hot = F.broadcast(hot_values(many.select(key), key).withColumnRenamed(key, "__hot"))
    spread = F.when(F.col("__hit").isNotNull(), F.pmod(F.xxhash64(*many.columns), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    mark = hot.withColumn("__hit", F.lit(True))
    left = many.join(mark, many[key].eqNullSafe(mark["__hot"]), "left").withColumn(SALT, spread).drop("__hot", "__hit")
    salts = F.when(F.col("__hit").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = one.join(mark, one[key].eqNullSafe(mark["__hot"]), "left").withColumn(SALT, F.explode(salts)).drop("__hot", "__hit")
    return left.join(right, [key, SALT], how).drop(SALT)
