"""Distributed rank and top-k against a brute-force rank."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from settleframe.operators.ranking import global_rank, top_ranked


def _brute_rank(values, descending=True):
    def better(a, b):
        if a is None:
            return False
        if b is None:
            return True
        return a > b if descending else a < b
    return [1 + sum(1 for o in values if better(o, v)) for v in values]


def test_rank_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 1.0), ("c", 1.0), ("d", None)], "k string, v double")
    got = {r.k: r.rank for r in global_rank(df, "v").collect()}
    assert got == {"a": 1, "b": 2, "c": 2, "d": 4}


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("descending", [True, False])
def test_global_rank_matches_brute_force(spark, seed, descending):
    rnd = random.Random(seed)
    values = [rnd.choice([None, float(rnd.randint(0, 40))]) if rnd.random() < 0.1 else float(rnd.randint(0, 40))
              for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double")
    got = {r.id: r.rank for r in global_rank(df, "v", descending=descending, partitions=5).collect()}
    expected = _brute_rank(values, descending)
    assert [got[i] for i in range(len(values))] == expected


def test_global_rank_equals_window_rank(spark):
    df = spark.range(2000).select(F.col("id"), ((F.col("id") * 7919) % 113).cast("double").alias("v"))
    mine = global_rank(df, "v", "r")
    ref = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    assert sorted(mine.select("id", "r").collect()) == sorted(ref.select("id", "r").collect())


@pytest.mark.parametrize("n", [1, 2, 3, 10])
def test_top_ranked_keeps_ties(spark, n):
    values = [9.0, 7.0, 7.0, 7.0, 3.0, None, 3.0, 1.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double")
    ranks = _brute_rank(values)
    expected = sorted((i, r) for i, r in enumerate(ranks) if r <= n)
    got = sorted((r.id, r.rank) for r in top_ranked(df, "v", n).collect())
    assert got == expected


def test_global_rank_hot_value(spark):
    """A third of the rows share one value (and nulls are many): ranks stay exact."""
    df = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(50.0))
         .when(F.col("id") % 10 == 1, F.lit(None).cast("double"))
         .otherwise((F.col("id") % 97).cast("double")).alias("v"))
    values = {r.id: r.v for r in df.collect()}
    ordered = [values[i] for i in range(3000)]
    expected = _brute_rank(ordered)
    got = {r.id: r.rank for r in global_rank(df, "v").collect()}
    assert [got[i] for i in range(3000)] == expected


def test_global_rank_keeps_value_order_across_partitions(spark):
    df = spark.range(5000).select("id", (F.col("id") * 37 % 1009).cast("double").alias("v"))
    ranked = global_rank(df, "v", partitions=7).collect()
    by_value = {}
    for r in ranked:
        by_value.setdefault(r.v, set()).add(r.rank)
    assert all(len(ranks) == 1 for ranks in by_value.values())
    ordered = sorted(by_value, reverse=True)
    assert [min(by_value[v]) for v in ordered] == sorted(min(by_value[v]) for v in ordered)


@pytest.mark.parametrize("descending", [True, False])
def test_global_rank_non_numeric_keys(spark, descending):
    """String keys take the range-partition path; same ranks as brute force."""
    rnd = random.Random(7)
    values = [rnd.choice([None, "a", "b", "bb", "c", "zz", "m" * rnd.randint(1, 3)]) for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v string")
    got = {r.id: r.rank for r in global_rank(df, "v", descending=descending, partitions=4).collect()}
    assert [got[i] for i in range(len(values))] == _brute_rank(values, descending)


def test_global_rank_nan_and_decimal_keys(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0, nan), (1, 3.0), (2, nan), (3, None), (4, -1.0)], "id long, v double")
    assert {r.id: r.rank for r in global_rank(df, "v").collect()} == {0: 1, 2: 1, 1: 3, 4: 4, 3: 5}
    dec = spark.range(100).select("id", (F.col("id") % 17).cast("decimal(10,2)").alias("v"))
    ref = dec.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    mine = global_rank(dec, "v", "r", partitions=5)
    assert sorted(mine.select("id", "r").collect()) == sorted(ref.select("id", "r").collect())


def test_every_size_takes_the_distributed_plan(spark):
    for n in (1, 400):
        plan = global_rank(spark.range(n).withColumnRenamed("id", "v"), "v")._jdf.queryExecution().optimizedPlan().toString()
        assert "__part" in plan
    empty = spark.createDataFrame([], "id long, v double")
    assert global_rank(empty, "v").count() == 0 and top_ranked(empty, "v", 3).count() == 0


def test_global_rank_without_materializing(spark, tmp_path):
    path = str(tmp_path / "stored")
    spark.range(3000).select("id", (F.col("id") * 13 % 101).cast("double").alias("v")).write.parquet(path)
    stored = spark.read.parquet(path)
    a = global_rank(stored, "v", materialize=False)
    b = stored.withColumn("rank", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    assert sorted(a.select("id", "rank").collect()) == sorted(b.select("id", "rank").collect())
