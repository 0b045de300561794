"""Connected components of a link table by alternating large-star and small-star
steps, each a map-side combined minimum and an equi-join. Every step's edges are
written to the shared work folder, which also cuts the lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleframe.session import scratch_path


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"components-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema("u long, v long").parquet(path)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step. large: neighbours above a node move to its least neighbour;
    small: neighbours below it (and itself) do."""
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        moved = edges.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
    return moved.filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links``: (u, v), bigints without nulls. Returns (u, v) for every node
    that is not the least of its component, ``v`` being that least node."""
    edges = _stored(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    while True:
        edges = _stored(_star(_star(edges, large=True), large=False), "step")
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).first()
        if (now.n, now.x) == state or not now.n:
            return edges
        state = (now.n, now.x)
