"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in
DataFrame functions only.

Every shard has ``VIRTUAL`` points on a ring of 64-bit hashes; the arc that ends
at a point belongs to its shard, and a document falls on an arc by the hash of its
id. The load bound of a shard is its exact share of the rows (``rows`` law:
counts differ by at most one). Walking the ring clockwise, an arc hands its
shard as many of its own rows as fit, then rows that overflowed before; what
does not fit goes on to the next arc, a first-in-first-out queue, until every
row is placed in the second lap at the latest. With equal bounds most rows stay on
their home arc, so adding a shard moves little more than the new share.

Only counts per arc are gathered (shards x virtual points, independent of the
data), folded in one expression. Documents are then numbered inside their arc by a
window partitioned by arc and look their place up in the arc's list of segments.

Defined results: null ids hash like a value of their own; null text has size 1
(0 bytes plus 1) and CRC 0. Equal texts and repeated rows are rows like any
other: identical rows are numbered in any order, the set of result rows does not
depend on it. An empty table gives no rows. Extra columns are not carried.
"""

from __future__ import annotations

import bisect
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settleframe.session import scratch_path

SHARDS = 16
VIRTUAL = 64
SEED = 7


def ring(spark, shards: int = SHARDS, virtual: int = VIRTUAL) -> DataFrame:
    """(arc, shard, point): the virtual nodes in clockwise order."""
    points = (spark.range(shards * virtual)
              .select((F.col("id") / virtual).cast("int").alias("shard"),
                      F.xxhash64(F.lit(SEED), F.lit("node"), "id").alias("point")))
    return points.select((F.row_number().over(Window.orderBy("point", "shard")) - 1).cast("int").alias("arc"), "shard", "point")


def arc_of(h: Column, points: list[int]) -> Column:
    """The first arc whose point is not below ``h``, clockwise (past the last
    point comes the first). The top 12 bits of ``h`` give the first candidate,
    the few points that share them are compared."""
    bucket = [(p >> 52) + 2048 for p in points]
    first = [bisect.bisect_left(bucket, b) for b in range(4096)]
    most = max(Counter(bucket).values())
    table = F.array(*(F.lit(p) for p in points + [2**63 - 1] * most))
    begin = F.element_at(F.array(*(F.lit(x) for x in first)), (F.shiftright(h, 52) + 2049).cast("int"))
    below = sum(((F.element_at(table, begin + 1 + j) < h).cast("int") for j in range(most)), F.lit(0))
    return F.pmod(begin + below, F.lit(len(points))).cast("int")


def pour(counts: DataFrame, shards: int) -> DataFrame:
    """(arc, shard, n) for every arc to (arc, from, to, shard, slot): rows of the
    arc numbered from..to-1 go to ``shard`` at slots slot, slot+1, ...

    One fold over the arcs, two laps. State: rows placed per shard, the queue's
    head and tail (rows that overflowed are numbered in the order they left
    their arc), and the events: ``own`` (rows kept at home), ``push`` and ``pop``.
    """
    arcs = counts.agg(F.sort_array(F.collect_list(F.struct("arc", "shard", "n"))).alias("a"),  # one entry per arc
                      F.sum("n").alias("total"))
    # exact shares: the first (total mod shards) shards take one row more
    share = F.floor(F.col("total") / shards).cast("long")
    bound = lambda s: share + (s < F.col("total") % shards).cast("long")
    event = "array<struct<arc:int,kind:string,shard:int,slot:bigint,at:bigint,n:bigint>>"
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("used"), F.lit(0).cast("long").alias("head"),
                     F.lit(0).cast("long").alias("tail"), F.expr(f"cast(array() as {event})").alias("events"))

    def make(arc: Column, kind: str, shard: Column, slot: Column, at: Column, n: Column) -> Column:
        return F.struct(arc.cast("int").alias("arc"), F.lit(kind).alias("kind"), shard.cast("int").alias("shard"),
                        slot.cast("long").alias("slot"), at.cast("long").alias("at"), n.cast("long").alias("n"))

    def let(value: Column, body) -> Column:
        return F.element_at(F.transform(F.array(value), body), 1)

    def step(state: Column, x: Column) -> Column:
        used = F.element_at(state["used"], x["shard"] + 1)
        free = bound(x["shard"]) - used
        return let(F.struct(F.least(free, x["n"]).alias("own"), free.alias("free"), used.alias("used")), lambda o: let(
            F.least(o["free"] - o["own"], state["tail"] - state["head"]), lambda pop: F.struct(
                F.transform(state["used"], lambda u, i: F.when(i == x["shard"], u + o["own"] + pop).otherwise(u)).alias("used"),
                (state["head"] + pop).alias("head"), (state["tail"] + x["n"] - o["own"]).alias("tail"),
                F.concat(state["events"], F.filter(F.array(
                    make(x["arc"], "own", x["shard"], o["used"], F.lit(0), o["own"]),
                    make(x["arc"], "pop", x["shard"], o["used"] + o["own"], state["head"], pop),
                    make(x["arc"], "push", x["shard"], o["own"], state["tail"], x["n"] - o["own"])),
                    lambda e: e["n"] > 0)).alias("events"))))

    laps = F.concat("a", F.transform("a", lambda x: F.struct(x["arc"].alias("arc"), x["shard"].alias("shard"), F.lit(0).cast("long").alias("n"))))
    events = arcs.filter("total > 0").select(F.aggregate(laps, start, step)["events"].alias("events"))
    own = (events.select(F.explode(F.filter("events", lambda e: e["kind"] == "own")).alias("e"))
           .select("e.arc", F.lit(0).cast("long").alias("from"), F.col("e.n").alias("to"), "e.shard", "e.slot"))
    # A pushed range meets the popped ranges it overlaps: both lists are in one
    # row, follow the ring and have at most two entries an arc.
    met = (events.select(F.explode(F.filter("events", lambda e: e["kind"] == "push")).alias("p"),
                         F.filter("events", lambda e: e["kind"] == "pop").alias("pops"))
           .select("p", F.explode(F.filter("pops", lambda q: (q["at"] < F.col("p.at") + F.col("p.n")) & (q["at"] + q["n"] > F.col("p.at")))).alias("q"))
           .withColumn("lo", F.greatest("p.at", "q.at"))
           .withColumn("hi", F.least(F.col("p.at") + F.col("p.n"), F.col("q.at") + F.col("q.n")))
           .select("p.arc", (F.col("p.slot") + F.col("lo") - F.col("p.at")).alias("from"), (F.col("p.slot") + F.col("hi") - F.col("p.at")).alias("to"),
                   "q.shard", (F.col("q.slot") + F.col("lo") - F.col("q.at")).alias("slot")))
    return own.unionByName(met)


def assign(docs: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard,
    home_shard (where the ring alone would put it)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    nodes = ring(spark, shards, virtual)
    points = [r.point for r in nodes.orderBy("arc").collect()]  # shards x virtual numbers
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32")).withColumn("h", F.xxhash64(F.lit(SEED), "doc_id"))
    path = scratch_path(spark, "shard-slim")
    slim.withColumn("arc", arc_of(F.col("h"), points)).write.parquet(path)
    slim = spark.read.parquet(path)
    owners = nodes.select("arc", F.col("shard").alias("home_shard"))
    counts = (owners.join(slim.groupBy("arc").agg(F.count(F.lit(1)).alias("n")), "arc", "left")
              .select("arc", F.col("home_shard").alias("shard"), F.coalesce("n", F.lit(0)).cast("long").alias("n")))
    segments = pour(counts, shards).groupBy("arc").agg(F.sort_array(F.collect_list(F.struct("from", "to", "shard", "slot"))).alias("segments"))
    lookup = owners.join(segments, "arc", "left")
    order = Window.partitionBy("arc").orderBy("h", "doc_id", "size", "text_crc32")
    numbered = slim.withColumn("rank", F.row_number().over(order).cast("long") - 1)
    # The lookup has one row per arc: shards x virtual rows, whatever the data.
    placed = (numbered.join(F.broadcast(lookup), "arc")
              .withColumn("seg", F.element_at(F.filter("segments", lambda s: (s["from"] <= F.col("rank")) & (F.col("rank") < s["to"])), 1)))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("seg.shard").alias("shard"),
                         (F.col("seg.slot") + F.col("rank") - F.col("seg.from")).alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), "home_shard")
