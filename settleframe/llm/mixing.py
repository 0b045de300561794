"""Mixing sources to target weights with a multivariate-hypergeometric splitting
tree, in DataFrame functions only.

1. Targets. Sources ordered by code point (null last) weigh 1, 2, 3, 1, ...; they
   share all words by weight, a target stops at ``MAX_REPEAT`` times its source's
   size and the excess is shared again. Ordered by cap over weight, the capped
   sources are a prefix, so one running sum over the sources finds the level.
2. Blocks. A document belongs to a block of its source by a hash; a source has a
   block per ``BLOCK_WORDS`` words, at most ``MAX_BLOCKS``. A target is whole
   passes over the source plus, of one more pass in a permuted block order, the
   first blocks that fit; the block in which the target ends is filled with
   whole documents: in hash order as far as they fit, then smaller ones, so that
   what is missing is less than any document left.
3. Splitting tree. Each source's number of drawn blocks is its quota. A node
   holds quotas of all sources; its left half draws its share from the
   multivariate hypergeometric distribution (inverse transform of the exact
   probabilities, uniform numbers from hashes), the right half gets the rest,
   until one node is left per output shard.
4. Disjoint permuted blocks. A source's draws are numbered in permuted order;
   each shard takes its quota's range of numbers. Rows are then ordered by a
   hash inside their shard.

What is gathered in one place is per source or per block, never per document,
but for the documents of one boundary block per source. Everything depends on
hashes of the data only, so reruns agree.

Defined results: null text has size 0, null source is a source of its own.
Repeated rows (equal id, source and size) are one unit: they are taken together.
Documents of size 0 are taken 0 words; ``mix`` keeps them as often as their
block is drawn whole. An empty table gives an empty result. Extra columns pass
through; names starting with ``_mix_`` are reserved and refused.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settleframe.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
BLOCK_WORDS = 1 << 16
MAX_BLOCKS = 1 << 12
SHARDS = 16
SEED = 20240613


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Per source: idx, source, source_size, units (documents), weight, target.

    ``sizes`` has (source, size, copies). The windows run over one row per
    source, after a map-side combined sum.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.sum("copies").alias("units"))
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("idx") % len(weights) + 1).cast("int"))
    per = (per.withColumn("idx", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
           .withColumn("weight", weight)
           .withColumn("cap", F.col("source_size") * max_repeat))
    before = Window.orderBy(F.col("cap") / F.col("weight"), "idx").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    return (per.withColumn("level", level).withColumn("level", F.max("level").over(everything))
            .withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
            .select("idx", "source", "source_size", "units", "weight", "target"))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """A hypergeometric number for uniform ``u``: how many of ``drawn`` items out
    of ``total`` are among the ``marked``. Inverse transform over the support
    cut at eight standard deviations (beyond it less than 1e-14 of the mass),
    probabilities by their exact ratio from one value to the next."""
    n, k, m = (c.cast("double") for c in (total, marked, drawn))
    mean = F.when(n > 0, m * k / n).otherwise(0.0)
    spread = F.ceil(F.sqrt(F.when(n > 1, F.greatest(mean * (1 - k / n) * (n - m) / (n - 1), F.lit(0.0))).otherwise(0.0)) * 8) + 2
    low = F.greatest(F.lit(0).cast("long"), drawn - (total - marked), F.floor(mean).cast("long") - spread.cast("long"))
    high = F.least(marked, drawn, F.ceil(mean).cast("long") + spread.cast("long"))

    def step(w: Column, x: Column) -> Column:  # from the weight of x - 1 to that of x
        x = x.cast("double")
        return w * (k - x + 1) * (m - x + 1) / (x * (n - k - m + x))

    def pick(b: Column) -> Column:
        values = F.sequence(b["low"] + 1, b["high"])
        mass = F.aggregate(values, F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("s")),
                           lambda a, x: _let(step(a["w"], x), lambda w: F.struct(w.alias("w"), (a["s"] + w).alias("s"))))["s"]
        found = _let(mass * u, lambda goal: F.aggregate(
            values, F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("s"), b["low"].alias("x")),
            lambda a, x: F.when(a["s"] >= goal, a).otherwise(_let(step(a["w"], x), lambda w: F.struct(
                w.alias("w"), (a["s"] + w).alias("s"), x.alias("x")))))["x"])
        return F.when(b["low"] >= b["high"], b["low"]).otherwise(found)

    return _let(F.struct(low.alias("low"), high.alias("high")), pick)


def _uniform(*parts: Column) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def splitting_tree(quotas: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(idx, quota) per source to (idx, shard, from, to): the range of the
    source's draws that each shard takes. ``shards`` is a power of two."""
    if shards & (shards - 1):
        raise ValueError("the number of shards must be a power of two")
    node = (quotas.agg(F.sort_array(F.collect_list(F.struct("idx", "quota"))).alias("q"))  # one entry per source
            .select(F.lit(1).cast("long").alias("node"), F.transform("q", lambda s: s["quota"]).alias("c"),
                    F.transform("q", lambda s: s["idx"]).alias("idx")))
    for _ in range(shards.bit_length() - 1):
        total = F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x)
        # total, drawn: what is still to be shared out; left: the left half's counts so far
        empty = F.expr("cast(array() as array<bigint>)")
        start = F.struct(total.alias("n"), F.floor(total / 2).cast("long").alias("m"), empty.alias("left"))
        left = F.aggregate("c", start, lambda a, c: _let(
            hypergeometric(a["n"], c, a["m"], _uniform(F.col("node"), F.size(a["left"]))),
            lambda x: F.struct((a["n"] - c).alias("n"), (a["m"] - x).alias("m"), F.array_append(a["left"], x).alias("left"))))["left"]
        node = node.withColumn("left", left).select(
            "idx", F.explode(F.array(
                F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("c")),
                F.struct((F.col("node") * 2 + 1).alias("node"), F.zip_with("c", "left", lambda c, x: c - x).alias("c")))).alias("s")
        ).select("s.node", "s.c", "idx")
    leaf = node.select((F.col("node") - shards).cast("int").alias("shard"),
                       F.explode(F.arrays_zip("idx", F.col("c").alias("n"))).alias("e")).select("shard", "e.idx", "e.n")
    upto = Window.partitionBy("idx").orderBy("shard")
    return (leaf.withColumn("to", F.sum("n").over(upto)).withColumn("from", F.col("to") - F.col("n"))
            .filter("n > 0").select("idx", "shard", "from", "to"))


@dataclass
class MixPlan:
    """sources: per source; blocks: per block with its draws (array of shards of
    whole draws, shard of the partial one); picks: documents taken from the
    boundary blocks (unit key)."""
    sources: DataFrame
    blocks: DataFrame
    picks: DataFrame


def _block(nblocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "size"), nblocks)


def plan_mix(units: DataFrame, shards: int = SHARDS, weights: tuple[int, ...] = WEIGHTS,
             max_repeat: int = MAX_REPEAT) -> MixPlan:
    """``units``: stored table of (doc_id, source, size, copies), one row per unit.
    Sources, blocks and picks are written to the shared work folder."""
    spark = units.sparkSession

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, f"mix-{label}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    blocks_of = F.least(F.lit(MAX_BLOCKS).cast("long"), F.greatest(
        F.lit(1).cast("long"), F.ceil(F.col("source_size") / BLOCK_WORDS), F.ceil(F.col("units") / (BLOCK_WORDS >> 4))))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = stored(source_targets(units, weights, max_repeat).withColumn("nblocks", blocks_of)
                     .withColumn("passes", passes)
                     .withColumn("rest", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")), "sources")
    placed = (units.join(sources, units["source"].eqNullSafe(sources["source"])).drop("source")
              .withColumn("block", _block(F.col("nblocks"))))
    sized = placed.groupBy("idx", "block").agg(F.sum(F.col("size") * F.col("copies")).alias("words"),
                                               *(F.first(c).alias(c) for c in ("passes", "rest")))
    # A permuted order of the blocks for the last pass: a running sum over blocks.
    order = Window.partitionBy("idx").orderBy(F.xxhash64(F.lit(SEED), F.lit("order"), "idx", "block"), "block")
    ranked = (sized.withColumn("pos", F.row_number().over(order) - 1)
              .withColumn("before", F.sum("words").over(order) - F.col("words"))
              .withColumn("whole", F.col("before") + F.col("words") <= F.col("rest"))
              .withColumn("part", ~F.col("whole") & (F.col("before") < F.col("rest")))
              .withColumn("room", F.when(F.col("part"), F.col("rest") - F.col("before")))
              .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("idx"))))
    ranked = stored(ranked, "ranked")

    quotas = ranked.groupBy("idx").agg(F.sum(F.col("passes") + (F.col("whole") | F.col("part")).cast("long")).cast("long").alias("quota"))
    ranges = splitting_tree(quotas, shards)
    # Draws in permuted order: pass by pass, and inside a pass by position.
    last = F.when(F.col("whole") | F.col("part"), F.col("passes")).otherwise(F.col("passes") - 1)
    draws = (ranked.filter(last >= 0)
             .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
             .withColumn("draw", F.col("epoch") * F.col("n") + F.col("pos")))
    dealt = (draws.join(ranges, "idx").filter((F.col("draw") >= F.col("from")) & (F.col("draw") < F.col("to")))
             .groupBy("idx", "block").agg(
                 F.sort_array(F.collect_list(F.when(~F.col("part") | (F.col("epoch") < F.col("passes")), F.struct("epoch", "shard")))).alias("d"),
                 F.max(F.when(F.col("part") & (F.col("epoch") == F.col("passes")), F.col("shard"))).alias("part_shard")))
    blocks = stored(ranked.select("idx", "block", "room").join(dealt, ["idx", "block"], "left").select(
        "idx", "block", "room", F.coalesce(F.transform("d", lambda x: x["shard"]), F.expr("cast(array() as array<int>)")).alias("draws"),
        "part_shard"), "blocks")

    # The boundary block of each source: whole documents that fit.
    open_docs = (placed.select("doc_id", "size", "copies", "idx", "block").filter("size > 0")
                 .join(blocks.filter("room is not null").select("idx", "block", "room"), ["idx", "block"])
                 .withColumn("w", F.col("size") * F.col("copies"))
                 .withColumn("h", F.xxhash64(F.lit(SEED), F.lit("fill"), "doc_id", "size"))
                 .withColumn("picked", F.lit(False)).withColumn("left", F.col("room")))
    for by in (["h"], [F.desc("w"), "h"], ["h"], ["w", "h"]):  # last: the most documents that still fit
        fit = ~F.col("picked") & (F.col("w") <= F.col("left"))
        upto = Window.partitionBy("idx").orderBy(*by, "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
        open_docs = (open_docs.withColumn("fit", fit)
                     .withColumn("run", F.sum(F.when(F.col("fit"), F.col("w")).otherwise(0)).over(upto))
                     .withColumn("picked", F.col("picked") | (F.col("fit") & (F.col("run") <= F.col("left"))))
                     .withColumn("left", F.col("room") - F.sum(F.when(F.col("picked"), F.col("w")).otherwise(0)).over(
                         Window.partitionBy("idx"))))
    picks = stored(open_docs.filter("picked").select("doc_id", "idx", "size"), "picks")
    return MixPlan(sources, blocks, picks)


def _units(docs: DataFrame, text_col: str, id_col: str, source_col: str) -> DataFrame:
    spark = docs.sparkSession
    path = scratch_path(spark, "mix-units")
    (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                 word_count(F.col(f"`{text_col}`")).alias("size"))
     .groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies")).write.parquet(path))
    return spark.read.parquet(path)


def _with_draws(rows: DataFrame, plan: MixPlan) -> DataFrame:
    """Attach source and block columns and the shards of a row's copies.
    ``rows`` has doc_id, source, size beside what it carries."""
    s, p = plan.sources.alias("s"), plan.picks.withColumn("picked", F.lit(True)).alias("p")
    out = (rows.alias("r").join(s, F.col("r.source").eqNullSafe(F.col("s.source")), "left")
           .select("r.*", "s.idx", "s.source_size", "s.target", _block(F.col("s.nblocks")).alias("block")))
    out = out.join(plan.blocks.drop("room"), ["idx", "block"], "left").alias("r")
    same = (F.col("r.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("r.idx") == F.col("p.idx")) & (F.col("r.size") == F.col("p.size")))
    return (out.join(p, same, "left")
            .select("r.*", F.when(F.col("p.picked"), F.array_append("r.draws", F.col("r.part_shard")))
                    .otherwise(F.col("r.draws")).alias("shards")))


def measure(docs: DataFrame, shards: int = SHARDS, text_col: str = "text", id_col: str = "doc_id",
            source_col: str = "source") -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, source, shards
    (the output shard of each of its copies)."""
    units = _units(docs, text_col, id_col, source_col)
    plan = plan_mix(units, shards)
    out = _with_draws(units, plan)
    return (out.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "source", "shards"))


def mix(docs: DataFrame, shards: int = SHARDS, text_col: str = "text", id_col: str = "doc_id",
        source_col: str = "source") -> DataFrame:
    """The mix itself: each document as often as it is taken, with the input's
    columns, rows of a shard near each other and in a hashed order."""
    taken = [c for c in docs.columns if c.lower().startswith("_mix_")]
    if taken:
        raise ValueError(f"columns {taken} use the reserved prefix '_mix_'")
    plan = plan_mix(_units(docs, text_col, id_col, source_col), shards)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_mix_row"), F.col(f"`{id_col}`").alias("doc_id"),
                       F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"))
    out = _with_draws(rows, plan).select("_mix_row", "doc_id", "block", "idx", F.posexplode("shards").alias("_mix_copy", "_mix_shard"))
    return (out.repartition("_mix_shard", "idx", "block", "_mix_copy")
            .sortWithinPartitions("_mix_shard", F.xxhash64(F.lit(SEED), "doc_id", "_mix_copy"))
            .select("_mix_row.*"))
