"""Merkle manifest of a dataset: a hash tree per language, a root over the
languages, and for every row the proof that leads from it to the root.

H is SHA-256 in lower-case hex; digests enter another H as that text. A row's leaf
is H of its fields, each as byte count, colon and value. Rows of a language ascend
by id; eight consecutive nodes become one until one is left, the subroot.
Subroots, by language, become the root in the same way.

A row's rank in its language, written in octal, is its way through the tree. Three
digits make a bounded block of 512 rows: its digit columns are grouped away one
after the other, each grouping hashing its run and nesting the child structs, so
that a block ends as one row that holds its whole subtree. The blocks' hashes are the
rows of the next three digits, and so on up to the subroots, and over these to the
root. On the way down the path above a block comes to it as one more row of a
grouping by block, and three times a transform and an explode turn the nested
structs into one row per node with the siblings on its path. Proofs need no join, and
no row, task or driver holds more than a block.

Only hashes and ids travel: texts are read once, in a scan.

Defined results: a null field is ``-``; an empty text ``0:``. Rows without a
language are a tree of their own, before all others. A null id comes before all
ids; rows of equal ids ascend by their leaf, and repeated rows are leaves each.
A lone row is its subroot and a lone subroot the root, with an empty proof. Very
long texts are one field. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settleframe.llm.ranks import positions, stored

BITS = 3                  # eight nodes a run
DIGITS = 3                # runs nested in one block: 8**3 rows
_STEP = "struct<b:string,a:string>"   # digests before and after a node in its run

# A-Z and a-z.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(c: Column) -> Column:
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(*fields: Column) -> Column:
    """H of some fields."""
    return F.sha2(F.concat(*map(_field, fields)).cast("binary"), 256)


def levels(total: Column) -> Column:
    """Levels of runs over ``total`` nodes: the octal digits of the last rank."""
    return F.when(total <= 1, F.lit(0)).otherwise(F.length(F.conv((total - 1).cast("string"), 10, 8)))


def _run(children: Column) -> Column:
    return F.transform(children, lambda x: x["hash"])


def _nest(nodes: DataFrame) -> DataFrame:
    """One row per block of (tree, left, rank, hash, own): (tree, left, block, hash, c).

    ``left`` counts the levels that the tree still has; a block's levels beyond it
    pass their only child's hash on."""
    digit = lambda i: F.shiftright("rank", BITS * i).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")
    df = nodes.select("tree", "left", F.shiftright("rank", BITS * DIGITS).alias("block"),
                      *(digit(i).alias(f"d{i}") for i in range(DIGITS)), "hash", F.col("own").alias("held"))
    df = df.repartition("tree", "block")   # every grouping below keeps to it
    for i in range(DIGITS):
        above = [f"d{k}" for k in range(i + 1, DIGITS)]
        child = F.struct(F.col(f"d{i}").alias("d"), "hash", "held")
        df = (df.groupBy("tree", "left", "block", *above).agg(F.sort_array(F.collect_list(child)).alias("held"))
              .withColumn("hash", F.when(F.col("left") > i, F.sha2(F.concat_ws("", _run(F.col("held"))).cast("binary"), 256))
                          .otherwise(F.col("held")[0]["hash"])))
    return df.select("tree", "left", "block", "hash", F.col("held").alias("c"))


def _unnest(blocks: DataFrame) -> DataFrame:
    """One row per node of (tree, left, block, c, path, top): (tree, rank, hash, own, path, top)."""
    df = blocks.withColumnRenamed("block", "rank").withColumn("hash", F.lit(None).cast("string"))
    for i in reversed(range(DIGITS)):
        df = df.select("tree", "left", "rank", "path", "top", _run(F.col("c")).alias("run"), F.posexplode("c").alias("at", "x"))
        step = F.struct(F.concat_ws("", F.slice("run", F.lit(1), F.col("at"))).alias("b"),
                        F.concat_ws("", F.slice("run", F.col("at") + 2, F.lit(1 << BITS))).alias("a"))
        df = df.select("tree", "left", (F.shiftleft("rank", BITS) + F.col("x.d")).alias("rank"),
                       F.when(F.col("left") > i, F.concat(F.array(step), "path")).otherwise(F.col("path")).alias("path"),
                       "top", F.col("x.hash").alias("hash"), F.col("x.held").alias("c"))
    return df.select("tree", "rank", "hash", F.col("c").alias("own"), "path", "top")


def prove(nodes: DataFrame, finish: Callable[[DataFrame], DataFrame], label: str = "merkle") -> DataFrame:
    """Paths of the nodes (tree, left, rank, hash, own) of many trees at once:
    (tree, rank, hash, own, path, top), ``path`` bottom up.

    ``finish`` gets (tree, hash) of the trees' tops and returns (tree, path, top): the
    path above each and whatever is to reach its nodes."""
    blocks = stored(_nest(nodes), f"{label}-blocks")
    if blocks.filter("block > 0").isEmpty():
        above = finish(blocks.select("tree", "hash")).withColumn("block", F.lit(0).cast("long"))
    else:
        up = blocks.select("tree", F.greatest(F.col("left") - DIGITS, F.lit(0)).alias("left"), F.col("block").alias("rank"), "hash",
                           F.lit(None).cast("string").alias("own"))
        above = prove(up, finish, label).select("tree", F.col("rank").alias("block"), "path", "top")
    # The path above a block is one more row of the block.
    both = blocks.select("tree", "block", "left", "c").unionByName(above.select("tree", "block", "path", "top"), allowMissingColumns=True)
    whole = both.groupBy("tree", "block").agg(F.max("left").alias("left"), *(F.first(c, ignorenulls=True).alias(c) for c in ("c", "path", "top")))
    return _unnest(whole)


def _root(tops: DataFrame) -> DataFrame:
    """Paths from the subroots to the root over all trees, by the trees' names."""
    tops = stored(tops, "merkle-subroots").withColumn("all", F.lit(""))
    placed = positions(tops, "all", [F.col("tree")], "merkle-trees")
    nodes = placed.select(F.col("all").alias("tree"), levels(F.col("total")).alias("left"), "rank", "hash", F.col("tree").alias("own"))
    whole = lambda top: top.select("tree", F.array().cast(f"array<{_STEP}>").alias("path"), F.col("hash").alias("top"))
    return prove(nodes, whole, "merkle-root").select(
        F.col("own").alias("tree"), "path", F.struct(F.col("hash").alias("subroot"), F.col("top").alias("root")).alias("top"))


def fold(path: Column, start: Column) -> Column:
    """The root that ``start`` leads to along a path."""
    return F.aggregate(path, start, lambda acc, x: F.sha2(F.concat(x["b"], acc, x["a"]).cast("binary"), 256))


def proof_text(path: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.concat_ws("", F.flatten(F.transform(path, lambda x: F.array(x["b"], x["a"]))))


def manifest(docs: DataFrame, other_text: Column | None = None) -> DataFrame:
    """Per row: doc_id, lang, leaf, other (its leaf with ``other_text`` in place of
    the text, null where that is null), subroot, root, path (bottom up:
    siblings before and after)."""
    cols = {c: F.col(f"`{c}`") for c in FIELDS}
    other = F.lit(None).cast("string") if other_text is None else F.when(
        other_text.isNotNull(), leaf(*(cols[c] for c in FIELDS[:-1]), other_text))
    leaves = stored(docs.select(
        cols["doc_id"].cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("="), cols["lang"]), F.lit("")).alias("tree"),
        leaf(*cols.values()).alias("hash"), other.alias("other")), "merkle-leaves")
    placed = positions(leaves, "tree", [F.col("doc_id").asc_nulls_first(), F.col("hash")], "merkle-ranked")
    nodes = placed.select("tree", levels(F.col("total")).alias("left"), "rank", "hash", F.struct("doc_id", "other").alias("own"))
    lang = F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30))
    return prove(nodes, _root).select("own.doc_id", lang.alias("lang"), F.col("hash").alias("leaf"), "own.other", "top.*", "path")


def tamper_test(docs: DataFrame) -> DataFrame:
    """The manifest's proofs against a damaged copy: the text of every third row (by
    the unsigned crc32 of its decimal id) loses its capitals A-Z."""
    hit = F.crc32(F.col("`doc_id`").cast("string").cast("binary")) % 3 == 0
    rows = manifest(docs, F.when(hit, F.translate(F.col("`text`"), UPPER, LOWER)))
    out = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
                      fold(F.col("path"), F.coalesce("other", "leaf")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
