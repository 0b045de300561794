"""Layer-table writers. Each call runs exactly one Spark action (one more, without
rows, for an empty partitioned table).

A table is a plain folder in its format, so any reader opens it by its path. An
overwrite first writes a folder beside it, out of sight of readers, and then puts it in
the table's place by two renames: a failed write leaves the old table as it was, and a
frame may be written over the table that it is read from. Readers that have listed the
old files and still read them fail then, as with any plain overwrite; formats with a
log of their own (Delta and the like) spare them, and are written plainly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from settleframe.sources.files import delete, has_data, move

TRANSACTIONAL = ("delta", "iceberg", "hudi")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_cols: Sequence[str] | None = None, rebalance: bool = False,
                max_records_per_file: int | None = None,
                finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write ``df`` to ``path``.

    With ``partition_cols`` the table gets a hive-style layout (readers get
    partition pruning). By default every task writes its own rows (no
    shuffle; right when the partition values are few, as for record status).
    ``rebalance=True`` first regroups rows on the partition columns, so each
    directory gets few files; AQE splits an oversized value over several
    tasks and merges small ones. ``finish`` is applied behind that exchange, in
    the stage that writes (for observations, which a repeated map stage would
    count twice). An overwrite replaces the whole table and its schema, whatever the
    session's partition overwrite mode; ``append`` adds files to the folder.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    cols = list(partition_cols or [])
    if cols and rebalance:
        df = df.hint("rebalance", *cols)
    if finish is not None:
        df = finish(df)
    writer = df.write.format(fmt).option("partitionOverwriteMode", "static")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if cols:
        writer = writer.partitionBy(*cols)
    if fmt in TRANSACTIONAL:
        writer.mode(mode).option("overwriteSchema" if mode == "overwrite" else "mergeSchema", True).save(base)
        return
    if mode == "append":
        writer.mode("append").save(base)
        return
    parent, _, name = base.rpartition("/")
    run = uuid.uuid4().hex[:12]
    new, old = (f"{parent}/_{name}-{run}-{part}" for part in ("new", "old"))
    try:
        writer.mode("errorifexists").save(new)
        if cols and not has_data(spark, new):   # one empty file keeps the columns
            spark.createDataFrame([], df.schema).coalesce(1).write.format(fmt).mode("append").save(new)
        move(spark, base, old)
        move(spark, new, base)
    finally:
        delete(spark, new)
    delete(spark, old)
    spark.catalog.refreshByPath(base)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Catalog entry over a table's path, its partitions included: a view, so every
    query lists the folder anew and no overwrite leaves the entry behind. Register
    again after the table's columns have changed."""
    if not name.replace("_", "").replace(".", "").isalnum():
        raise ValueError(f"bad table name {name!r}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fmt}.`{path.rstrip('/')}`")
