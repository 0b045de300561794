"""Silver kept up to date batch by batch, without shuffling what is stored.

The table is partitioned by trade month and bucketed by TradeID. A batch is cut to the
latest copy of each of its trades and dealt into as many parts as the table has
buckets; the stored ids and their stamps (no other column) are joined with it bucket by
bucket. Only months that gain or lose a row are written again, each in place of its old
files. Adding a batch therefore shuffles the batch, reads a few columns of the
table, and rewrites the months it touches.

The result equals a rebuild from all batches in any order, since the latest copy (ties
by the business columns) does not depend on it. Adding a batch twice changes nothing;
a run that failed half-way is finished by running it again with the same batch before
any other is added. One run at a time; readers that list the table during a run may see
some months before and some after it.

TradeID is required, as everywhere behind bronze. Rows without a trade date are in the
month ``none``. The number of buckets is part of the folder's name, so a table is never
read with another number than it was written with. A bucket is one task of every merge,
so ``buckets_for`` takes the number from the trades that the table is to hold.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from settleframe.plans.silver import cleanse_trades
from settleframe.schemas import TRADE_BUSINESS_COLUMNS
from settleframe.sources.files import delete, exists, has_data

KEY, MONTH = "TradeID", "trade_month"
BUCKETS = 64
MIN_BUCKETS, BUCKET_ROWS = 2, 1_500_000    # some 500 bytes a row are sorted in a task at once
NO_MONTH = "none"


def buckets_for(rows: int) -> int:
    """Buckets for a table of so many trades: what one task holds stays the same
    however many there are."""
    return max(MIN_BUCKETS, -(-rows // BUCKET_ROWS))


@dataclass(frozen=True)
class MergeResult:
    """Counts of a merged batch: distinct trades in it, those that replaced a stored
    copy (an equal one too), those that a later stored copy kept out, and the months written."""
    trades: int
    replaced: int
    outdated: int
    months: tuple[str, ...]


@dataclass(frozen=True)
class IncrementalSilver:
    """A silver table under ``path``, known to the session's catalog as ``name``."""
    spark: SparkSession
    name: str
    path: str
    buckets: int = BUCKETS

    @property
    def location(self) -> str:
        return f"{self.path.rstrip('/')}/{self.buckets}_buckets"

    def attach(self, schema: StructType | None = None) -> None:
        """Catalog entry over the folder; ``schema`` is needed while it is empty."""
        if not self.name.replace("_", "").replace(".", "").isalnum():
            raise ValueError(f"bad table name {self.name!r}")
        if schema is None:
            schema = self.spark.read.parquet(self.location).drop(MONTH).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != MONTH)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self.spark.sql(f"CREATE TABLE {self.name} ({columns}, {MONTH} STRING) USING parquet PARTITIONED BY ({MONTH}) "
                       f"CLUSTERED BY ({KEY}) INTO {self.buckets} BUCKETS LOCATION '{self.location}'")
        if exists(self.spark, self.location):
            self.spark.catalog.recoverPartitions(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def merge(self, batch: DataFrame, rules: Mapping[str, Any] | None = None, strict: bool = False) -> MergeResult:
        """Add accepted bronze trades."""
        silver = cleanse_trades(batch, rules, strict).withColumn(
            MONTH, F.coalesce(F.date_format("TradeDateYYYYMMDD", "yyyy-MM"), F.lit(NO_MONTH)))
        first = not (exists(self.spark, self.location) and has_data(self.spark, self.location))
        self.attach(silver.schema if first else None)
        missing = [c for c in silver.columns if c not in self.read().columns]
        if missing:
            raise ValueError(f"the stored table lacks column(s) {missing}; rebuild it with them")
        stored = self.read()
        silver = silver.select(*(F.col(c).cast(t) if c in silver.columns else F.lit(None).cast(t).alias(c)
                                 for c, t in stored.dtypes))
        fresh = f"{self.path.rstrip('/')}/_batch"
        delete(self.spark, fresh)
        silver.write.parquet(fresh)     # the batch is read several times; stamps must not change between
        fresh_rows = self.spark.read.schema(silver.schema).parquet(fresh)
        met = f"{self.path.rstrip('/')}/_met"
        delete(self.spark, met)
        found = meetings(stored, fresh_rows, self.buckets)
        found.write.parquet(met)
        hits = self.spark.read.schema(found.schema).parquet(met)
        winners = fresh_rows.join(hits.filter("later").select(KEY).distinct(), KEY, "left_anti")
        # At most one row per calendar month reaches the driver.
        beaten = hits.join(winners.select(KEY), KEY, "left_semi")
        lost = {r[0] for r in beaten.select(MONTH).distinct().collect()}
        gained = {r[0] for r in winners.select(MONTH).distinct().collect()}
        counts = (fresh_rows.count(), beaten.select(KEY).distinct().count(), hits.filter("later").select(KEY).distinct().count())
        months = sorted(lost | gained)
        if months:
            result = replaced_months(stored, winners, months, self.buckets).select(*stored.columns)
            self._replace(result)
            self.spark.catalog.refreshTable(self.name)
            rest = self.read().filter(F.col(MONTH).isin(sorted(lost - gained))).join(winners.select(KEY), KEY, "left_anti")
            emptied = lost - gained - {r[0] for r in rest.select(MONTH).distinct().collect()}
            for month in sorted(emptied):    # their last row has gone, so nothing was written over them
                self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({MONTH} = '{month}')")
                delete(self.spark, f"{self.location}/{MONTH}={month}")
            self.spark.catalog.refreshTable(self.name)
        delete(self.spark, fresh)
        delete(self.spark, met)
        return MergeResult(*counts, tuple(months))


    def _replace(self, rows: DataFrame) -> None:
        """Put the months of ``rows`` in place of the stored ones. Files are staged and
        moved when all tasks are done. (Inserts take the mode from the session only.)"""
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "dynamic")
        try:
            rows.write.mode("overwrite").insertInto(self.name)
        finally:
            self.spark.conf.set(setting, before)


def _stamp(columns: list[str]) -> Column:
    """What decides between copies, in order; a null is less than any value."""
    return F.struct(*(c for c in ["ingestion_timestamp", *TRADE_BUSINESS_COLUMNS] if c in columns and c != KEY))


def _dealt(batch: DataFrame, buckets: int) -> DataFrame:
    """The batch in the table's buckets, joined by merging so that the table stays in them."""
    return batch.repartition(buckets, KEY).hint("merge")


def meetings(stored: DataFrame, batch: DataFrame, buckets: int) -> DataFrame:
    """Stored rows of the batch's trades: TradeID, their month, and whether they are
    later than the batch's copy."""
    old = stored.select(KEY, MONTH, _stamp(stored.columns).alias("old"))
    new = _dealt(batch.select(KEY, _stamp(batch.columns).alias("new")), buckets)
    return old.join(new, KEY).select(KEY, MONTH, (F.col("old") > F.col("new")).alias("later"))


def replaced_months(stored: DataFrame, winners: DataFrame, months: list[str], buckets: int) -> DataFrame:
    """All rows that the given months hold afterwards."""
    stay = stored.filter(F.col(MONTH).isin(months)).join(_dealt(winners.select(KEY), buckets), KEY, "left_anti")
    return stay.select(*stored.columns).unionByName(winners.select(*stored.columns).repartition(buckets, KEY))
