"""Silver: normalize currency, keep the latest copy of each trade, standard
timestamps and business dates, data-quality status."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settleframe.config import PipelineConfig
from settleframe.functions.columns import as_timestamp, normalize_currency
from settleframe.operators.dedup import keep_latest
from settleframe.operators.enrichment import latest_instruments
from settleframe.operators.metrics import MetricsLog, count_rows
from settleframe.operators.validation import quality_status
from settleframe.plans.bronze import read_bronze
from settleframe.schemas import TRADE_BUSINESS_COLUMNS
from settleframe.sources.sinks import write_table

TIMESTAMP_COLUMNS = ["TradeDate", "SettlementDate", "ingestion_timestamp"]


def with_normalized_currency(df: DataFrame, length: int = 3) -> DataFrame:
    return df.withColumn("Currency", normalize_currency("Currency", length))


def latest_trades(df: DataFrame) -> DataFrame:
    """One row per TradeID: latest ``ingestion_timestamp``; equal stamps are
    resolved by the business columns (all descending, nulls last)."""
    order = ["ingestion_timestamp"] if "ingestion_timestamp" in df.columns else []
    ties = [c for c in TRADE_BUSINESS_COLUMNS if c != "TradeID" and c in df.columns]
    return keep_latest(df, "TradeID", order, ties)


def with_standard_timestamps(df: DataFrame) -> DataFrame:
    """Timestamp columns in timestamp form (text parsed, bad text -> null),
    plus ``TradeDateYYYYMMDD`` / ``SettlementDateYYYYMMDD`` dates."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cols = {c: as_timestamp(c, types[c]) for c in TIMESTAMP_COLUMNS if c in types}
    df = df.withColumns(cols)
    return df.withColumns({
        "TradeDateYYYYMMDD": F.to_date("TradeDate"),
        "SettlementDateYYYYMMDD": F.to_date("SettlementDate"),
    })


def cleanse_trades(bronze_trades: DataFrame, rules: Mapping[str, Any] | None = None,
                   strict: bool = False, stamp: bool = True) -> DataFrame:
    """Silver trades from accepted bronze rows (order as specified: currency
    first, so copies are compared on normalized codes)."""
    length = int((rules or {}).get("currency_length", 3) or 3)
    df = (bronze_trades
          .transform(lambda d: with_normalized_currency(d, length))
          .transform(latest_trades)
          .transform(with_standard_timestamps)
          .transform(lambda d: quality_status(d, rules, strict)))
    if stamp:
        df = df.withColumn("silver_processing_timestamp", F.current_timestamp())
    return df


def run_silver(spark: SparkSession, cfg: PipelineConfig, log: MetricsLog) -> None:
    """Write ``silver_trades`` and ``silver_instruments``."""
    t = cfg.trades
    bronze = read_bronze(spark, cfg, t.bronze_table)
    length = int(cfg.validation_rules.get("currency_length", 3) or 3)
    # Counts of what is read come from a query of their own (one column), those of
    # what is written from the stage that writes: an observation below a shuffle
    # would count a repeated map task twice.
    read = bronze.agg(count_rows().alias("n"), F.count_if(normalize_currency("Currency", length).isNull()).alias("bad")).first()
    log.add("silver", t.silver_table, "rows_read", read.n)
    log.add("silver", t.silver_table, "invalid_currency", read.bad)
    silver = (with_normalized_currency(bronze, length).transform(latest_trades)
              .transform(with_standard_timestamps)
              .transform(lambda d: quality_status(d, cfg.validation_rules, cfg.strict_quality))
              .withColumn("silver_processing_timestamp", F.current_timestamp()))
    write_table(silver, cfg.table_path("silver", t.silver_table), cfg.table_format, finish=lambda d: log.observe(
        d, "silver", t.silver_table, rows_written=count_rows(),
        rows_rejected=F.count_if(F.col("data_quality_status") != "CLEANSED")))

    i = cfg.instruments
    inst = latest_instruments(read_bronze(spark, cfg, i.bronze_table))
    write_table(inst, cfg.table_path("silver", i.silver_table), cfg.table_format,
                finish=lambda d: log.observe(d, "silver", i.silver_table, rows_written=count_rows()))
    log.collect()
    log.add("silver", t.silver_table, "duplicates_removed", read.n - log.value("silver", t.silver_table, "rows_written"))
