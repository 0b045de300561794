"""Gold: daily counterparty aggregates and the ranked counterparty summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settleframe.config import PipelineConfig
from settleframe.operators.aggregates import (
    counterparty_totals,
    daily_metrics,
    with_time_dimensions,
    with_volume_category,
)
from settleframe.operators.metrics import MetricsLog, count_rows
from settleframe.operators.ranking import global_rank
from settleframe.operators.rollups import period_rollup, running_total, trade_counts_cube
from settleframe.operators.validation import CLEANSED
from settleframe.sources.readers import read_table
from settleframe.sources.sinks import write_table

AGGREGATION_LEVEL = "COUNTERPARTY_DATE"


def valid_trades(silver: DataFrame) -> DataFrame:
    """Silver rows whose status is CLEANSED (a pushed-down Parquet filter)."""
    return silver.filter(F.col("data_quality_status") == CLEANSED)


def finish_daily(daily: DataFrame, stamp: bool = True) -> DataFrame:
    """Volume bucket, calendar attributes and metadata on daily aggregates."""
    out = (daily.transform(with_volume_category)
           .transform(with_time_dimensions)
           .withColumn("aggregation_level", F.lit(AGGREGATION_LEVEL)))
    if stamp:
        out = out.withColumn("gold_processing_timestamp", F.current_timestamp())
    return out


def trade_aggregates(silver: DataFrame, stamp: bool = True) -> DataFrame:
    """Daily notional and trade statistics per counterparty and trade date."""
    return finish_daily(daily_metrics(valid_trades(silver)), stamp)


def counterparty_summary(silver: DataFrame, rank: bool = True) -> DataFrame:
    """Per-counterparty totals, ranked by total notional (1 = largest; ties
    share a rank; null totals rank last). Unsorted: sort at presentation."""
    totals = counterparty_totals(valid_trades(silver))
    return global_rank(totals, "TotalNotional", "NotionalRank") if rank else totals


def sorted_summary(summary: DataFrame) -> DataFrame:
    """The summary for presentation: largest total first, null totals last, ties
    by counterparty. A range-partitioned sort; rank first, sort last."""
    return summary.orderBy(F.col("TotalNotional").desc_nulls_last(), F.col("Counterparty").asc_nulls_last())


def run_gold(spark: SparkSession, cfg: PipelineConfig, log: MetricsLog) -> None:
    """Write ``gold_trade_aggregates`` (partitioned by year, month) and
    ``gold_counterparty_summary``."""
    silver = read_table(spark, cfg.table_path("silver", cfg.trades.silver_table), cfg.table_format)
    table = cfg.trades.gold_table or "gold_trade_aggregates"
    groups = daily_metrics(valid_trades(silver), keep_empty=True)
    # Counted and cut behind the last exchange, in the stage that writes.
    write_table(finish_daily(groups), cfg.table_path("gold", table), cfg.table_format,
                partition_cols=["TradeYear", "TradeMonth"], rebalance=True,
                finish=lambda d: log.observe(
                    d, "gold", table, groups=count_rows(),
                    groups_without_notional=F.count_if(F.col("DailyNotional").isNull())).filter(F.col("DailyNotional").isNotNull()))

    write_table(counterparty_summary(silver), cfg.table_path("gold", "gold_counterparty_summary"), cfg.table_format,
                finish=lambda d: log.observe(d, "gold", "gold_counterparty_summary", rows_written=count_rows()))
    log.collect()
    log.add("gold", table, "rows_written",
            log.value("gold", table, "groups") - log.value("gold", table, "groups_without_notional"))


REPORT_TABLES = ("gold_period_rollup", "gold_running_notional", "gold_trade_counts")


def top_counterparties(spark: SparkSession, cfg: PipelineConfig, n: int) -> DataFrame:
    """Counterparties ranked ``<= n`` (ties kept), from the stored ranked
    summary: a pruned read, no shuffle."""
    summary = read_table(spark, cfg.table_path("gold", "gold_counterparty_summary"), cfg.table_format)
    return summary.filter(F.col("NotionalRank") <= n)


def run_gold_reports(spark: SparkSession, cfg: PipelineConfig, log: MetricsLog) -> None:
    """Optional trend tables from the stored silver table: monthly, quarterly
    and yearly totals per counterparty; running notional per counterparty;
    trade counts by currency and status (with subtotals)."""
    silver = valid_trades(read_table(spark, cfg.table_path("silver", cfg.trades.silver_table), cfg.table_format))
    reports = {
        "gold_period_rollup": period_rollup(silver),
        "gold_running_notional": running_total(daily_metrics(silver, keep_empty=True)),
        "gold_trade_counts": trade_counts_cube(silver),
    }
    for name, df in reports.items():
        write_table(df, cfg.table_path("gold", name), cfg.table_format,
                    finish=lambda d, name=name: log.observe(d, "gold", name, rows_written=count_rows()))
    log.collect()
