"""Registered queries: one Spark DataFrame per operator family, and for each
an independent SQL statement (DuckDB dialect) over the same parquet tables.

Spark side: built from the library operators on the whole ``lineitem`` /
``part`` tables (``sources.testbed``). SQL side: written from the stated
semantics, starting from the same mapping text. Columns carry the same names
on both sides. Timestamps leave as ``timestamp_ntz`` / ``date``; values that
depend on the clock (processing stamps) are never selected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from settleframe.config import DEFAULT_RULES, PipelineConfig, SourceSpec
from settleframe.operators import (
    apply_rules,
    classify_records,
    convert_to_usd,
    convert_to_usd_as_of,
    counterparty_totals,
    daily_metrics,
    daily_sketches,
    daily_usd_notional,
    drop_missing,
    enrich_trades,
    latest_instruments,
    orphan_trades,
    period_rollup,
    period_statistics,
    running_total,
    top_ranked,
    trade_counts_cube,
)
from settleframe.operators.money import exact_sums
from settleframe.operators.ranking import global_rank
from settleframe.operators.sketches import RANK_ERROR
from settleframe.operators.validation import ACCEPTED
from settleframe.plans.bronze import accepted, ingest_instruments, ingest_trades
from settleframe.plans.gold import counterparty_summary, sorted_summary, trade_aggregates, valid_trades
from settleframe.plans.incremental import IncrementalSilver, buckets_for
from settleframe.plans.medallion import run_medallion
from settleframe.plans.silver import cleanse_trades, latest_trades, with_normalized_currency, with_standard_timestamps
from settleframe.schemas import TRADE_BUSINESS_COLUMNS, TRADE_FIELDS, TRADE_REQUIRED
from settleframe.session import scratch_path
from settleframe.sources import testbed
from settleframe.sources.readers import read_instruments, read_table
from settleframe.sources.sinks import register_table, write_table

Query = Callable[[SparkSession, str], DataFrame]

# Demonstration FX rates to USD (a caller-supplied parameter
# table; currencies without a row stay unconverted).
DEMO_USD_RATES = [("USD", 1.0), ("EUR", 1.0842), ("GBP", 1.271634875), ("JPY", 0.0000671345)]
DEMO_DATED_RATES = [
    ("usd", "1990-01-01", 1.0), ("EUR", "1992-06-30", 1.1), ("EUR", "1995-01-02", 1.0842), ("EUR", "1997-07-01", 1.123456789),
    ("GBP", "1993-03-15", 1.5), ("GBP", "1996-02-29", 1.271634875), ("JPY", "1994-12-31", 0.0000671345), ("JPY", "1998-08-01", 0.0071),
]
TOP_COUNTERPARTIES = 3
PRUNED_YEAR = 1998
QUERY_BATCH_ID = "batch-query"
# A compressed landing file is read by one task, and so is what fits into one split
# together, so files are kept small: some 10 MB of JSON lines, 1 to 2 MB compressed.
LANDING_FILE_ROWS = 50_000
# The landing files written from the test tables carry zone-less wall-clock
# times, so their schema declares them timestamp_ntz (no session-zone
# reinterpretation, no DST gaps).
LANDING_TRADES_SCHEMA = {name: ("timestamp_ntz" if typ == "timestamp" else typ) for name, typ in TRADE_FIELDS}

DAILY_COLUMNS = ["Counterparty", "TradeDateYYYYMMDD", "DailyNotional", "TradeCount", "AverageTradeSize",
                 "LargestTradeSize", "SmallestTradeSize", "UniqueInstruments", "UniqueCurrencies"]
TIME_COLUMNS = ["TradeYear", "TradeMonth", "TradeQuarter", "TradeDayOfWeek", "TradeMonthName"]
GOLD_COLUMNS = DAILY_COLUMNS + ["NotionalUSD", "TradeVolumeCategory"] + TIME_COLUMNS + ["aggregation_level"]
SILVER_COLUMNS = TRADE_BUSINESS_COLUMNS + ["TradeDateYYYYMMDD", "SettlementDateYYYYMMDD", "data_quality_status"]


# ---------------------------------------------------------------- Spark side

def _bronze(spark: SparkSession, sf: str) -> DataFrame:
    return drop_missing(testbed.trades(spark, sf), TRADE_REQUIRED)


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return cleanse_trades(_bronze(spark, sf), stamp=False)


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return trade_aggregates(_silver(spark, sf), stamp=False)


def q_gold_trade_aggregates(spark, sf):
    return _daily(spark, sf).select(*GOLD_COLUMNS)


def q_gold_daily_notional(spark, sf):
    return daily_metrics(valid_trades(_silver(spark, sf))).select(*DAILY_COLUMNS)


def q_gold_daily_notional_usd(spark, sf):
    return daily_metrics(valid_trades(_silver(spark, sf))).select("Counterparty", "TradeDateYYYYMMDD", "NotionalUSD")


def q_gold_volume_category(spark, sf):
    return _daily(spark, sf).select("Counterparty", "TradeDateYYYYMMDD", "DailyNotional", "TradeVolumeCategory")


def q_gold_time_dimensions(spark, sf):
    return _daily(spark, sf).select("Counterparty", "TradeDateYYYYMMDD", *TIME_COLUMNS)


def q_gold_counterparty_summary(spark, sf):
    return counterparty_totals(valid_trades(_silver(spark, sf)))


def q_gold_counterparty_rank(spark, sf):
    return counterparty_summary(_silver(spark, sf))


def q_gold_top_counterparties(spark, sf):
    totals = counterparty_totals(valid_trades(_silver(spark, sf)))
    return top_ranked(totals, "TotalNotional", TOP_COUNTERPARTIES, "NotionalRank") \
        .select("Counterparty", "TotalTrades", "TotalNotional", "NotionalRank")


def q_gold_summary_sorted(spark, sf):
    return sorted_summary(counterparty_totals(valid_trades(_silver(spark, sf))))


def q_gold_summary_positions(spark, sf):
    """The presented summary with each row's place in it."""
    shown = sorted_summary(counterparty_totals(valid_trades(_silver(spark, sf)))).select("Counterparty", "TotalNotional")
    placed = shown.withColumn("__at", F.monotonically_increasing_id())   # ascends along the sorted parts
    return global_rank(placed, "__at", "Position", descending=False).select("Counterparty", "TotalNotional", "Position")


def q_silver_trades(spark, sf):
    return _silver(spark, sf).select(*SILVER_COLUMNS)


def q_silver_merged_batches(spark, sf):
    """Silver from three batches, the copies of a trade dealt over them in no order."""
    path, trades = scratch_path(spark, "silver-batches"), _bronze(spark, sf)
    table = IncrementalSilver(spark, path.rstrip("/").rpartition("/")[2].replace("-", "_"), path, buckets=buckets_for(trades.count()))
    bronze = trades.withColumn("batch", F.pmod(F.xxhash64(*TRADE_BUSINESS_COLUMNS), F.lit(3)))
    for batch in range(3):
        table.merge(bronze.filter(F.col("batch") == batch).drop("batch"))
    return table.read().select(*SILVER_COLUMNS)


def q_silver_currency(spark, sf):
    b = _bronze(spark, sf)
    return with_normalized_currency(b.withColumn("CurrencyRaw", F.col("Currency"))) \
        .select("TradeID", "CurrencyRaw", "Currency")


def q_silver_dedup_latest(spark, sf):
    return latest_trades(with_normalized_currency(_bronze(spark, sf))).select(*TRADE_BUSINESS_COLUMNS)


def q_silver_invalid_currency_count(spark, sf):
    n = with_normalized_currency(_bronze(spark, sf))
    return n.agg(F.count_if(F.col("Currency").isNull()).alias("invalid_currency"),
                 F.count(F.lit(1)).alias("rows_checked"))


def q_silver_timestamps(spark, sf):
    s = with_standard_timestamps(latest_trades(with_normalized_currency(_bronze(spark, sf))))
    return s.select("TradeID", "TradeDate", "SettlementDate", "TradeDateYYYYMMDD", "SettlementDateYYYYMMDD")


def q_silver_distinct_currencies(spark, sf):
    return _silver(spark, sf).select("Currency").distinct()


def q_bronze_trades_validated(spark, sf):
    return _bronze(spark, sf).select(*TRADE_BUSINESS_COLUMNS)


def q_bronze_quarantine(spark, sf):
    c = classify_records(testbed.trades(spark, sf), TRADE_REQUIRED)
    return c.filter(F.col("record_status") != ACCEPTED) \
        .select("TradeID", "InstrumentID", "Currency", "record_status", "reject_reason")


def _landing(df: DataFrame) -> DataFrameWriter:
    """Landing files of a text format, compressed: as plain text they would be most of
    what a run writes."""
    return df.write.option("compression", "gzip").option("maxRecordsPerFile", LANDING_FILE_ROWS)


def q_bronze_trades_json(spark, sf):
    landing = scratch_path(spark, "landing-trades-json")
    _landing(testbed.trades(spark, sf, with_ingestion_time=False)).mode("overwrite").json(landing)
    bronze = accepted(ingest_trades(spark, landing, "json", LANDING_TRADES_SCHEMA, batch_id=QUERY_BATCH_ID))
    return bronze.select(*TRADE_BUSINESS_COLUMNS, "ingestion_source", "processing_batch_id")


def _instruments_csv(spark: SparkSession, sf: str) -> str:
    """Instruments as CSV files of two kinds: other column order, other id name."""
    landing, inst = scratch_path(spark, "landing-instruments-csv"), testbed.instruments(spark, sf)
    nasdaq = F.col("Exchange") == "XNAS"
    _landing(inst.filter(nasdaq).withColumnRenamed("InstrumentID", "instrument_id")).option("header", True).csv(landing)
    _landing(inst.filter(~nasdaq).select("Ticker", "Exchange", "InstrumentName", "InstrumentType", "InstrumentID")) \
        .mode("append").option("header", True).csv(landing)
    return landing


def q_bronze_trades_csv(spark, sf):
    landing, trades = scratch_path(spark, "landing-trades-csv"), testbed.trades(spark, sf, with_ingestion_time=False)
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    settled = F.col("Status") == "SETTLED"
    _landing(trades.filter(settled)).options(**options).csv(landing)
    _landing(trades.filter(~settled).select(*reversed(trades.columns))).mode("append").options(**options).csv(landing)
    return accepted(ingest_trades(spark, landing, "csv", LANDING_TRADES_SCHEMA, batch_id=QUERY_BATCH_ID)) \
        .select(*TRADE_BUSINESS_COLUMNS, "ingestion_source")


def q_bronze_csv_headers(spark, sf):
    """Trades from CSV files whose headers begin with a byte-order mark, are quoted, or
    have another order and a column more."""
    landing, trades = scratch_path(spark, "landing-csv-headers"), testbed.trades(spark, sf, with_ingestion_time=False)
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    third = F.crc32(F.col("TradeID").cast("binary")) % 3
    _landing(trades.filter(third == 0).withColumnRenamed("TradeID", "\ufeffTradeID")).options(**options).csv(landing)
    _landing(trades.filter(third == 1)).mode("append").options(quoteAll=True, **options).csv(landing)
    _landing(trades.filter(third == 2).select(F.lit("x").alias("Desk, or book"), *reversed(trades.columns))).mode("append").options(**options).csv(landing)
    return accepted(ingest_trades(spark, landing, "csv", LANDING_TRADES_SCHEMA, batch_id=QUERY_BATCH_ID)) \
        .select(*TRADE_BUSINESS_COLUMNS, "ingestion_source")


def q_bronze_instruments_inferred(spark, sf):
    """Instruments with more columns, their types inferred by name over files of two
    column orders; some ids are numbers only."""
    landing, part = scratch_path(spark, "landing-inferred"), spark.read.parquet(f"{sf}/part.parquet")
    key = F.col("p_partkey")
    rows = part.select(F.when(key % 3 == 0, F.lpad(key.cast("string"), 12, "0")).otherwise(F.concat(F.lit("P"), key)).alias("InstrumentID"),
                       F.col("p_name").alias("InstrumentName"), F.col("p_size").alias("LotSize"),
                       (key * 10_000_000_000).alias("Serial"), F.col("p_retailprice").alias("ListPrice"),
                       (key % 2 == 0).alias("Listed"), F.lit(None).cast("string").alias("Remark"))
    rows.filter(key % 2 == 0).write.option("header", True).csv(landing)
    rows.filter(key % 2 == 1).select(*reversed(rows.columns)).write.mode("append").option("header", True).csv(landing)
    found = read_instruments(spark, landing, infer_schema=True)
    kinds = dict(found.dtypes)
    return found.select(*rows.columns, F.lit(", ".join(f"{c} {kinds[c]}" for c in rows.columns)).alias("Types"))


def q_bronze_refusals(spark, sf):
    """Per landing: rows read, or why the whole landing is refused."""
    root = scratch_path(spark, "landing-refusals")
    trades, inst = testbed.trades(spark, sf, with_ingestion_time=False), testbed.instruments(spark, sf)
    variants = {
        "trades csv": (trades, "csv", ingest_trades), "trades csv without TradeID": (trades.drop("TradeID"), "csv", ingest_trades),
        "trades parquet": (trades, "parquet", ingest_trades),
        "trades parquet without Currency, InstrumentID": (trades.drop("Currency", "InstrumentID"), "parquet", ingest_trades),
        "instruments csv": (inst, "csv", ingest_instruments), "instruments csv without id": (inst.drop("InstrumentID"), "csv", ingest_instruments),
    }
    rows = []
    for i, (name, (df, fmt, ingest)) in enumerate(variants.items()):
        (_landing(df) if fmt == "csv" else df.write).option("header", True).format(fmt).save(f"{root}/{i}")
        try:
            rows.append((name, ingest(spark, f"{root}/{i}", fmt).count(), None))
        except ValueError as e:
            rows.append((name, None, str(e)))
    return spark.createDataFrame(rows, "Landing string, RowsRead long, Refusal string")


def q_bronze_instruments_validated(spark, sf):
    """Instruments with an id, from Parquet landing files (some ids are null)."""
    landing = scratch_path(spark, "landing-instruments-parquet")
    testbed.instruments(spark, sf).write.parquet(landing)
    return accepted(ingest_instruments(spark, landing, "parquet")).select(
        "InstrumentID", "InstrumentType", "InstrumentName", "Ticker", "Exchange", "ingestion_source")


def q_bronze_instruments_csv(spark, sf):
    landing = _instruments_csv(spark, sf)
    bronze = accepted(ingest_instruments(spark, landing, "csv"))
    return bronze.select("InstrumentID", "InstrumentType", "InstrumentName", "Ticker", "Exchange",
                         "ingestion_source")


def q_silver_instruments(spark, sf):
    return latest_instruments(drop_missing(testbed.instruments(spark, sf), ["InstrumentID"]))


def q_trades_enriched(spark, sf):
    inst = latest_instruments(drop_missing(testbed.instruments(spark, sf), ["InstrumentID"]))
    return enrich_trades(valid_trades(_silver(spark, sf)), inst).select(
        "TradeID", "InstrumentID", "Counterparty", "Notional", "Currency", "TradeDateYYYYMMDD",
        "InstrumentType", "InstrumentName", "Ticker", "Exchange")


def q_trades_orphans(spark, sf):
    inst = latest_instruments(drop_missing(testbed.instruments(spark, sf), ["InstrumentID"]))
    return orphan_trades(valid_trades(_silver(spark, sf)), inst).select("TradeID", "InstrumentID")


def q_dq_rule_violations(spark, sf):
    checked = apply_rules(_silver(spark, sf), DEFAULT_RULES)
    return checked.select("TradeID", F.concat_ws(",", "failed_rules").alias("failed_rules"),
                          F.size("failed_rules").alias("rules_failed"))


def q_gold_period_rollup(spark, sf):
    return period_rollup(valid_trades(_silver(spark, sf)))


def q_gold_running_notional(spark, sf):
    daily = daily_metrics(valid_trades(_silver(spark, sf)), keep_empty=True)
    return running_total(daily).select("Counterparty", "TradeDateYYYYMMDD", "DailyNotional", "RunningNotional")


def q_gold_notional_usd_fx(spark, sf):
    rates = spark.createDataFrame(DEMO_USD_RATES, "Currency string, Rate double")
    return daily_usd_notional(convert_to_usd(valid_trades(_silver(spark, sf)), rates))


def q_gold_notional_usd_as_of(spark, sf):
    rates = spark.createDataFrame(DEMO_DATED_RATES, "Currency string, RateDate string, Rate double")
    return daily_usd_notional(convert_to_usd_as_of(valid_trades(_silver(spark, sf)), rates))


def q_gold_period_statistics(spark, sf):
    """Distinct counts and sizes of periods from stored daily sketches. Quantiles are
    checked against the trades: whether their ranks lie within the stated error."""
    path = scratch_path(spark, "daily-sketches")
    trades = valid_trades(_silver(spark, sf))
    daily_sketches(trades).write.parquet(path)
    found = period_statistics(spark.read.parquet(path)).filter("PeriodLevel = 'YEAR'")
    year = F.year("TradeDateYYYYMMDD").alias("y")
    sizes = trades.select(F.col("Counterparty").alias("cp"), year, "Notional").filter("Notional is not null")
    same = found["Counterparty"].eqNullSafe(sizes["cp"]) & found["TradeYear"].eqNullSafe(sizes["y"])
    keys = ["Counterparty", "TradeYear", "UniqueInstruments", "UniqueCurrencies", "PricedTrades"]
    ranks = found.join(sizes, same, "left").groupBy(*keys).agg(*(
        F.avg((F.col("Notional") < F.col(c)).cast("double")).alias(f"{c}_lo") for c in ("MedianTradeSize", "TradeSize95")), *(
        F.avg((F.col("Notional") <= F.col(c)).cast("double")).alias(f"{c}_hi") for c in ("MedianTradeSize", "TradeSize95")))
    within = lambda c, q: F.coalesce((F.col(f"{c}_lo") <= q + RANK_ERROR) & (F.col(f"{c}_hi") >= q - RANK_ERROR), F.lit(True))
    return ranks.select(*keys, within("MedianTradeSize", 0.5).alias("MedianWithin"), within("TradeSize95", 0.95).alias("TopWithin"))


def q_gold_exact_totals(spark, sf):
    """Sums far above and far below the usual amounts, per counterparty."""
    trades = valid_trades(_silver(spark, sf)).withColumns({"Huge": F.col("Notional") * 1e14, "Tiny": F.col("Notional") * 1e-19})
    huge = exact_sums(trades, ["Counterparty"], "Huge", {"HugeTotal": None, "HugeUSD": F.col("Currency") == "USD"})
    tiny = exact_sums(trades, ["Counterparty"], "Tiny", {"TinyTotal": None}, {"TradeCount": ("count", "Tiny")})
    return huge.join(tiny, huge["Counterparty"].eqNullSafe(tiny["Counterparty"])).select(
        huge["Counterparty"], "HugeTotal", "HugeUSD", "TinyTotal", "TradeCount")


def q_gold_trade_counts_cube(spark, sf):
    return trade_counts_cube(valid_trades(_silver(spark, sf)))


def _dirty_lines(trades: DataFrame) -> DataFrame:
    """Landing lines of the trades (JSON) and, beside them, lines that are wrong:
    cut off, with a text for a number, without an id."""
    order = F.split("TradeID", "-")[0].cast("long") % 50
    whole = F.struct(*trades.columns)
    text = F.struct(*((F.concat(F.lit("E"), "TradeID") if c == "TradeID" else F.lit("n/a") if c == "Notional" else F.col(c)).alias(c)
                      for c in trades.columns))
    nameless = F.struct(*(c for c in trades.columns if c != "TradeID"))
    lines = F.array(F.to_json(whole),
                    F.when(order == 1, F.concat(F.lit('{"TradeID":"'), "TradeID")),
                    F.when((order == 2) & F.col("Currency").isNotNull(), F.to_json(text)),
                    F.when(order == 3, F.to_json(nameless)))
    return trades.select(F.explode(F.array_compact(lines)).alias("value"))


def _run_config(spark: SparkSession, root: str, trades: str, fmt: str) -> PipelineConfig:
    return PipelineConfig(
        trades=SourceSpec(fmt, trades, "bronze_trades", "silver_trades", "gold_trade_aggregates"),
        instruments=SourceSpec("csv", f"{root}/landing/instruments", "bronze_instruments", "silver_instruments"),
        bronze_path=f"{root}/bronze", silver_path=f"{root}/silver", gold_path=f"{root}/gold",
        trades_schema=LANDING_TRADES_SCHEMA,
    )


def _landing_config(spark: SparkSession, sf: str) -> PipelineConfig:
    """Write the test tables as landing files and return a config for a run."""
    root = scratch_path(spark, "run")
    _landing(_dirty_lines(testbed.trades(spark, sf, with_ingestion_time=False))).text(f"{root}/landing/trades")
    _landing(testbed.instruments(spark, sf)).option("header", True).csv(f"{root}/landing/instruments")
    return _run_config(spark, root, f"{root}/landing/trades", "json")


def _run_table(layer: str, table: str, columns: list[str] | None = None) -> Query:
    """A query that makes a whole run, its own at every call, and reads a table of it back."""
    def query(spark: SparkSession, sf: str) -> DataFrame:
        cfg = _landing_config(spark, sf)
        run_medallion(spark, cfg, QUERY_BATCH_ID, reports=True)
        df = read_table(spark, cfg.table_path(layer, table))
        return df.select(*columns) if columns else df
    return query


def q_run_parquet_source(spark, sf):
    """A run from Parquet landing files; the daily table through the catalog."""
    root = scratch_path(spark, "run-parquet")
    testbed.trades(spark, sf, with_ingestion_time=False).write.parquet(f"{root}/landing/trades")
    _landing(testbed.instruments(spark, sf)).option("header", True).csv(f"{root}/landing/instruments")
    cfg = _run_config(spark, root, f"{root}/landing/trades", "parquet")
    run_medallion(spark, cfg, QUERY_BATCH_ID)
    name = "settleframe_gold_" + root.rsplit("-", 1)[1]
    register_table(spark, name, cfg.table_path("gold", cfg.trades.gold_table))
    return spark.table(name).select(*GOLD_COLUMNS)


def q_run_month_removed(spark, sf):
    """The gold table after two more runs, the last without the last year: static
    replacement under a session with dynamic overwrites, read through the catalog entry
    made after the first."""
    root = scratch_path(spark, "run-twice")
    daily = _daily(spark, sf)
    path, name = f"{root}/gold", "settleframe_twice_" + root.rsplit("-", 1)[1]
    key, before = "spark.sql.sources.partitionOverwriteMode", spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set(key, "dynamic")
    try:
        write_table(daily, path, partition_cols=["TradeYear", "TradeMonth"], rebalance=True)
        register_table(spark, name, path)
        for rows in (daily.filter(F.col("TradeMonth") == 1), daily.filter(F.col("TradeYear") < PRUNED_YEAR)):
            write_table(rows, path, partition_cols=["TradeYear", "TradeMonth"], rebalance=True)
    finally:
        spark.conf.set(key, before)
    return spark.table(name).select(*GOLD_COLUMNS)


def q_run_overwritten_by_path(spark, sf):
    """The same table overwritten twice, the second time from itself; any reader's path."""
    path = f"{scratch_path(spark, 'run-path')}/gold"
    write_table(_daily(spark, sf), path, partition_cols=["TradeYear", "TradeMonth"], rebalance=True)
    write_table(spark.read.parquet(path).filter(F.col("TradeYear") < PRUNED_YEAR), path)
    return spark.read.parquet(path).select(*GOLD_COLUMNS)


def q_layer_row_counts(spark, sf):
    cfg = _landing_config(spark, sf)
    log = run_medallion(spark, cfg, QUERY_BATCH_ID)
    return log.to_frame(spark)


def q_gold_partition_pruned_read(spark, sf):
    path = scratch_path(spark, "gold-daily")
    write_table(_daily(spark, sf), path, partition_cols=["TradeYear", "TradeMonth"], rebalance=True)
    return read_table(spark, path).filter(F.col("TradeYear") == PRUNED_YEAR).select(*GOLD_COLUMNS)


QUERIES: dict[str, Query] = {
    "gold_trade_aggregates": q_gold_trade_aggregates,
    "gold_daily_notional": q_gold_daily_notional,
    "gold_daily_notional_usd": q_gold_daily_notional_usd,
    "gold_volume_category": q_gold_volume_category,
    "gold_time_dimensions": q_gold_time_dimensions,
    "gold_counterparty_summary": q_gold_counterparty_summary,
    "gold_counterparty_rank": q_gold_counterparty_rank,
    "gold_top_counterparties": q_gold_top_counterparties,
    "gold_summary_sorted": q_gold_summary_sorted,
    "silver_trades": q_silver_trades,
    "silver_merged_batches": q_silver_merged_batches,
    "silver_currency": q_silver_currency,
    "silver_dedup_latest": q_silver_dedup_latest,
    "silver_invalid_currency_count": q_silver_invalid_currency_count,
    "silver_timestamps": q_silver_timestamps,
    "silver_distinct_currencies": q_silver_distinct_currencies,
    "bronze_trades_validated": q_bronze_trades_validated,
    "bronze_quarantine": q_bronze_quarantine,
    "bronze_trades_json": q_bronze_trades_json,
    "bronze_trades_csv": q_bronze_trades_csv,
    "bronze_instruments_csv": q_bronze_instruments_csv,
    "bronze_csv_headers": q_bronze_csv_headers,
    "bronze_instruments_inferred": q_bronze_instruments_inferred,
    "bronze_refusals": q_bronze_refusals,
    "gold_summary_positions": q_gold_summary_positions,
    "bronze_instruments_validated": q_bronze_instruments_validated,
    "silver_instruments": q_silver_instruments,
    "trades_enriched": q_trades_enriched,
    "trades_orphans": q_trades_orphans,
    "dq_rule_violations": q_dq_rule_violations,
    "gold_period_rollup": q_gold_period_rollup,
    "gold_running_notional": q_gold_running_notional,
    "gold_notional_usd_fx": q_gold_notional_usd_fx,
    "gold_exact_totals": q_gold_exact_totals,
    "gold_notional_usd_as_of": q_gold_notional_usd_as_of,
    "gold_period_statistics": q_gold_period_statistics,
    "gold_trade_counts_cube": q_gold_trade_counts_cube,
    "layer_row_counts": q_layer_row_counts,
    "gold_partition_pruned_read": q_gold_partition_pruned_read,
    "run_silver_trades": _run_table("silver", "silver_trades", SILVER_COLUMNS),
    "run_gold_daily": _run_table("gold", "gold_trade_aggregates", GOLD_COLUMNS),
    "run_gold_summary": _run_table("gold", "gold_counterparty_summary"),
    "run_gold_period_rollup": _run_table("gold", "gold_period_rollup"),
    "run_gold_running_notional": _run_table("gold", "gold_running_notional", [
        "Counterparty", "TradeDateYYYYMMDD", "DailyNotional", "RunningNotional"]),
    "run_gold_trade_counts": _run_table("gold", "gold_trade_counts"),
    "run_parquet_source": q_run_parquet_source,
    "run_month_removed": q_run_month_removed,
    "run_overwritten_by_path": q_run_overwritten_by_path,
}


# ------------------------------------------------------------ SQL (DuckDB)

# A double as text keeps its digits; their decimals are summed, and the sum read back.
_MONEY = "CAST(CAST(sum(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,18))) AS VARCHAR) AS DOUBLE)"
_WIDE_MONEY = "CAST(CAST(sum(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,{places}))) AS VARCHAR) AS DOUBLE)"
_ORDER_COPIES = ", ".join(f"{c} DESC NULLS LAST" for c in ["ingestion_timestamp"] + TRADE_BUSINESS_COLUMNS[1:])
_REQUIRED_OK = " AND ".join(f"{c} IS NOT NULL" for c in TRADE_REQUIRED)
_NORMALIZED = ("CASE WHEN regexp_full_match(upper(trim(Currency)), '[A-Z]{3}') "
               "THEN upper(trim(Currency)) END")

def _chain(source: str, order: str) -> str:
    """CTEs from a trade relation to the gold tables."""
    return f"""trades AS ({source}),
bronze AS (SELECT * FROM trades WHERE {_REQUIRED_OK}),
normalized AS (SELECT * REPLACE ({_NORMALIZED} AS Currency) FROM bronze),
copies AS (SELECT *, row_number() OVER (PARTITION BY TradeID ORDER BY {order}) AS rn FROM normalized),
silver AS (SELECT * EXCLUDE (rn), CAST(TradeDate AS DATE) AS TradeDateYYYYMMDD,
  CAST(SettlementDate AS DATE) AS SettlementDateYYYYMMDD, 'CLEANSED' AS data_quality_status
  FROM copies WHERE rn = 1),
valid AS (SELECT * FROM silver WHERE data_quality_status = 'CLEANSED'),
groups AS (SELECT Counterparty, TradeDateYYYYMMDD,
  {_MONEY.format(c='Notional')} AS DailyNotional,
  count(TradeID) AS TradeCount,
  {_MONEY.format(c='Notional')} / NULLIF(count(Notional), 0) AS AverageTradeSize,
  max(Notional) AS LargestTradeSize, min(Notional) AS SmallestTradeSize,
  count(DISTINCT InstrumentID) AS UniqueInstruments, count(DISTINCT Currency) AS UniqueCurrencies,
  {_MONEY.format(c="CASE WHEN Currency = 'USD' THEN Notional END")} AS NotionalUSD
  FROM valid GROUP BY Counterparty, TradeDateYYYYMMDD),
daily AS (SELECT *,
  CASE WHEN DailyNotional < 1000000 THEN 'SMALL' WHEN DailyNotional < 10000000 THEN 'MEDIUM' ELSE 'LARGE' END
    AS TradeVolumeCategory,
  CAST(year(TradeDateYYYYMMDD) AS INTEGER) AS TradeYear,
  CAST(month(TradeDateYYYYMMDD) AS INTEGER) AS TradeMonth,
  CAST(quarter(TradeDateYYYYMMDD) AS INTEGER) AS TradeQuarter,
  CAST(dayofweek(TradeDateYYYYMMDD) + 1 AS INTEGER) AS TradeDayOfWeek,
  strftime(TradeDateYYYYMMDD, '%B') AS TradeMonthName,
  'COUNTERPARTY_DATE' AS aggregation_level
  FROM groups WHERE DailyNotional IS NOT NULL),
totals AS (SELECT Counterparty, count(TradeID) AS TotalTrades,
  {_MONEY.format(c='Notional')} AS TotalNotional,
  {_MONEY.format(c='Notional')} / NULLIF(count(Notional), 0) AS AverageTradeSize,
  min(TradeDateYYYYMMDD) AS FirstTradeDate, max(TradeDateYYYYMMDD) AS LastTradeDate,
  count(DISTINCT InstrumentID) AS UniqueInstrumentsTraded, count(DISTINCT Currency) AS CurrenciesTraded
  FROM valid GROUP BY Counterparty),
ranked AS (SELECT *, CAST(rank() OVER (ORDER BY TotalNotional DESC NULLS LAST) AS INTEGER) AS NotionalRank
  FROM totals),
instruments AS ({testbed.INSTRUMENTS_SQL}),
inst_copies AS (SELECT *, row_number() OVER (PARTITION BY InstrumentID ORDER BY InstrumentType DESC NULLS LAST,
  InstrumentName DESC NULLS LAST, Ticker DESC NULLS LAST, Exchange DESC NULLS LAST) AS rn
  FROM instruments WHERE InstrumentID IS NOT NULL),
silver_instruments AS (SELECT * EXCLUDE (rn) FROM inst_copies WHERE rn = 1)"""


_BASE = _chain(testbed.TRADES_SQL, _ORDER_COPIES)


def _sql(body: str) -> str:
    return f"WITH {_BASE}\n{body}"


# A file-based run stamps one ingestion time per run, so copies of a trade are
# resolved by the business-column tie-breakers alone. Its landing files also hold
# lines with a text for the notional (accepted, null) and lines without an id.
_RUN_ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in TRADE_BUSINESS_COLUMNS[1:])
_ORDER_KEY = "TRY_CAST(split_part(TradeID, '-', 1) AS BIGINT) % 50"
_RUN_TRADES = f"""WITH plain AS ({testbed.TRADES_SQL})
  SELECT * FROM plain
  UNION ALL SELECT * REPLACE (concat('E', TradeID) AS TradeID, CAST(NULL AS DOUBLE) AS Notional) FROM plain
    WHERE {_ORDER_KEY} = 2 AND Currency IS NOT NULL
  UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS TradeID) FROM plain WHERE {_ORDER_KEY} = 3"""


def _run_sql(body: str) -> str:
    """Over the landing lines of a whole run."""
    return f"WITH {_chain(_RUN_TRADES, _RUN_ORDER)}\n{body}"


_cols = ", ".join
_MALFORMED = f"{_ORDER_KEY} = 1"
_MISSING = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in TRADE_REQUIRED) + ")"
_RULES = [(f"required:{c}", f"{c} IS NULL") for c in DEFAULT_RULES["required_fields"]] + [
    ("notional_min", f"coalesce(Notional < {DEFAULT_RULES['notional_min']}, false)"),
    ("currency_length", "NOT coalesce(regexp_full_match(Currency, '[A-Z]{3}'), false)"),
]
_RULE_NAMES = "concat_ws(',', " + ", ".join(f"CASE WHEN {p} THEN '{n}' END" for n, p in _RULES) + ")"
_RULE_COUNT = "CAST(" + " + ".join(f"(CASE WHEN {p} THEN 1 ELSE 0 END)" for _, p in _RULES) + " AS INTEGER)"
_RATES = "(VALUES " + ", ".join(f"('{c}', {r})" for c, r in DEMO_USD_RATES) + ") AS r(Currency, Rate)"

_DATED = "(VALUES " + ", ".join(f"('{c.upper()}', DATE '{d}', {r})" for c, d, r in DEMO_DATED_RATES) + ") AS r(Currency, RateDate, Rate)"

ORACLE_SQL: dict[str, str] = {
    "gold_trade_aggregates": _sql(f"SELECT {_cols(GOLD_COLUMNS)} FROM daily"),
    "gold_daily_notional": _sql(f"SELECT {_cols(DAILY_COLUMNS)} FROM groups WHERE DailyNotional IS NOT NULL"),
    "gold_daily_notional_usd": _sql(
        "SELECT Counterparty, TradeDateYYYYMMDD, NotionalUSD FROM groups WHERE DailyNotional IS NOT NULL"),
    "gold_volume_category": _sql(
        "SELECT Counterparty, TradeDateYYYYMMDD, DailyNotional, TradeVolumeCategory FROM daily"),
    "gold_time_dimensions": _sql(f"SELECT Counterparty, TradeDateYYYYMMDD, {_cols(TIME_COLUMNS)} FROM daily"),
    "gold_counterparty_summary": _sql("SELECT * FROM totals"),
    "gold_counterparty_rank": _sql("SELECT * FROM ranked"),
    "gold_top_counterparties": _sql(
        f"SELECT Counterparty, TotalTrades, TotalNotional, NotionalRank FROM ranked "
        f"WHERE NotionalRank <= {TOP_COUNTERPARTIES}"),
    "silver_trades": _sql(f"SELECT {_cols(SILVER_COLUMNS)} FROM silver"),
    "silver_merged_batches": _sql(f"SELECT {_cols(SILVER_COLUMNS)} FROM silver"),
    "silver_currency": _sql(f"SELECT TradeID, Currency AS CurrencyRaw, {_NORMALIZED} AS Currency FROM bronze"),
    "silver_dedup_latest": _sql(f"SELECT {_cols(TRADE_BUSINESS_COLUMNS)} FROM copies WHERE rn = 1"),
    "silver_invalid_currency_count": _sql(
        "SELECT count(*) FILTER (WHERE Currency IS NULL) AS invalid_currency, count(*) AS rows_checked "
        "FROM normalized"),
    "silver_timestamps": _sql(
        "SELECT TradeID, TradeDate, SettlementDate, TradeDateYYYYMMDD, SettlementDateYYYYMMDD FROM silver"),
    "silver_distinct_currencies": _sql("SELECT DISTINCT Currency FROM silver"),
    "bronze_trades_validated": _sql(f"SELECT {_cols(TRADE_BUSINESS_COLUMNS)} FROM bronze"),
    "bronze_quarantine": _sql(
        f"SELECT TradeID, InstrumentID, Currency, 'MISSING_REQUIRED' AS record_status, "
        f"'null required field(s): ' || {_MISSING} AS reject_reason FROM trades WHERE NOT ({_REQUIRED_OK})"),
    "bronze_trades_json": _sql(
        f"SELECT {_cols(TRADE_BUSINESS_COLUMNS)}, 'landing_zone_json' AS ingestion_source, "
        f"'{QUERY_BATCH_ID}' AS processing_batch_id FROM bronze"),
    "bronze_instruments_csv": _sql(
        "SELECT *, 'landing_zone_csv' AS ingestion_source FROM instruments WHERE InstrumentID IS NOT NULL"),
    "silver_instruments": _sql("SELECT * FROM silver_instruments"),
    "trades_enriched": _sql(
        "SELECT v.TradeID, v.InstrumentID, v.Counterparty, v.Notional, v.Currency, v.TradeDateYYYYMMDD, "
        "i.InstrumentType, i.InstrumentName, i.Ticker, i.Exchange "
        "FROM valid v LEFT JOIN silver_instruments i ON v.InstrumentID = i.InstrumentID"),
    "trades_orphans": _sql(
        "SELECT TradeID, InstrumentID FROM valid v WHERE NOT EXISTS "
        "(SELECT 1 FROM silver_instruments i WHERE i.InstrumentID = v.InstrumentID)"),
    "dq_rule_violations": _sql(
        f"SELECT TradeID, {_RULE_NAMES} AS failed_rules, {_RULE_COUNT} AS rules_failed FROM silver"),
    "gold_period_rollup": _sql(
        f"SELECT Counterparty, TradeYear, TradeQuarter, TradeMonth, count(TradeID) AS TradeCount, "
        f"{_MONEY.format(c='Notional')} AS TotalNotional, "
        f"{_MONEY.format(c='Notional')} / NULLIF(count(Notional), 0) AS AverageTradeSize, "
        "CASE WHEN GROUPING(TradeQuarter) = 0 THEN 'QUARTER' WHEN GROUPING(TradeMonth) = 0 THEN 'MONTH' "
        "ELSE 'YEAR' END AS PeriodLevel "
        "FROM (SELECT Counterparty, TradeID, Notional, CAST(year(TradeDateYYYYMMDD) AS INTEGER) AS TradeYear, "
        "CAST(quarter(TradeDateYYYYMMDD) AS INTEGER) AS TradeQuarter, "
        "CAST(month(TradeDateYYYYMMDD) AS INTEGER) AS TradeMonth FROM valid) "
        "GROUP BY GROUPING SETS ((Counterparty, TradeYear), (Counterparty, TradeYear, TradeQuarter), "
        "(Counterparty, TradeYear, TradeMonth))"),
    "gold_running_notional": _sql(
        "SELECT Counterparty, TradeDateYYYYMMDD, DailyNotional, "
        "CAST(CAST(sum(CAST(CAST(DailyNotional AS VARCHAR) AS DECIMAL(38,18))) OVER (PARTITION BY Counterparty "
        "ORDER BY TradeDateYYYYMMDD ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS VARCHAR) AS DOUBLE) "
        "AS RunningNotional FROM groups"),
    "gold_notional_usd_fx": _sql(
        "SELECT Counterparty, TradeDateYYYYMMDD, "
        f"{_MONEY.format(c='NotionalUSD')} AS NotionalUSD, "
        "count(*) FILTER (WHERE Notional IS NOT NULL AND NotionalUSD IS NULL) AS UnpricedTrades "
        "FROM (SELECT v.*, CAST(CAST(round(CAST(CAST(v.Notional AS VARCHAR) AS DECIMAL(24,9)) * CAST(r.Rate AS DECIMAL(14,12)), 2) "
        f"AS VARCHAR) AS DOUBLE) AS NotionalUSD FROM valid v LEFT JOIN {_RATES} ON v.Currency = r.Currency) "
        "GROUP BY Counterparty, TradeDateYYYYMMDD"),
    "gold_notional_usd_as_of": _sql(
        "SELECT Counterparty, TradeDateYYYYMMDD, "
        f"{_MONEY.format(c='NotionalUSD')} AS NotionalUSD, "
        "count(*) FILTER (WHERE Notional IS NOT NULL AND NotionalUSD IS NULL) AS UnpricedTrades "
        "FROM (SELECT v.*, CAST(CAST(round(CAST(CAST(v.Notional AS VARCHAR) AS DECIMAL(24,9)) * "
        f"(SELECT CAST(r.Rate AS DECIMAL(14,12)) FROM {_DATED} WHERE r.Currency = v.Currency AND r.RateDate = "
        f"(SELECT max(q.RateDate) FROM {_DATED.replace('AS r(', 'AS q(')} WHERE q.Currency = v.Currency AND q.RateDate <= v.TradeDateYYYYMMDD)), 2) "
        "AS VARCHAR) AS DOUBLE) AS NotionalUSD FROM valid v) GROUP BY Counterparty, TradeDateYYYYMMDD"),
    "gold_period_statistics": _sql(
        "SELECT Counterparty, CAST(year(TradeDateYYYYMMDD) AS INTEGER) AS TradeYear, count(DISTINCT InstrumentID) AS UniqueInstruments, "
        "count(DISTINCT Currency) AS UniqueCurrencies, count(Notional) AS PricedTrades, true AS MedianWithin, true AS TopWithin "
        "FROM valid GROUP BY Counterparty, year(TradeDateYYYYMMDD)"),
    "gold_exact_totals": _sql(
        f"SELECT Counterparty, {_WIDE_MONEY.format(c='Notional * 1e14', places=2)} AS HugeTotal, "
        f"""{_WIDE_MONEY.format(c="CASE WHEN Currency = 'USD' THEN Notional * 1e14 END", places=2)} AS HugeUSD, """
        f"{_WIDE_MONEY.format(c='Notional * 1e-19', places=37)} AS TinyTotal, count(Notional) AS TradeCount "
        "FROM valid GROUP BY Counterparty"),
    "gold_trade_counts_cube": _sql(
        f"SELECT Currency, Status, count(TradeID) AS TradeCount, {_MONEY.format(c='Notional')} AS TotalNotional, "
        "CAST(GROUPING(Currency, Status) AS INTEGER) AS grouping_id FROM valid GROUP BY CUBE (Currency, Status)"),
    "layer_row_counts": _run_sql(
        "SELECT * FROM (VALUES ('x', 'x', 'x', 0)) AS t(layer, table_name, metric, value) WHERE false "
        f"UNION ALL SELECT 'bronze', 'bronze_trades', 'rows_read', count(*) + count(*) FILTER (WHERE TradeID NOT LIKE 'E%' AND {_MALFORMED}) FROM trades "
        f"UNION ALL SELECT 'bronze', 'bronze_trades', 'rows_malformed', count(*) FILTER (WHERE TradeID NOT LIKE 'E%' AND {_MALFORMED}) FROM trades "
        "UNION ALL SELECT 'bronze', 'bronze_trades', 'rows_with_type_errors', count(*) FILTER (WHERE TradeID LIKE 'E%') FROM trades "
        f"UNION ALL SELECT 'bronze', 'bronze_trades', 'rows_missing_required', count(*) FILTER (WHERE NOT ({_REQUIRED_OK})) FROM trades "
        "UNION ALL SELECT 'bronze', 'bronze_trades', 'rows_accepted', count(*) FROM bronze "
        "UNION ALL SELECT 'bronze', 'bronze_instruments', 'rows_read', count(*) FROM instruments "
        "UNION ALL SELECT 'bronze', 'bronze_instruments', 'rows_malformed', count(*) FILTER (WHERE InstrumentName IS NULL) FROM instruments "
        "UNION ALL SELECT 'bronze', 'bronze_instruments', 'rows_with_type_errors', count(*) FILTER (WHERE InstrumentType IS NULL) FROM instruments "
        "UNION ALL SELECT 'bronze', 'bronze_instruments', 'rows_missing_required', count(*) FILTER (WHERE InstrumentID IS NULL) FROM instruments "
        "UNION ALL SELECT 'bronze', 'bronze_instruments', 'rows_accepted', count(*) FILTER (WHERE InstrumentID IS NOT NULL) FROM instruments "
        "UNION ALL SELECT 'silver', 'silver_trades', 'rows_read', count(*) FROM normalized "
        "UNION ALL SELECT 'silver', 'silver_trades', 'invalid_currency', count(*) FILTER (WHERE Currency IS NULL) FROM normalized "
        "UNION ALL SELECT 'silver', 'silver_trades', 'rows_written', count(*) FROM silver "
        "UNION ALL SELECT 'silver', 'silver_trades', 'rows_rejected', count(*) FILTER (WHERE data_quality_status <> 'CLEANSED') FROM silver "
        "UNION ALL SELECT 'silver', 'silver_instruments', 'rows_written', count(*) FROM silver_instruments "
        "UNION ALL SELECT 'silver', 'silver_trades', 'duplicates_removed', (SELECT count(*) FROM normalized) - count(*) FROM silver "
        "UNION ALL SELECT 'gold', 'gold_trade_aggregates', 'groups', count(*) FROM groups "
        "UNION ALL SELECT 'gold', 'gold_trade_aggregates', 'groups_without_notional', count(*) FILTER (WHERE DailyNotional IS NULL) FROM groups "
        "UNION ALL SELECT 'gold', 'gold_counterparty_summary', 'rows_written', count(*) FROM totals "
        "UNION ALL SELECT 'gold', 'gold_trade_aggregates', 'rows_written', count(*) FILTER (WHERE DailyNotional IS NOT NULL) FROM groups"),
    "gold_partition_pruned_read": _sql(f"SELECT {_cols(GOLD_COLUMNS)} FROM daily WHERE TradeYear = {PRUNED_YEAR}"),
    "gold_summary_sorted": _sql("SELECT * FROM totals ORDER BY TotalNotional DESC NULLS LAST, Counterparty"),
    "bronze_csv_headers": _sql(
        f"SELECT {_cols(TRADE_BUSINESS_COLUMNS)}, 'landing_zone_csv' AS ingestion_source FROM bronze"),
    "bronze_instruments_inferred": (
        "SELECT CASE WHEN p_partkey % 3 = 0 THEN lpad(CAST(p_partkey AS VARCHAR), 12, '0') ELSE concat('P', p_partkey) END AS InstrumentID, "
        "p_name AS InstrumentName, p_size AS LotSize, p_partkey * 10000000000 AS Serial, p_retailprice AS ListPrice, "
        "p_partkey % 2 = 0 AS Listed, CAST(NULL AS VARCHAR) AS Remark, "
        "'InstrumentID string, InstrumentName string, LotSize int, Serial bigint, ListPrice double, Listed boolean, Remark string' AS Types FROM part"),
    "bronze_refusals": _sql(
        "SELECT 'trades csv' AS Landing, count(*) AS RowsRead, CAST(NULL AS VARCHAR) AS Refusal FROM trades "
        "UNION ALL SELECT 'trades parquet', count(*), NULL FROM trades "
        "UNION ALL SELECT 'instruments csv', count(*), NULL FROM instruments "
        "UNION ALL VALUES ('trades csv without TradeID', NULL, 'required field(s) [''TradeID''] missing from trades data'), "
        "('trades parquet without Currency, InstrumentID', NULL, 'required field(s) [''InstrumentID'', ''Currency''] missing from trades data'), "
        "('instruments csv without id', NULL, 'instrument identifier field missing from instruments data')"),
    "gold_summary_positions": _sql(
        "SELECT Counterparty, TotalNotional, CAST(row_number() OVER (ORDER BY TotalNotional DESC NULLS LAST, Counterparty) AS INTEGER) AS Position FROM totals"),
    "bronze_trades_csv": _sql(
        f"SELECT {_cols(TRADE_BUSINESS_COLUMNS)}, 'landing_zone_csv' AS ingestion_source FROM bronze"),
    "bronze_instruments_validated": _sql(
        "SELECT *, 'landing_zone_parquet' AS ingestion_source FROM instruments WHERE InstrumentID IS NOT NULL"),
    "run_silver_trades": _run_sql(f"SELECT {_cols(SILVER_COLUMNS)} FROM silver"),
    "run_gold_daily": _run_sql(f"SELECT {_cols(GOLD_COLUMNS)} FROM daily"),
    "run_gold_summary": _run_sql("SELECT * FROM ranked"),
    "run_parquet_source": f"WITH {_chain(testbed.TRADES_SQL, _RUN_ORDER)}\nSELECT {_cols(GOLD_COLUMNS)} FROM daily",
    "run_overwritten_by_path": _sql(f"SELECT {_cols(GOLD_COLUMNS)} FROM daily WHERE TradeYear < {PRUNED_YEAR}"),
    "run_month_removed": _sql(f"SELECT {_cols(GOLD_COLUMNS)} FROM daily WHERE TradeYear < {PRUNED_YEAR}"),
}
# The run's reports: the same statements over the run's landing lines.
for _run, _plain in (("run_gold_period_rollup", "gold_period_rollup"), ("run_gold_running_notional", "gold_running_notional"),
                     ("run_gold_trade_counts", "gold_trade_counts_cube")):
    ORACLE_SQL[_run] = _run_sql(ORACLE_SQL[_plain].split(_BASE + "\n", 1)[1])
