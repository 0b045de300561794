"""Sketches that merge: distinct counts and size quantiles of periods from daily rows,
without reading trades again.

Distinct counts are theta sketches of 2**14 entries: exact up to that number, beyond it
within 2.4 % (three standard errors). Quantiles are KLL sketches with a rank error of
about 1 % at most. Sketches of a day are small when the day is; a period unites at
most its days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleframe.functions.columns import time_dimensions

THETA_BITS = 14      # exact up to 2**14 distinct values
KLL_K = 400          # rank error below 1 %
DISTINCT_ERROR, RANK_ERROR = 0.024, 0.01
KEYS = ["Counterparty", "TradeDateYYYYMMDD"]


def daily_sketches(trades: DataFrame) -> DataFrame:
    """Per counterparty and day: sketches of instruments, currencies and trade sizes."""
    return trades.groupBy(*KEYS).agg(
        F.theta_sketch_agg("InstrumentID", THETA_BITS).alias("InstrumentSketch"),
        F.theta_sketch_agg("Currency", THETA_BITS).alias("CurrencySketch"),
        F.kll_sketch_agg_double("Notional", KLL_K).alias("SizeSketch"))


def period_statistics(daily: DataFrame) -> DataFrame:
    """Per counterparty and year or month, from daily sketches: UniqueInstruments,
    UniqueCurrencies, PricedTrades, MedianTradeSize, TradeSize95 (null without a notional)."""
    calendar = time_dimensions("TradeDateYYYYMMDD")
    rows = daily.withColumns({c: calendar[c] for c in ("TradeYear", "TradeMonth")})
    united = rows.groupingSets([["Counterparty", "TradeYear"], ["Counterparty", "TradeYear", "TradeMonth"]],
                               "Counterparty", "TradeYear", "TradeMonth").agg(
        F.theta_union_agg("InstrumentSketch", THETA_BITS).alias("i"), F.theta_union_agg("CurrencySketch", THETA_BITS).alias("c"),
        F.kll_merge_agg_double("SizeSketch", KLL_K).alias("s"), F.grouping("TradeMonth").alias("g"))
    n = F.kll_sketch_get_n_double("s")
    quantile = lambda q: F.when(n > 0, F.kll_sketch_get_quantile_double(F.col("s"), F.lit(q)))
    return united.select("Counterparty", "TradeYear", "TradeMonth", F.when(F.col("g") == 1, "YEAR").otherwise("MONTH").alias("PeriodLevel"),
                         F.theta_sketch_estimate("i").alias("UniqueInstruments"), F.theta_sketch_estimate("c").alias("UniqueCurrencies"),
                         n.alias("PricedTrades"), quantile(0.5).alias("MedianTradeSize"), quantile(0.95).alias("TradeSize95"))
