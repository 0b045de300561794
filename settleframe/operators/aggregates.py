"""Business aggregates: exact sums and distinct counts by plain hash aggregates, each
with partial aggregation before the shuffle (``operators.money``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleframe.functions.columns import time_dimensions, volume_category
from settleframe.operators.money import exact_sums


_PRICED = "__priced"  # trades with a notional


DAILY_OUTPUT = ["Counterparty", "TradeDateYYYYMMDD", "DailyNotional", "TradeCount", "AverageTradeSize",
                "LargestTradeSize", "SmallestTradeSize", "UniqueInstruments", "UniqueCurrencies", "NotionalUSD"]
SUMMARY_OUTPUT = ["Counterparty", "TotalTrades", "TotalNotional", "AverageTradeSize", "FirstTradeDate",
                  "LastTradeDate", "UniqueInstrumentsTraded", "CurrenciesTraded"]


def _with_average(df: DataFrame, total: str) -> DataFrame:
    """Average trade size = exact total / trades with a notional (null if none),
    computed after the aggregate so the sum is aggregated once."""
    return df.withColumn("AverageTradeSize", F.when(F.col(_PRICED) > 0, F.col(total) / F.col(_PRICED)))


def daily_metrics(df: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per (Counterparty, TradeDateYYYYMMDD). A null counterparty or
    date is a group of its own.

    NotionalUSD sums the notional of the group's USD trades only (null when
    the group has none). Groups whose notionals are all null are dropped
    unless ``keep_empty``.
    """
    out = exact_sums(df, ["Counterparty", "TradeDateYYYYMMDD"], "Notional",
                     {"DailyNotional": None, "NotionalUSD": F.col("Currency") == "USD"}, {
        "TradeCount": ("count", "TradeID"),
        _PRICED: ("count", "Notional"),
        "LargestTradeSize": ("max", "Notional"),
        "SmallestTradeSize": ("min", "Notional"),
    }, {"UniqueInstruments": "InstrumentID", "UniqueCurrencies": "Currency"})
    out = _with_average(out, "DailyNotional").select(*DAILY_OUTPUT)
    if not keep_empty:
        out = out.filter(F.col("DailyNotional").isNotNull())
    return out


def with_volume_category(df: DataFrame, amount: str = "DailyNotional",
                         out: str = "TradeVolumeCategory") -> DataFrame:
    return df.withColumn(out, volume_category(amount))


def with_time_dimensions(df: DataFrame, date_col: str = "TradeDateYYYYMMDD") -> DataFrame:
    return df.withColumns(time_dimensions(date_col))


def counterparty_totals(df: DataFrame) -> DataFrame:
    """One row per counterparty (null counterparty included)."""
    out = exact_sums(df, ["Counterparty"], "Notional", {"TotalNotional": None}, {
        "TotalTrades": ("count", "TradeID"),
        _PRICED: ("count", "Notional"),
        "FirstTradeDate": ("min", "TradeDateYYYYMMDD"),
        "LastTradeDate": ("max", "TradeDateYYYYMMDD"),
    }, {"UniqueInstrumentsTraded": "InstrumentID", "CurrenciesTraded": "Currency"})
    return _with_average(out, "TotalNotional").select(*SUMMARY_OUTPUT)
