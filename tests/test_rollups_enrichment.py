"""Rollups, running totals, cube, FX conversion and instrument joins on the
fixture trades (expected values worked out by hand)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from settleframe.operators.aggregates import daily_metrics
from settleframe.operators.enrichment import (
    convert_to_usd,
    daily_usd_notional,
    enrich_trades,
    fx_rates,
    latest_instruments,
    orphan_trades,
)
from settleframe.operators.rollups import period_rollup, running_total, trade_counts_cube
from settleframe.plans.silver import cleanse_trades

MAR28, APR1, APR2 = dt.date(2024, 3, 28), dt.date(2024, 4, 1), dt.date(2024, 4, 2)
HARBOUR, OSTRAVA = "Harbour Trust", "Ostrava Bank"


@pytest.fixture
def silver(trades):
    return cleanse_trades(trades)


def test_period_rollup(silver):
    rows = period_rollup(silver).collect()
    assert len(rows) == 9  # 3 counterparties x (year, quarter, month)
    got = {(r.Counterparty, r.PeriodLevel): (r.TradeYear, r.TradeQuarter, r.TradeMonth, r.TradeCount, r.TotalNotional)
           for r in rows}
    assert got[(OSTRAVA, "YEAR")] == (2024, None, None, 3, 3249000.125)
    assert got[(OSTRAVA, "QUARTER")] == (2024, 2, None, 3, 3249000.125)
    assert got[(OSTRAVA, "MONTH")] == (2024, None, 4, 3, 3249000.125)
    assert got[(None, "MONTH")][3:] == (1, 40000.0)
    average = {(r.Counterparty, r.PeriodLevel): r.AverageTradeSize for r in rows}
    assert average[(OSTRAVA, "YEAR")] == 1624500.0625  # two of the three have a notional


def test_running_total(silver):
    daily = daily_metrics(silver, keep_empty=True)
    got = {(r.Counterparty, r.TradeDateYYYYMMDD): r.RunningNotional for r in running_total(daily).collect()}
    assert got == {(HARBOUR, MAR28): 1625.0, (None, MAR28): 40000.0, (OSTRAVA, APR1): 3250000.125,
                   (OSTRAVA, APR2): 3249000.125}


def test_trade_counts_cube(silver):
    rows = trade_counts_cube(silver).collect()
    total = [r for r in rows if r.grouping_id == 3]
    assert len(total) == 1 and total[0].TradeCount == 6 and total[0].TotalNotional == 3290625.125
    by_currency = {r.Currency: r.TradeCount for r in rows if r.grouping_id == 1}
    assert by_currency == {"USD": 3, "CHF": 1, "JPY": 1, None: 1}
    by_status = {r.Status: r.TradeCount for r in rows if r.grouping_id == 2}
    assert by_status == {"SETTLED": 5, "PENDING": 1}
    assert len([r for r in rows if r.grouping_id == 0]) == 5


def test_fx_rates_are_cleaned_and_bounded(spark):
    rates = spark.createDataFrame([("usd", 1.0), ("EUR", 1.2), (" eur", 1.2), ("EURO", 2.0), (None, 3.0),
                                   ("GBP", None)], "Currency string, Rate double")
    assert sorted(tuple(r) for r in fx_rates(rates).collect()) == [("EUR", 1.2), ("USD", 1.0)]


def test_two_rates_for_a_code_are_refused(spark, silver):
    rates = spark.createDataFrame([("USD", 1.0), ("CHF", 1.1), ("chf", 1.2)], "Currency string, Rate double")
    with pytest.raises(Exception, match="two different FX rates for CHF"):
        convert_to_usd(silver, rates).collect()


@pytest.mark.parametrize("notional, rate, usd", [
    (1e9, 0.0000394, 39400.0), (1e9, 0.0000615, 61500.0), (0.004, 1.0, 0.0), (0.125, 1.0, 0.13), (-0.125, 1.0, -0.13),
    (1234.56789, 1.0, 1234.57), (1e17, 2.0, 2e17), (2.0, 1e7, 2e7),
])
def test_small_rates_and_wide_values(spark, notional, rate, usd):
    df = spark.createDataFrame([("T", notional, "VND")], "TradeID string, Notional double, Currency string")
    rates = spark.createDataFrame([("VND", rate)], "Currency string, Rate double")
    assert convert_to_usd(df, rates).first().NotionalUSD == usd


def test_convert_to_usd(spark, silver):
    rates = spark.createDataFrame([("USD", 1.0), ("CHF", 1.1)], "Currency string, Rate double")
    converted = {r.TradeID: r.NotionalUSD for r in convert_to_usd(silver, rates).collect()}
    assert converted == {"LN-7": 893.75, "LN-8": 40000.0, "LN-9": None, "LN-10": 3250000.13, "LN-11": None, "LN-12": None}
    daily = {(r.Counterparty, r.TradeDateYYYYMMDD): (r.NotionalUSD, r.UnpricedTrades)
             for r in daily_usd_notional(convert_to_usd(silver, rates)).collect()}
    assert daily[(HARBOUR, MAR28)] == (893.75, 1)
    assert daily[(OSTRAVA, APR1)] == (3250000.13, 0)  # the other trade has no notional to price
    assert daily[(OSTRAVA, APR2)] == (None, 1)


def test_convert_rounds_to_cent(spark):
    df = spark.createDataFrame([("T", 123.45, "EUR")], "TradeID string, Notional double, Currency string")
    rates = spark.createDataFrame([("EUR", 1.1)], "Currency string, Rate double")
    assert convert_to_usd(df, rates).first().NotionalUSD == 135.8  # 135.795 rounds half up


def test_enrichment_and_orphans(silver, instruments):
    inst = latest_instruments(instruments)
    enriched = {r.TradeID: (r.InstrumentType, r.InstrumentName) for r in enrich_trades(silver, inst).collect()}
    tap, swap = ("Note", "Harbour 2031 (tap)"), ("Swap", "Three-month swap")
    assert enriched == {"LN-7": tap, "LN-8": swap, "LN-9": swap, "LN-10": (None, None), "LN-11": tap,
                        "LN-12": ("Share", "Vltava Energy")}
    assert [r.TradeID for r in orphan_trades(silver, inst).collect()] == ["LN-10"]


def test_enrichment_with_a_hot_instrument(spark):
    """A third of all trades on one instrument, sort-merge joined: same rows, nothing lost."""
    trades = spark.range(9000).select(F.concat(F.lit("T"), F.col("id").cast("string")).alias("TradeID"),
                                      F.when(F.col("id") % 3 == 0, F.lit("I0")).otherwise(
                                          F.concat(F.lit("I"), (F.col("id") % 400).cast("string"))).alias("InstrumentID"))
    inst = spark.range(300).select(F.concat(F.lit("I"), F.col("id").cast("string")).alias("InstrumentID"),
                                   *(F.lit(c).alias(c) for c in ("InstrumentType", "InstrumentName", "Ticker", "Exchange")))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        out = enrich_trades(trades, inst)
        assert out.count() == 9000 and out.filter("InstrumentID = 'I0' and Ticker is null").count() == 0
        assert orphan_trades(trades, inst).count() == out.filter("Ticker is null").count() > 0
    finally:
        spark.conf.set(key, before)


def test_latest_instruments_deterministic(spark):
    rows = [("I1", "Bond", "B", "X", "E", dt.datetime(2023, 1, 1)),
            ("I1", "Equity", "A", "Y", "E", dt.datetime(2023, 1, 2)),
            ("I1", "Option", "C", "Z", "E", dt.datetime(2023, 1, 2))]
    df = spark.createDataFrame(rows, "InstrumentID string, InstrumentType string, InstrumentName string, "
                                     "Ticker string, Exchange string, ingestion_timestamp timestamp")
    got = [tuple(r) for r in latest_instruments(df).collect()]
    assert got == [("I1", "Option", "C", "Z", "E")]


def test_convert_non_finite_falls_back_to_double(spark):
    df = spark.createDataFrame([("T1", float("nan"), "EUR"), ("T2", float("inf"), "EUR"), ("T3", None, "EUR")],
                               "TradeID string, Notional double, Currency string")
    rates = spark.createDataFrame([("EUR", 2.0)], "Currency string, Rate double")
    got = {r.TradeID: r.NotionalUSD for r in convert_to_usd(df, rates).collect()}
    assert got["T1"] != got["T1"]  # NaN stays NaN
    assert got["T2"] == float("inf") and got["T3"] is None
