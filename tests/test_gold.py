"""Gold layer on the fixture trades: exact expected values."""

import datetime as dt

from settleframe.plans.gold import counterparty_summary, sorted_summary, trade_aggregates
from settleframe.plans.silver import cleanse_trades

MAR28, APR1, APR2 = dt.date(2024, 3, 28), dt.date(2024, 4, 1), dt.date(2024, 4, 2)
HARBOUR, OSTRAVA = "Harbour Trust", "Ostrava Bank"


def test_daily_aggregates_exact(trades):
    gold = trade_aggregates(cleanse_trades(trades))
    got = {(r.Counterparty, r.TradeDateYYYYMMDD): r for r in gold.collect()}
    # (notional, count, avg, largest, smallest, instruments, currencies, usd, category, day of week, month, quarter)
    expected = {
        (HARBOUR, MAR28): (1625.0, 2, 812.5, 812.5, 812.5, 2, 1, None, "SMALL", 5, "March", 1),
        (None, MAR28): (40000.0, 1, 40000.0, 40000.0, 40000.0, 1, 1, 40000.0, "SMALL", 5, "March", 1),
        (OSTRAVA, APR1): (3250000.125, 2, 3250000.125, 3250000.125, 3250000.125, 2, 1, 3250000.125, "MEDIUM", 2, "April", 2),
        (OSTRAVA, APR2): (-1000.0, 1, -1000.0, -1000.0, -1000.0, 1, 1, None, "SMALL", 3, "April", 2),
    }
    assert set(got) == set(expected)
    for key, exp in expected.items():
        r = got[key]
        assert (r.DailyNotional, r.TradeCount, r.AverageTradeSize, r.LargestTradeSize, r.SmallestTradeSize,
                r.UniqueInstruments, r.UniqueCurrencies, r.NotionalUSD, r.TradeVolumeCategory,
                r.TradeDayOfWeek, r.TradeMonthName, r.TradeQuarter) == exp
        assert (r.TradeYear, r.TradeMonth) == (key[1].year, key[1].month)
        assert r.aggregation_level == "COUNTERPARTY_DATE"
        assert r.gold_processing_timestamp is not None


def test_counterparty_summary_exact(trades):
    rows = {r.Counterparty: r for r in counterparty_summary(cleanse_trades(trades)).collect()}
    expected = {
        OSTRAVA: (3, 3249000.125, 1624500.0625, APR1, APR2, 3, 2, 1),
        None: (1, 40000.0, 40000.0, MAR28, MAR28, 1, 1, 2),
        HARBOUR: (2, 1625.0, 812.5, MAR28, MAR28, 2, 1, 3),
    }
    assert set(rows) == set(expected)
    for cp, exp in expected.items():
        r = rows[cp]
        assert (r.TotalTrades, r.TotalNotional, r.AverageTradeSize, r.FirstTradeDate, r.LastTradeDate,
                r.UniqueInstrumentsTraded, r.CurrenciesTraded, r.NotionalRank) == exp


def test_summary_is_sorted_for_presentation(trades):
    out = sorted_summary(counterparty_summary(cleanse_trades(trades)))
    assert [r.Counterparty for r in out.collect()] == [OSTRAVA, None, HARBOUR]


def test_no_expand_for_distinct_counts(trades):
    """Two exact counts, one distinct aggregate: no row is tripled."""
    silver = cleanse_trades(trades)
    for df in (trade_aggregates(silver), counterparty_summary(silver, rank=False)):
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_groups_without_notional_are_dropped(spark):
    rows = [("T1", "I1", "A", None, "USD", dt.datetime(2023, 1, 2), None, "SETTLED"),
            ("T2", "I1", "B", 5.0, "USD", dt.datetime(2023, 1, 2), None, "SETTLED")]
    df = spark.createDataFrame(rows, "TradeID string, InstrumentID string, Counterparty string, Notional double, "
                                     "Currency string, TradeDate timestamp, SettlementDate timestamp, Status string")
    gold = trade_aggregates(cleanse_trades(df))
    assert [r.Counterparty for r in gold.collect()] == ["B"]
