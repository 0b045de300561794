"""Joins on hot keys, dated rates, mergeable sketches, top k by heaps."""

import bisect
import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from settleframe.operators.enrichment import convert_to_usd_as_of, enrich_trades, rates_as_of
from settleframe.operators.ranking import top_ranked
from settleframe.operators.sketches import DISTINCT_ERROR, RANK_ERROR, daily_sketches, period_statistics
from settleframe.operators.skew import hot_values, join_skewed


def _busiest_read(spark, folder, group):
    """Most shuffle rows that one task of a job group read."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    stages, read = set(), {}
    for root, _, names in os.walk(folder):
        for name in names:
            if not name.startswith(("events_", "local-")):
                continue
            with open(os.path.join(root, name)) as lines:
                for line in lines:
                    ev = json.loads(line)
                    if ev["Event"] == "SparkListenerJobStart" and ev.get("Properties", {}).get("spark.jobGroup.id") == group:
                        stages.update(ev["Stage IDs"])
                    elif ev["Event"] == "SparkListenerTaskEnd":
                        n = ev.get("Task Metrics", {}).get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                        read[ev["Stage ID"]] = max(read.get(ev["Stage ID"], 0), n)
    return max(n for s, n in read.items() if s in stages)


@pytest.fixture
def shuffled(spark):
    """Neither broadcasts of the sides nor help from adaptive skew handling."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _hot_trades(spark, n):
    i = F.col("id")
    return spark.range(0, n, 1, 6).select(
        F.concat(F.lit("T"), i).alias("TradeID"),
        F.when(i % 3 == 0, "HOT").when(i % 30 == 1, F.lit(None).cast("string")).otherwise(F.concat(F.lit("I"), i % 500)).alias("InstrumentID"))


def _instruments(spark):
    ids = spark.range(400).select(F.concat(F.lit("I"), "id").alias("InstrumentID")).unionByName(
        spark.createDataFrame([("HOT",), (None,)], "InstrumentID string"))
    return ids.select("*", *(F.concat(F.lit(c), "InstrumentID").alias(c) for c in ("InstrumentType", "InstrumentName", "Ticker", "Exchange")))


def test_hot_instrument_is_spread_over_tasks(spark, shuffled, event_log_dir):
    n = 60_000
    trades, instruments = _hot_trades(spark, n), _instruments(spark)
    sc = spark.sparkContext
    for group, df in (("plain-join", trades.join(instruments, "InstrumentID", "left")), ("spread-join", enrich_trades(trades, instruments))):
        sc.setJobGroup(group, group)
        try:
            df.write.format("noop").mode("overwrite").save()
        finally:
            sc.setJobGroup("", "")
    assert _busiest_read(spark, str(event_log_dir), "plain-join") > n // 3
    assert _busiest_read(spark, str(event_log_dir), "spread-join") < n // 6
    assert {r.InstrumentID for r in hot_values(trades, "InstrumentID").collect()} >= {"HOT"}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, shuffled, how):
    trades, instruments = _hot_trades(spark, 3000), _instruments(spark)
    instruments = instruments.unionByName(instruments.filter("InstrumentID = 'HOT' or InstrumentID = 'I7'"))   # two rows match
    a, b = join_skewed(trades, instruments, "InstrumentID", how), trades.join(instruments, "InstrumentID", how)
    assert a.columns == b.columns and a.exceptAll(b).isEmpty() and a.count() == b.count()


def test_rates_as_of_against_plain_search(spark):
    rnd, start = random.Random(8), dt.date(2024, 1, 1)
    day = lambda: start + dt.timedelta(days=rnd.randrange(400))
    rates = {(c, day()): rnd.uniform(0.1, 2) for c in ("USD", "EUR", "CHF") for _ in range(20)}
    asked = {(rnd.choice(["USD", "EUR", "CHF", "JPY"]), day()) for _ in range(500)} | set(list(rates)[:10])
    days = spark.createDataFrame([*asked, *asked, (None, start), ("EUR", None)], "Currency string, d date")
    table = spark.createDataFrame([(c.lower(), d, r) for (c, d), r in rates.items()] + [("EURO", start, 9.0), ("EUR", None, 9.0), ("EUR", start, None)],
                                  "Currency string, RateDate date, Rate double")
    got = {(r.Currency, r.d): r.Rate for r in rates_as_of(days, table, "d").collect()}

    def plain(code, d):
        own = sorted(k[1] for k in rates if k[0] == code)
        i = bisect.bisect_right(own, d)
        return rates[code, own[i - 1]] if i else None

    assert got == {k: plain(*k) for k in asked}


def test_convert_as_of(spark):
    trades = spark.createDataFrame([("T1", 10.0, "EUR", dt.date(2024, 1, 5)), ("T2", 10.0, "EUR", dt.date(2024, 1, 4)), ("T3", 10.0, "EUR", dt.date(2023, 1, 1)),
                                    ("T4", 10.0, None, dt.date(2024, 1, 5)), ("T5", None, "EUR", dt.date(2024, 1, 5)), ("T6", 10.0, "EUR", None)],
                                   "TradeID string, Notional double, Currency string, TradeDateYYYYMMDD date")
    rates = spark.createDataFrame([("EUR", "2024-01-05", 1.2), ("EUR", "2024-01-01", 1.1)], "Currency string, RateDate string, Rate double")
    got = {r.TradeID: r.NotionalUSD for r in convert_to_usd_as_of(trades, rates).collect()}
    assert got == {"T1": 12.0, "T2": 11.0, "T3": None, "T4": None, "T5": None, "T6": None}
    twice = rates.unionByName(spark.createDataFrame([("eur", "2024-01-05", 1.3)], rates.schema))
    with pytest.raises(Exception, match="two different FX rates for EUR on 2024-01-05"):
        convert_to_usd_as_of(trades, twice).collect()


def test_sketches_unite_to_periods(spark):
    i = F.col("id")
    trades = spark.range(0, 120_000, 1, 4).select(
        F.when(i % 2 == 0, "A").alias("Counterparty"), F.date_add(F.lit("2024-01-01").cast("date"), (i % 90).cast("int")).alias("TradeDateYYYYMMDD"),
        F.concat(F.lit("I"), F.when(i % 2 == 0, i % 9000).otherwise(i)).alias("InstrumentID"),
        F.when(i % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("C"), i % 5)).alias("Currency"),
        F.when(i % 11 == 0, F.lit(None)).otherwise((i * 7919 % 100_003).cast("double")).alias("Notional"))
    rows = {(r.Counterparty, r.PeriodLevel, r.TradeMonth): r for r in period_statistics(daily_sketches(trades)).collect()}
    assert len(rows) == 2 * (1 + 3)
    exact = rows["A", "YEAR", None]
    assert (exact.UniqueInstruments, exact.UniqueCurrencies) == (4500, 5)            # below 2**14: exact
    many = rows[None, "YEAR", None].UniqueInstruments
    assert abs(many / 60_000 - 1) < DISTINCT_ERROR
    for cp in ("A", None):
        own = sorted(r.Notional for r in trades.filter(F.col("Counterparty").eqNullSafe(cp) & F.col("Notional").isNotNull()).collect())
        r = rows[cp, "YEAR", None]
        assert r.PricedTrades == len(own)
        for q, value in ((0.5, r.MedianTradeSize), (0.95, r.TradeSize95)):
            assert bisect.bisect_left(own, value) / len(own) - RANK_ERROR <= q <= bisect.bisect_right(own, value) / len(own) + RANK_ERROR
    none = spark.createDataFrame([("A", dt.date(2024, 1, 1), None, None, None)],
                                 "Counterparty string, TradeDateYYYYMMDD date, InstrumentID string, Currency string, Notional double")
    r = period_statistics(daily_sketches(none)).filter("PeriodLevel = 'YEAR'").first()
    assert (r.UniqueInstruments, r.UniqueCurrencies, r.PricedTrades, r.MedianTradeSize) == (0, 0, 0, None)


def test_top_k_keeps_hot_ties_without_a_full_rank(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 50.0).otherwise((F.col("id") % 53).cast("double")).alias("v"))
    top = top_ranked(df, "v", 100)
    values = sorted((r.v for r in df.collect()), reverse=True)
    expected = {r.id: values.index(r.v) + 1 for r in df.collect() if values.index(r.v) + 1 <= 100}
    assert {r.id: r["rank"] for r in top.collect()} == expected and len(expected) > 1000
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan
