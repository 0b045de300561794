"""Silver layer: currency normalization, deduplication, timestamps, and the
whole silver transform."""

import datetime as dt

from pyspark.sql import functions as F

from settleframe.plans.silver import cleanse_trades, latest_trades, with_normalized_currency, with_standard_timestamps


def test_codes_that_are_no_currency_become_null_and_stay(trades):
    rows = with_normalized_currency(trades).select("TradeID", "Currency").collect()
    assert sorted((r.TradeID, r.Currency or "-") for r in rows) == [
        ("LN-10", "USD"), ("LN-11", "JPY"), ("LN-12", "-"), ("LN-7", "CHF"), ("LN-7", "CHF"), ("LN-8", "USD"), ("LN-9", "USD")]


def test_corrected_copy_wins_a_tie(trades):
    """Both copies carry the same stamp; the greater notional decides."""
    (kept,) = [r for r in latest_trades(trades).collect() if r.TradeID == "LN-7"]
    assert (kept.Notional, kept.Status) == (812.5, "SETTLED")


def test_dedup_keeps_latest_ingestion(spark):
    rows = [("T1", "I1", "A", 1.0, "USD", dt.datetime(2023, 1, 1), "old"),
            ("T1", "I1", "A", 2.0, "USD", dt.datetime(2023, 1, 2), "new"),
            ("T1", "I1", "A", 3.0, "USD", None, "none")]
    df = spark.createDataFrame(rows, "TradeID string, InstrumentID string, Counterparty string, Notional double, "
                                     "Currency string, ingestion_timestamp timestamp, Status string")
    assert [r.Status for r in latest_trades(df).collect()] == ["new"]


def test_dedup_tie_break_is_deterministic(spark, trades):
    """Equal ingestion stamps: the survivor does not depend on input order or partitioning."""
    rows = [("T9", "I1", "A", 5.0, "USD", "SETTLED"), ("T9", "I1", "A", 7.0, "USD", "SETTLED"),
            ("T9", "I1", "B", 1.0, "USD", "PENDING"), ("T9", "I1", None, 9.0, "USD", "PENDING")]
    schema = "TradeID string, InstrumentID string, Counterparty string, Notional double, Currency string, Status string"
    df = spark.createDataFrame(rows, schema).withColumn("ingestion_timestamp", F.lit(dt.datetime(2023, 1, 1)))
    seen = set()
    for seed in range(4):
        shuffled = df.orderBy(F.rand(seed)).repartition(3)
        seen.add(tuple(latest_trades(shuffled).first()))
    assert len(seen) == 1
    # Counterparty desc nulls last: 'B' beats 'A' and null.
    assert next(iter(seen))[2] == "B"


def test_dates_follow_timestamps(trades):
    rows = {(r.TradeID, r.Notional): r for r in with_standard_timestamps(trades).collect()}
    assert rows["LN-10", 3250000.125].TradeDateYYYYMMDD == dt.date(2024, 4, 1)
    assert rows["LN-7", 812.5].SettlementDateYYYYMMDD == dt.date(2024, 4, 2)
    assert rows["LN-9", None].SettlementDate is None and rows["LN-9", None].SettlementDateYYYYMMDD is None
    assert {type(r.ingestion_timestamp) for r in rows.values()} == {dt.datetime}


def test_text_timestamps_parse_or_null(spark):
    df = spark.createDataFrame([("T1", "2023-01-15 09:30:00", "nope")], "TradeID string, TradeDate string, "
                                                                         "SettlementDate string")
    row = with_standard_timestamps(df).first()
    assert row.TradeDate == dt.datetime(2023, 1, 15, 9, 30)
    assert row.SettlementDate is None and row.SettlementDateYYYYMMDD is None


def test_cleansed_rows_in_full(trades):
    out = cleanse_trades(trades)
    assert out.select("TradeID", "InstrumentID", "Notional", "Currency", "TradeDateYYYYMMDD", "data_quality_status") \
        .orderBy("TradeID").collect() == [
            ("LN-10", "ZZ-01", 3250000.125, "USD", dt.date(2024, 4, 1), "CLEANSED"),
            ("LN-11", "XS-88", -1000.0, "JPY", dt.date(2024, 4, 2), "CLEANSED"),
            ("LN-12", "XS-31", 812.5, None, dt.date(2024, 3, 28), "CLEANSED"),
            ("LN-7", "XS-88", 812.5, "CHF", dt.date(2024, 3, 28), "CLEANSED"),
            ("LN-8", "XS-12", 40000.0, "USD", dt.date(2024, 3, 28), "CLEANSED"),
            ("LN-9", "XS-12", None, "USD", dt.date(2024, 4, 1), "CLEANSED")]
    assert out.filter("silver_processing_timestamp is null").isEmpty()


def test_strict_quality_marks_rule_failures(spark):
    rows = [("T1", "I1", "A", 10.0, "USD"), ("T2", "I1", "A", -5.0, "USD"), ("T3", "I1", "A", None, "usd"),
            ("T4", "I1", "A", 1.0, "US")]
    df = spark.createDataFrame(rows, "TradeID string, InstrumentID string, Counterparty string, Notional double, "
                                     "Currency string")
    df = df.withColumns({"TradeDate": F.lit(dt.datetime(2023, 1, 2)), "SettlementDate": F.lit(None).cast("timestamp")})
    rules = {"required_fields": ["TradeID", "Notional"], "notional_min": 0, "currency_length": 3}
    out = {r.TradeID: r for r in cleanse_trades(df, rules, strict=True).collect()}
    assert out["T1"].data_quality_status == "CLEANSED" and out["T1"].failed_rules == []
    assert out["T2"].failed_rules == ["notional_min"]
    assert out["T3"].failed_rules == ["required:Notional"]
    assert out["T4"].failed_rules == ["currency_length"]
    assert {out[k].data_quality_status for k in ["T2", "T3", "T4"]} == {"REJECTED"}


def test_dedup_hot_trade_id(spark):
    """One TradeID holds a third of all rows: exactly one survivor, the latest."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("T"), F.col("id").cast("string")))
         .alias("TradeID"),
        F.lit("I1").alias("InstrumentID"), F.lit("A").alias("Counterparty"),
        F.col("id").cast("double").alias("Notional"), F.lit("USD").alias("Currency"),
        F.timestamp_seconds(F.col("id")).alias("ingestion_timestamp"),
    ).repartition(6)
    out = latest_trades(df)
    assert out.count() == 1 + n - n // 3
    hot = out.filter(F.col("TradeID") == "HOT").collect()
    assert len(hot) == 1 and hot[0].Notional == float(n - 3)  # the largest id with id % 3 == 0


def test_dedup_matches_plain_model(spark):
    """Random copies with ties and nulls: survivor = max by (stamp, business
    columns), each descending with nulls last; same on any partitioning."""
    import random

    rnd = random.Random(3)
    stamps = [None, dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 2)]
    rows = []
    for t in range(60):
        for _ in range(rnd.randint(1, 5)):
            rows.append((f"T{t}", rnd.choice(["I1", "I2", None]), rnd.choice(["A", "B", None]),
                         rnd.choice([1.0, 2.0, None]), rnd.choice(["USD", "EUR", None]),
                         rnd.choice(stamps)))
    schema = ("TradeID string, InstrumentID string, Counterparty string, Notional double, Currency string, "
              "ingestion_timestamp timestamp")

    def sort_key(r):
        # descending, nulls last == ascending on (is_not_null, value) reversed
        order = [r[5], r[1], r[2], r[3], r[4]]
        return tuple((v is not None, v if v is not None else 0) for v in order)

    expected = {}
    for r in rows:
        if r[0] not in expected or sort_key(r) > sort_key(expected[r[0]]):
            expected[r[0]] = r
    df = spark.createDataFrame(rows, schema)
    for seed in (1, 2):
        out = latest_trades(df.orderBy(F.rand(seed)).repartition(5))
        got = {r.TradeID: (r.TradeID, r.InstrumentID, r.Counterparty, r.Notional, r.Currency, r.ingestion_timestamp)
               for r in out.collect()}
        assert got == expected
