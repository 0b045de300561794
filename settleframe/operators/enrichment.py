"""Reference-data joins: instruments and FX rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settleframe.functions.columns import normalize_currency
from settleframe.operators.dedup import keep_latest
from settleframe.operators.money import exact_sums, with_cents_product
from settleframe.operators.skew import join_skewed
from settleframe.schemas import INSTRUMENT_FIELDS


def latest_instruments(bronze_instruments: DataFrame) -> DataFrame:
    """Silver instruments: one row per InstrumentID, latest ingestion first,
    remaining ties broken on every attribute (deterministic)."""
    order = ["ingestion_timestamp"] if "ingestion_timestamp" in bronze_instruments.columns else []
    cols = INSTRUMENT_FIELDS + order
    return keep_latest(bronze_instruments.select(*cols), "InstrumentID", order, INSTRUMENT_FIELDS[1:]) \
        .select(*INSTRUMENT_FIELDS)


def enrich_trades(trades: DataFrame, instruments: DataFrame) -> DataFrame:
    """Trades with instrument attributes; trades without a match keep nulls.

    Instruments are not assumed small: the planner (AQE) broadcasts them only
    when their runtime size is under ``spark.sql.autoBroadcastJoinThreshold``
    and otherwise sort-merge joins; the trades of hot instruments are spread.
    """
    return join_skewed(trades, instruments.select(*INSTRUMENT_FIELDS), "InstrumentID", "left")


def orphan_trades(trades: DataFrame, instruments: DataFrame) -> DataFrame:
    """Trades whose InstrumentID has no instrument row (anti join)."""
    return join_skewed(trades, instruments.select("InstrumentID"), "InstrumentID", "left_anti")


def fx_rates(rates: DataFrame, currency: str = "Currency", rate: str = "Rate") -> DataFrame:
    """Clean a caller-supplied ``(Currency, Rate)`` table: codes normalized,
    invalid codes dropped, one row per code. A code listed with two different
    rates is an error raised when the rates are read: pick an as-of date first.

    Size bound: at most 26^3 = 17,576 three-letter codes, so this side is
    always safe to broadcast.
    """
    conflict = F.concat(F.lit("two different FX rates for "), F.col("Currency"))
    return (rates.select(normalize_currency(currency).alias("Currency"), F.col(rate).cast("double").alias("Rate"))
            .filter(F.col("Currency").isNotNull() & F.col("Rate").isNotNull())
            .groupBy("Currency").agg(F.min("Rate").alias("Rate"), F.max("Rate").alias("__top"))
            .withColumn("Rate", F.when(F.col("Rate") == F.col("__top"), F.col("Rate"))
                        .otherwise(F.raise_error(conflict).cast("double")))
            .drop("__top"))


def convert_to_usd(trades: DataFrame, rates: DataFrame, out: str = "NotionalUSD") -> DataFrame:
    """Add ``out`` = Notional x rate to USD, rounded half-up to the cent: all digits of
    both are multiplied, whatever their size. NaN and infinities follow the rules of
    doubles. Each row is converted by itself, so results do not depend on row order.
    Unknown currency or missing rate -> null; no rate is invented.
    """
    r = F.broadcast(fx_rates(rates).withColumnRenamed("Rate", "__rate"))
    return with_cents_product(trades.join(r, "Currency", "left"), "Notional", "__rate", out).drop("__rate")


def rates_as_of(days: DataFrame, rates: DataFrame, date_col: str, currency: str = "Currency", rate: str = "Rate",
                rate_date: str = "RateDate") -> DataFrame:
    """For each (Currency, ``date_col``) in ``days``, the rate of the latest date up to it:
    (Currency, ``date_col``, Rate), null if there is none yet. Codes are normalized; two
    different rates of a code on one day are an error raised when the rates are read.

    Rates and days are merged by code and date and the last rate is carried on. Days are
    distinct (a code's run has at most two rows per calendar day, however many
    trades there are), so no code is a large task."""
    conflict = F.concat(F.lit("two different FX rates for "), F.col("Currency"), F.lit(" on "), F.col(date_col).cast("string"))
    known = (rates.select(normalize_currency(currency).alias("Currency"), F.to_date(rate_date).alias(date_col), F.col(rate).cast("double").alias("Rate"))
             .filter(F.col("Currency").isNotNull() & F.col("Rate").isNotNull() & F.col(date_col).isNotNull())
             .groupBy("Currency", date_col).agg(F.min("Rate").alias("Rate"), F.max("Rate").alias("__top"))
             .withColumn("Rate", F.when(F.col("Rate") == F.col("__top"), F.col("Rate")).otherwise(F.raise_error(conflict).cast("double")))
             .drop("__top"))
    asked = days.select("Currency", date_col).filter(F.col("Currency").isNotNull() & F.col(date_col).isNotNull()).distinct()
    both = (known.withColumn("__asked", F.lit(0))
            .unionByName(asked.withColumns({"Rate": F.lit(None).cast("double"), "__asked": F.lit(1)})))
    run = Window.partitionBy("Currency").orderBy(date_col, "__asked").rowsBetween(Window.unboundedPreceding, 0)
    return (both.withColumn("Rate", F.last("Rate", ignorenulls=True).over(run)).filter("__asked = 1").drop("__asked"))


def convert_to_usd_as_of(trades: DataFrame, rates: DataFrame, date_col: str = "TradeDateYYYYMMDD", out: str = "NotionalUSD") -> DataFrame:
    """``convert_to_usd`` with dated rates (Currency, RateDate, Rate): each trade at the
    rate of its own day or the latest before. A code's hot days are spread by AQE or
    avoided by a broadcast; the other side has one row per code and day."""
    found = rates_as_of(trades, rates, date_col).withColumnRenamed("Rate", "__rate")
    return with_cents_product(trades.join(found, ["Currency", date_col], "left"), "Notional", "__rate", out).drop("__rate")


def daily_usd_notional(converted: DataFrame, amount: str = "NotionalUSD") -> DataFrame:
    """Per (Counterparty, day): USD notional of the priced trades;
    ``UnpricedTrades`` counts trades with a notional but no rate."""
    return exact_sums(converted, ["Counterparty", "TradeDateYYYYMMDD"], amount, {amount: None}, {
        "UnpricedTrades": ("count", F.when(F.col("Notional").isNotNull() & F.col(amount).isNull(), F.lit(1)))})
