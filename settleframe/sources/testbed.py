"""Trades and instruments derived from the benchmark star schema.

The shared test data has no trade table, so trades are a projection of
``lineitem`` (natural duplicate copies on order/line number) and instruments
a projection of ``part``. Notionals have up to five decimals and some are
negative; some instruments have no id, an id that no trade uses (so their trades
are orphans) or a second copy. ``TRADES_SQL`` and ``INSTRUMENTS_SQL`` are the same
mappings as text; they run unchanged in Spark SQL and DuckDB and are what the
oracle queries start from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The lineitem -> trade mapping (keys, modulus choices and
# currency spellings), the same in both engines.
TRADES_SQL = """SELECT concat(CAST(l_orderkey AS STRING),'-',CAST(l_linenumber AS STRING)) AS TradeID,
  concat('P',CAST(l_partkey AS STRING)) AS InstrumentID,
  CASE WHEN l_suppkey%50=49 THEN NULL ELSE concat('S',CAST(l_suppkey%7 AS STRING)) END AS Counterparty,
  CASE WHEN l_partkey%19=3 THEN NULL WHEN l_partkey%17=2 THEN -round(l_extendedprice*l_quantity,2)/8
    ELSE round(l_extendedprice*l_quantity,2)/8 END AS Notional,
  CASE l_partkey%8 WHEN 0 THEN 'usd' WHEN 1 THEN ' EUR ' WHEN 2 THEN 'gbp' WHEN 3 THEN 'USD'
    WHEN 4 THEN 'US' WHEN 5 THEN NULL WHEN 6 THEN 'jpy' ELSE 'US1' END AS Currency,
  l_shipdate AS TradeDate, l_shipdate + INTERVAL 2 DAY AS SettlementDate,
  CASE l_linestatus WHEN 'F' THEN 'SETTLED' ELSE 'PENDING' END AS Status,
  date_trunc('year', l_shipdate) AS ingestion_timestamp
FROM lineitem"""

INSTRUMENTS_SQL = """SELECT CASE WHEN p_partkey%40=3 THEN NULL WHEN p_partkey%10=0 THEN concat('Q',CAST(p_partkey AS STRING))
    ELSE concat('P',CAST(p_partkey AS STRING)) END AS InstrumentID,
  CASE WHEN copy=1 THEN concat(p_type,' II') ELSE p_type END AS InstrumentType, p_name AS InstrumentName, p_brand AS Ticker,
  CASE WHEN p_size < 20 THEN 'XNAS' ELSE 'XNYS' END AS Exchange
FROM part, (VALUES (0), (1)) AS copies(copy) WHERE copy=0 OR p_partkey%25=1"""

_CURRENCY_SPELLINGS = ["usd", " EUR ", "gbp", "USD", "US", None, "jpy", "US1"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trades(spark: SparkSession, sf_dir: str, with_ingestion_time: bool = True) -> DataFrame:
    """Trade rows (landing-zone shape) from ``lineitem``."""
    li = _table(spark, sf_dir, "lineitem")
    pk = F.col("l_partkey")
    currency = F.lit(_CURRENCY_SPELLINGS[-1])
    for i in range(len(_CURRENCY_SPELLINGS) - 2, -1, -1):
        currency = F.when(pk % 8 == i, F.lit(_CURRENCY_SPELLINGS[i])).otherwise(currency)
    cols = {
        "TradeID": F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")),
        "InstrumentID": F.concat(F.lit("P"), pk.cast("string")),
        "Counterparty": F.when(F.col("l_suppkey") % 50 == 49, F.lit(None).cast("string"))
                         .otherwise(F.concat(F.lit("S"), (F.col("l_suppkey") % 7).cast("string"))),
        "Notional": F.when(pk % 19 == 3, F.lit(None).cast("double"))
                     .when(pk % 17 == 2, -F.round(F.col("l_extendedprice") * F.col("l_quantity"), 2) / 8)
                     .otherwise(F.round(F.col("l_extendedprice") * F.col("l_quantity"), 2) / 8),
        "Currency": currency,
        "TradeDate": F.col("l_shipdate"),
        "SettlementDate": F.col("l_shipdate") + F.expr("INTERVAL 2 DAYS"),
        "Status": F.when(F.col("l_linestatus") == "F", F.lit("SETTLED")).otherwise(F.lit("PENDING")),
    }
    if with_ingestion_time:
        cols["ingestion_timestamp"] = F.date_trunc("year", F.col("l_shipdate"))
    return li.select(*[v.alias(k) for k, v in cols.items()])


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instrument rows (landing-zone shape) from ``part``."""
    key = F.col("p_partkey")
    p = _table(spark, sf_dir, "part").withColumn(
        "copy", F.explode(F.when(key % 25 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return p.select(
        F.when(key % 40 == 3, F.lit(None).cast("string"))
         .when(key % 10 == 0, F.concat(F.lit("Q"), key.cast("string")))
         .otherwise(F.concat(F.lit("P"), key.cast("string"))).alias("InstrumentID"),
        F.when(F.col("copy") == 1, F.concat("p_type", F.lit(" II"))).otherwise(F.col("p_type")).alias("InstrumentType"),
        F.col("p_name").alias("InstrumentName"),
        F.col("p_brand").alias("Ticker"),
        F.when(F.col("p_size") < 20, F.lit("XNAS")).otherwise(F.lit("XNYS")).alias("Exchange"),
    )
