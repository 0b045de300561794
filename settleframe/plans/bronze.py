"""Bronze: landing files -> one classified table per source.

The landing files are parsed once. Accepted and quarantined rows leave in
the same write, split into ``record_status=...`` partition directories, so
the silver read prunes to ``ACCEPTED`` files and the quarantine is a
partition of the same table (no second parse, no cache).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from settleframe.config import PipelineConfig
from settleframe.operators.metrics import MetricsLog, count_rows
from settleframe.operators.validation import (
    ACCEPTED,
    MALFORMED,
    MISSING_REQUIRED,
    classify_records,
    rename_alias,
    require_columns,
)
from settleframe.schemas import CORRUPT_COLUMN, INSTRUMENT_FIELDS, PROBLEM_COLUMN, TRADE_REQUIRED
from settleframe.sources.readers import read_instruments, read_table, read_trades
from settleframe.sources.sinks import write_table

STATUS_COLUMNS = ["record_status", "reject_reason", CORRUPT_COLUMN]


def stamp_ingestion(df: DataFrame, source: str, batch_id: str | None = None,
                    ingested_at: Column | None = None) -> DataFrame:
    """Ingestion metadata: time, source label and (optionally) the run's batch id."""
    cols = {
        "ingestion_timestamp": ingested_at if ingested_at is not None else F.current_timestamp(),
        "ingestion_source": F.lit(source),
    }
    if batch_id is not None:
        cols["processing_batch_id"] = F.lit(batch_id)
    return df.withColumns(cols)


def ingest_trades(spark: SparkSession, path: str, fmt: str = "json", schema=None,
                  batch_id: str | None = None, ingested_at: Column | None = None) -> DataFrame:
    """Parsed, classified and stamped trades (all rows, with ``record_status``)."""
    raw = read_trades(spark, path, fmt, schema)
    require_columns(raw, TRADE_REQUIRED, "trades data")
    classified = classify_records(raw, TRADE_REQUIRED)
    return stamp_ingestion(classified, f"landing_zone_{fmt}", batch_id, ingested_at)


def ingest_instruments(spark: SparkSession, path: str, fmt: str = "csv", infer_schema: bool = False,
                       ingested_at: Column | None = None) -> DataFrame:
    raw = read_instruments(spark, path, fmt, infer_schema)
    if "InstrumentID" not in raw.columns and "instrument_id" not in raw.columns:
        if PROBLEM_COLUMN not in raw.columns:
            raise ValueError("instrument identifier field missing from instruments data")
        raw = raw.withColumn("InstrumentID", F.lit(None).cast("string"))   # all of it goes to quarantine
    df = rename_alias(raw, "instrument_id", "InstrumentID")
    df = df.withColumns({c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
                         for c in INSTRUMENT_FIELDS if infer_schema and c == "InstrumentID" or c not in df.columns})
    return stamp_ingestion(classify_records(df, ["InstrumentID"]), f"landing_zone_{fmt}", None, ingested_at)


def accepted(bronze: DataFrame) -> DataFrame:
    """Rows that passed bronze validation, without the status columns."""
    keep = [c for c in bronze.columns if c not in STATUS_COLUMNS]
    return bronze.filter(F.col("record_status") == ACCEPTED).select(*keep)


def quarantined(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("record_status") != ACCEPTED)


def _status_metrics() -> dict[str, Column]:
    status = F.col("record_status")
    return {
        "rows_read": count_rows(),
        "rows_malformed": F.count_if(status == MALFORMED),
        "rows_missing_required": F.count_if(status == MISSING_REQUIRED),
        "rows_accepted": F.count_if(status == ACCEPTED),
        "rows_with_type_errors": F.count_if((status == ACCEPTED) & F.col(CORRUPT_COLUMN).isNotNull()),
    }


def run_bronze(spark: SparkSession, cfg: PipelineConfig, batch_id: str, log: MetricsLog,
               ingested_at: Column | None = None) -> None:
    """Write ``bronze_trades`` and ``bronze_instruments`` (two actions)."""
    t = cfg.trades
    trades = ingest_trades(spark, t.source_path, t.source_format, cfg.trades_schema, batch_id, ingested_at)
    trades = log.observe(trades, "bronze", t.bronze_table, **_status_metrics())
    write_table(trades, cfg.table_path("bronze", t.bronze_table), cfg.table_format,
                partition_cols=["record_status"])

    i = cfg.instruments
    instruments = ingest_instruments(spark, i.source_path, i.source_format, ingested_at=ingested_at)
    instruments = log.observe(instruments, "bronze", i.bronze_table, **_status_metrics())
    write_table(instruments, cfg.table_path("bronze", i.bronze_table), cfg.table_format,
                partition_cols=["record_status"])
    log.collect()


def read_bronze(spark: SparkSession, cfg: PipelineConfig, table: str) -> DataFrame:
    return accepted(read_table(spark, cfg.table_path("bronze", table), cfg.table_format))


def read_quarantine(spark: SparkSession, cfg: PipelineConfig, table: str) -> DataFrame:
    """Rejected rows of a bronze table with their status, reason and raw text
    (a partition-pruned read of the non-ACCEPTED directories)."""
    return quarantined(read_table(spark, cfg.table_path("bronze", table), cfg.table_format))
