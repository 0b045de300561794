"""Incremental bronze ingestion with Structured Streaming.

The same parse / classify / stamp as the batch bronze run, applied only to
landing files not seen before. The file source remembers processed files in
the checkpoint, and the file sink commits each micro-batch through its
metadata log, so a restarted or partly failed run neither loses nor
duplicates rows. ``availableNow`` processes the backlog and stops, which
suits a scheduled job; ``processing_time`` keeps the query running.

Each micro-batch gets its own ``ingestion_timestamp`` (the batch time), so
silver's latest-copy rule picks the copy from the most recent file batch.

Give a streamed bronze table its own path: the batch bronze run overwrites
its table, which would invalidate the stream sink's commit log.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from settleframe.config import PipelineConfig
from settleframe.operators.validation import classify_records, require_columns
from settleframe.plans.bronze import stamp_ingestion
from settleframe.schemas import CORRUPT_COLUMN, TRADE_REQUIRED, schema_from_mapping


def start_trades_stream(spark: SparkSession, cfg: PipelineConfig, checkpoint_location: str,
                        batch_id: str, max_files_per_trigger: int | None = None,
                        processing_time: str | None = None) -> StreamingQuery:
    """Start appending new landing trade files to the bronze trades table.

    Returns the running query; with the default trigger it stops by itself
    once the current backlog is written (``query.awaitTermination()``).
    """
    t = cfg.trades
    schema = schema_from_mapping(cfg.trades_schema, corrupt_column=True)
    reader = (spark.readStream.schema(schema)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COLUMN))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.format(t.source_format).load(t.source_path)
    require_columns(raw, TRADE_REQUIRED, "trades stream")
    rows = stamp_ingestion(classify_records(raw, TRADE_REQUIRED), f"landing_zone_{t.source_format}", batch_id)
    writer = (rows.writeStream.format(cfg.table_format)
              .option("checkpointLocation", checkpoint_location)
              .option("path", cfg.table_path("bronze", t.bronze_table))
              .partitionBy("record_status")
              .outputMode("append"))
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()
