"""Whole run: bronze -> silver -> gold, handing over through storage.

Each layer reads the previous layer's table, so a failed layer reruns from
the last written table instead of from the landing files, and lineage never
spans layers. Row counts come from observations on the writes; the run ends
with a small ``pipeline_metrics`` table.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from settleframe.config import PipelineConfig
from settleframe.operators.metrics import MetricsLog
from settleframe.plans.bronze import run_bronze
from settleframe.plans.gold import run_gold, run_gold_reports
from settleframe.plans.silver import run_silver
from settleframe.sources.sinks import write_table

METRICS_TABLE = "pipeline_metrics"


LAYERS = ("bronze", "silver", "gold")


def run_medallion(spark: SparkSession, config: PipelineConfig | Mapping[str, Any], batch_id: str,
                  ingested_at: Column | None = None, layers: tuple[str, ...] = LAYERS,
                  reports: bool = False) -> MetricsLog:
    """Run ``layers`` in order (default: all three).

    To recover from a failed run, pass the layers from the one that failed
    onwards (e.g. ``("silver", "gold")``): they start from the tables the
    earlier layers already wrote. ``reports=True`` adds the trend tables
    (period rollup, running notional, trade counts). Metrics of the layers
    run are added to ``pipeline_metrics`` in the gold path, under the batch id.
    """
    unknown = [x for x in layers if x not in LAYERS]
    if unknown:
        raise ValueError(f"unknown layer(s) {unknown}; expected some of {LAYERS}")
    cfg = config if isinstance(config, PipelineConfig) else PipelineConfig.from_mapping(config)
    log = MetricsLog()
    if "bronze" in layers:
        run_bronze(spark, cfg, batch_id, log, ingested_at)
    if "silver" in layers:
        run_silver(spark, cfg, log)
    if "gold" in layers:
        run_gold(spark, cfg, log)
        if reports:
            run_gold_reports(spark, cfg, log)
    metrics = log.to_frame(spark).coalesce(1).withColumns({"processing_batch_id": F.lit(batch_id), "run_at": F.current_timestamp()})
    write_table(metrics, cfg.table_path("gold", METRICS_TABLE), cfg.table_format, mode="append")
    return log
