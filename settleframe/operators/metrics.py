"""Row-count metrics observed during the writes themselves.

``DataFrame.observe`` computes named aggregates as a side output of the
action that runs the plan, so counting costs no extra pass over the data.
An observation is a barrier for filter pushdown, so observe only frames that
are read in full (layer inputs) or written (layer outputs).
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

METRICS_SCHEMA = "layer string, table_name string, metric string, value bigint"

# Observation names must not repeat within a plan; keep them unique per process.
_OBSERVATION_IDS = itertools.count()


def count_rows() -> Column:
    return F.count(F.lit(1))


@dataclass
class MetricsLog:
    """Collects observations; one row per (layer, table, metric)."""

    rows: list[tuple[str, str, str, int]] = field(default_factory=list)
    _pending: list[tuple[str, str, Observation]] = field(default_factory=list)

    def observe(self, df: DataFrame, layer: str, table: str, **metrics: Column) -> DataFrame:
        obs = Observation(f"{layer}.{table}.{next(_OBSERVATION_IDS)}")
        self._pending.append((layer, table, obs))
        return df.observe(obs, *[expr.alias(name) for name, expr in metrics.items()])

    def add(self, layer: str, table: str, metric: str, value: int) -> None:
        self.rows.append((layer, table, metric, int(value)))

    def collect(self) -> None:
        """Read finished observations (call after the write that ran them)."""
        for layer, table, obs in self._pending:
            values = obs.get  # blocks until the action that carries it finished
            for name, value in values.items():
                self.add(layer, table, name, 0 if value is None else value)
        self._pending = []

    def value(self, layer: str, table: str, metric: str) -> int:
        for row in self.rows:
            if row[:3] == (layer, table, metric):
                return row[3]
        raise KeyError((layer, table, metric))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, METRICS_SCHEMA)
