"""Pipeline configuration.

Accepts the same nested mapping users already keep in YAML
(``source_to_target_mapping``, ``delta_lake`` layer paths, ``data_quality``),
and honors every key in it: source formats, table names, schema and rules.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from settleframe.schemas import TRADE_FIELDS

DEFAULT_RULES = {
    "required_fields": ["TradeID", "InstrumentID", "Notional", "Currency"],
    "notional_min": 0,
    "currency_length": 3,
}


@dataclass(frozen=True)
class SourceSpec:
    source_format: str
    source_path: str
    bronze_table: str
    silver_table: str
    gold_table: str | None = None


@dataclass(frozen=True)
class PipelineConfig:
    trades: SourceSpec
    instruments: SourceSpec
    bronze_path: str
    silver_path: str
    gold_path: str
    table_format: str = "parquet"
    trades_schema: Mapping[str, str] = field(default_factory=lambda: dict(TRADE_FIELDS))
    validation_rules: Mapping[str, Any] = field(default_factory=lambda: dict(DEFAULT_RULES))
    strict_quality: bool = False

    @staticmethod
    def from_mapping(cfg: Mapping[str, Any]) -> "PipelineConfig":
        src = cfg.get("source_to_target_mapping", {})
        layers = cfg.get("delta_lake", cfg.get("layers", {}))
        t, i = src.get("trades", {}), src.get("instruments", {})
        dq = cfg.get("data_quality", {})
        return PipelineConfig(
            trades=SourceSpec(
                source_format=t.get("source_format", "json"),
                source_path=t["source_path"],
                bronze_table=t.get("bronze_table", "bronze_trades"),
                silver_table=t.get("silver_table", "silver_trades"),
                gold_table=t.get("gold_table", "gold_trade_aggregates"),
            ),
            instruments=SourceSpec(
                source_format=i.get("source_format", "csv"),
                source_path=i["source_path"],
                bronze_table=i.get("bronze_table", "bronze_instruments"),
                silver_table=i.get("silver_table", "silver_instruments"),
            ),
            bronze_path=layers["bronze_path"],
            silver_path=layers["silver_path"],
            gold_path=layers["gold_path"],
            table_format=cfg.get("table_format", "parquet"),
            trades_schema=dict(dq.get("trades_schema", dict(TRADE_FIELDS))),
            validation_rules=dict(dq.get("validation_rules", DEFAULT_RULES)),
            strict_quality=bool(cfg.get("strict_quality", False)),
        )

    def table_path(self, layer: str, table: str) -> str:
        base = {"bronze": self.bronze_path, "silver": self.silver_path, "gold": self.gold_path}[layer]
        return base.rstrip("/") + "/" + table
