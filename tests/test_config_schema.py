"""Config mapping, schema mapping, work folder."""

import pytest
from pyspark.sql import types as T

from settleframe.config import PipelineConfig
from settleframe.schemas import CORRUPT_COLUMN, schema_from_mapping
from settleframe.session import scratch_path, work_dir


def test_schema_from_mapping():
    s = schema_from_mapping({"a": "string", "b": "double", "c": "timestamp", "d": "decimal(18,2)",
                             "e": "timestamp_ntz"}, corrupt_column=True)
    assert [f.dataType for f in s.fields] == [T.StringType(), T.DoubleType(), T.TimestampType(),
                                             T.DecimalType(18, 2), T.TimestampNTZType(), T.StringType()]
    assert s.fields[-1].name == CORRUPT_COLUMN
    assert all(f.nullable for f in s.fields)
    with pytest.raises(ValueError):
        schema_from_mapping({"a": "geometry"})


def test_config_honors_names_and_formats():
    cfg = PipelineConfig.from_mapping({
        "delta_lake": {"bronze_path": "/x/b/", "silver_path": "/x/s", "gold_path": "/x/g/"},
        "source_to_target_mapping": {
            "trades": {"source_format": "csv", "source_path": "/in/t", "bronze_table": "bt", "silver_table": "st",
                       "gold_table": "gt"},
            "instruments": {"source_path": "/in/i", "bronze_table": "bi", "silver_table": "si"},
        },
        "data_quality": {"trades_schema": {"TradeID": "string"},
                         "validation_rules": {"required_fields": ["TradeID"], "notional_min": 5}},
        "table_format": "orc",
    })
    assert cfg.trades.source_format == "csv" and cfg.instruments.source_format == "csv"
    assert cfg.table_path("bronze", cfg.trades.bronze_table) == "/x/b/bt"
    assert cfg.table_path("silver", cfg.instruments.silver_table) == "/x/s/si"
    assert cfg.trades.gold_table == "gt" and cfg.table_format == "orc"
    assert cfg.trades_schema == {"TradeID": "string"}
    assert cfg.validation_rules["notional_min"] == 5


def test_work_dir_comes_from_session(spark):
    d = work_dir(spark)
    assert d == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(d.rstrip("/"))
