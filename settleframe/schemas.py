"""Schemas of the landing files and the layer tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"
PROBLEM_COLUMN = "_file_problem"   # why a file's rows could not be read

# Landing trade schema (column names and types as published by
# the source system), instrument header columns.
TRADE_FIELDS = [
    ("TradeID", "string"),
    ("InstrumentID", "string"),
    ("Counterparty", "string"),
    ("Notional", "double"),
    ("Currency", "string"),
    ("TradeDate", "timestamp"),
    ("SettlementDate", "timestamp"),
    ("Status", "string"),
]
INSTRUMENT_FIELDS = ["InstrumentID", "InstrumentType", "InstrumentName", "Ticker", "Exchange"]

TRADE_BUSINESS_COLUMNS = [name for name, _ in TRADE_FIELDS]
TRADE_REQUIRED = ["TradeID", "InstrumentID", "Currency"]

_SIMPLE_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _to_type(name: str) -> T.DataType:
    key = name.strip().lower()
    if key in _SIMPLE_TYPES:
        return _SIMPLE_TYPES[key]
    if key.startswith("decimal"):
        inner = key[key.index("(") + 1:key.index(")")]
        precision, scale = (int(p) for p in inner.split(","))
        return T.DecimalType(precision, scale)
    raise ValueError(f"unsupported column type in schema mapping: {name!r}")


def schema_from_mapping(mapping: Mapping[str, str], corrupt_column: bool = False) -> T.StructType:
    """``{column: type-name}`` (config ``data_quality.trades_schema``) -> StructType.

    File reads make every field nullable, so fields are declared nullable; the
    required-field filter enforces presence.
    """
    fields = [T.StructField(col, _to_type(typ), True) for col, typ in mapping.items()]
    if corrupt_column:
        fields.append(T.StructField(CORRUPT_COLUMN, T.StringType(), True))
    return T.StructType(fields)


def trades_schema(corrupt_column: bool = True) -> T.StructType:
    return schema_from_mapping(dict(TRADE_FIELDS), corrupt_column=corrupt_column)


def instruments_schema(id_column: str = "InstrumentID", corrupt_column: bool = True) -> T.StructType:
    """All-string schema: ids such as ``001`` must stay text to match trades."""
    names = [id_column] + INSTRUMENT_FIELDS[1:]
    return schema_from_mapping({n: "string" for n in names}, corrupt_column=corrupt_column)
