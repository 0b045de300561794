"""Landing-zone and layer-table readers.

Schemas are always declared: no inference pass over the data, and ids keep
their text form. Corrupt records are kept in ``_corrupt_record`` instead of
turning into all-null rows that vanish downstream.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settleframe.schemas import (
    CORRUPT_COLUMN,
    PROBLEM_COLUMN,
    TRADE_REQUIRED,
    instruments_schema,
    schema_from_mapping,
    trades_schema,
)


def _headers(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """Distinct header lines of CSV files, each with its files.

    One job over the lines: a file's header is its first line that is not blank, told
    by its place (block, then row) and found by a minimum that combines map-side. One
    row per distinct header reaches the driver, with file names that Spark's own
    listing holds as well. Files without a header hold no rows and are left out."""
    lines = (spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
        F.monotonically_increasing_id().alias("row")).filter(F.col("value").rlike(r"[^\x00-\x20]")))
    first = lines.groupBy("file").agg(F.min(F.struct("block", "row", "value")).alias("first"))
    found = first.groupBy(F.regexp_replace("first.value", "^\ufeff", "").alias("header")).agg(F.sort_array(F.collect_list("file")).alias("files"))
    return sorted((r.header, [unquote(f) for f in r.files]) for r in found.collect())


def _header_problem(line: str, names: Sequence[str]) -> str | None:
    if line.count('"') % 2:
        return "header goes on behind a line break"
    again = sorted({n for n in names if n and names.count(n) > 1})
    return f"header names {', '.join(again)} twice" if again else None


def _csv_by_name(spark: SparkSession, path: str, declared: T.StructType) -> DataFrame | None:
    """CSV files with header rows, columns matched by name.

    Files are grouped by header (a byte-order mark before it does not count, quotes
    around names are taken off) and each group is read under its own column order
    (Spark applies a declared schema by position), then the groups are united by name.
    Columns that are not declared are text, one without a name is left out. The lines of a file whose header
    cannot be used (a name occurs twice, or a quoted name holds a line break) are
    rows of nulls with the line as corrupt record and the problem beside it. None
    when no file has a header.
    """
    headers = _headers(spark, path)
    kinds = {f.name: f.dataType for f in declared.fields if f.name != CORRUPT_COLUMN}
    text = T.StringType()
    parts = []
    for line, own in headers:
        where = path if len(headers) == 1 else own
        names = next(csv.reader([line]), [])
        problem = _header_problem(line, names)
        if problem:
            parts.append(spark.read.text(where).filter(F.col("value").rlike(r"[^\x00-\x20]")).select(
                F.col("value").alias(CORRUPT_COLUMN), F.lit(problem).alias(PROBLEM_COLUMN)))
            continue
        fields = [T.StructField(c or f"__unnamed_{i}", kinds.get(c, text)) for i, c in enumerate(names)]
        part = (spark.read.schema(T.StructType([*fields, T.StructField(CORRUPT_COLUMN, text)])).option("mode", "PERMISSIVE").option("header", True)
                .option("columnNameOfCorruptRecord", CORRUPT_COLUMN).csv(where))
        parts.append(part.drop(*(f.name for f in fields if f.name.startswith("__unnamed_"))))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


# The types that inference tries, narrowest first; what fits none is text.
_LATTICE = ("int", "bigint", "double", "boolean", "timestamp")


def infer_types(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The narrowest type that all values of each text column fit; text for columns
    without values. One aggregate for all columns, combined map-side; one row to the
    driver."""
    fits = [F.bool_and(F.coalesce(F.col(f"`{c}`").try_cast(t).isNotNull(), F.lit(False)) | F.col(f"`{c}`").isNull())
            .alias(f"{i}_{t}") for i, c in enumerate(columns) for t in _LATTICE]
    some = [F.count(F.col(f"`{c}`")).alias(f"{i}_n") for i, c in enumerate(columns)]
    row = df.agg(*fits, *some).first() if columns else {}
    return {c: next((t for t in _LATTICE if row[f"{i}_n"] and row[f"{i}_{t}"]), "string") for i, c in enumerate(columns)}


def _with_declared(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Declared columns in order and type, missing ones null (also the corrupt
    text, which only text formats have), and a file's problem if there is one."""
    problem = [PROBLEM_COLUMN] if PROBLEM_COLUMN in df.columns else []
    return df.select(*(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in declared.fields), *problem)


def _refuse_without(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """A landing none of whose files has a required column is refused."""
    missing = [c for c in required if c not in df.columns]
    if missing and PROBLEM_COLUMN not in df.columns:
        raise ValueError(f"required field(s) {missing} missing from trades data")
    return df


def read_trades(spark: SparkSession, path: str, fmt: str = "json",
                schema: T.StructType | Mapping[str, str] | None = None) -> DataFrame:
    """Trades from the landing zone (JSON lines by default), PERMISSIVE.

    Unknown fields are ignored, missing ones are null, a field whose value
    does not fit its type is null, and an unparseable line keeps its text in
    ``_corrupt_record``. Field names are case-sensitive. CSV columns go by their
    header names, file by file. Any other format Spark reads (Parquet, ORC, ...)
    brings its own types, cast to the declared ones. In these formats the landing is
    refused when it lacks a required column altogether.
    """
    if schema is None:
        schema = trades_schema(corrupt_column=True)
    elif isinstance(schema, Mapping):
        schema = schema_from_mapping(schema, corrupt_column=True)
    if fmt == "json":
        return (spark.read.schema(schema).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT_COLUMN).json(path))
    if fmt == "csv":
        df = _csv_by_name(spark, path, schema)
        return spark.createDataFrame([], schema) if df is None else _with_declared(_refuse_without(df, TRADE_REQUIRED), schema)
    return _with_declared(_refuse_without(spark.read.format(fmt).load(path), TRADE_REQUIRED), schema)


def read_instruments(spark: SparkSession, path: str, fmt: str = "csv",
                     infer_schema: bool = False) -> DataFrame:
    """Instrument reference data (CSV with a header row), PERMISSIVE.

    Every column is read as text under each file's own header names; files may differ
    in column order and call the id ``InstrumentID`` or ``instrument_id`` (united as
    ``InstrumentID``; both in one file is an error). Short rows are padded with null.
    ``infer_schema=True`` then gives each column, by its name, the narrowest type that
    all its values fit (one more pass; it turns ``001`` into 1 unless another id is
    no number).
    """
    if fmt != "csv":
        df = spark.read.format(fmt).load(path)
    else:
        df = _csv_by_name(spark, path, instruments_schema())
        if df is None:
            return spark.createDataFrame([], instruments_schema())
        if {"InstrumentID", "instrument_id"} <= set(df.columns):
            df = _one_id(spark, path, df)
        if infer_schema:
            kinds = infer_types(df, [c for c in df.columns if c not in (CORRUPT_COLUMN, PROBLEM_COLUMN)])
            df = df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in kinds.items() if t != "string"})
    return df if CORRUPT_COLUMN in df.columns else df.withColumn(CORRUPT_COLUMN, F.lit(None).cast("string"))


def _one_id(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    for line, files in _headers(spark, path):
        if {"InstrumentID", "instrument_id"} <= set(next(csv.reader([line]), [])):
            raise ValueError(f"both 'instrument_id' and 'InstrumentID' are present in {files[0]}")
    return df.withColumn("InstrumentID", F.coalesce("InstrumentID", "instrument_id")).drop("instrument_id")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A layer table by path (parquet by default; any installed format)."""
    return spark.read.format(fmt).load(path)
