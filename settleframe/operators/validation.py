"""Record validation and data-quality rules.

* ``require_columns``: driver-side schema check (no Spark job).
* ``classify_records``: one projection adding ``record_status`` and
  ``reject_reason`` so accepted and quarantined rows leave in the *same*
  write (one parse of the landing files, no second pass).
* ``drop_missing``: the required-field filter, as a plain pushed-down filter.
* ``apply_rules``: configurable rules -> ``failed_rules array<string>``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settleframe.schemas import CORRUPT_COLUMN, PROBLEM_COLUMN

ACCEPTED = "ACCEPTED"
MALFORMED = "MALFORMED"
MISSING_REQUIRED = "MISSING_REQUIRED"

CLEANSED = "CLEANSED"
REJECTED = "REJECTED"


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "data") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"required field(s) {missing} missing from {what}")
    return df


def rename_alias(df: DataFrame, alias: str, canonical: str) -> DataFrame:
    """Rename ``alias`` to ``canonical`` (exact case); refuse if both exist."""
    if alias in df.columns:
        if canonical in df.columns:
            raise ValueError(f"both {alias!r} and {canonical!r} are present")
        return df.withColumnRenamed(alias, canonical)
    return df


def _missing_list(required: Iterable[str]) -> Column:
    """Comma list of the required columns that are null in this row ('' if none)."""
    return F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])


def classify_records(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Add ``record_status`` and ``reject_reason``.

    * MALFORMED: the reader kept raw text in ``_corrupt_record`` and the row
      lacks a required field (an unparseable line, or a file whose header cannot be
      used; the reason says which).
    * MISSING_REQUIRED: a parsed row with a null required field.
    * ACCEPTED: every required field present. A field whose value did not fit
      its type is null, as in a plain PERMISSIVE read; the raw text stays in
      ``_corrupt_record`` for audit.
    """
    required = list(required)
    missing = _missing_list(required)
    corrupt = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in df.columns else F.lit(False)
    incomplete = missing != ""
    status = (F.when(incomplete & corrupt, F.lit(MALFORMED))
              .when(incomplete, F.lit(MISSING_REQUIRED))
              .otherwise(F.lit(ACCEPTED)))
    problem = F.coalesce(F.col(PROBLEM_COLUMN), F.lit("unparseable record")) if PROBLEM_COLUMN in df.columns else F.lit("unparseable record")
    reason = (F.when(incomplete & corrupt, problem)
              .when(incomplete, F.concat(F.lit("null required field(s): "), missing)))
    return df.withColumns({"record_status": status, "reject_reason": reason}).drop(PROBLEM_COLUMN)


def drop_missing(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Keep rows where every required column is non-null."""
    return df.na.drop(how="any", subset=list(required))


def rule_checks(rules: Mapping[str, Any]) -> list[tuple[str, Column]]:
    """(rule name, failure predicate) pairs from a rules mapping.

    Supported keys: ``required_fields`` (list), ``notional_min`` (number:
    ``Notional < min`` fails; null is left to the required rule) and
    ``currency_length`` (int: Currency must be exactly that many letters A-Z).
    """
    checks: list[tuple[str, Column]] = []
    for name in rules.get("required_fields", []):
        checks.append((f"required:{name}", F.col(name).isNull()))
    if rules.get("notional_min") is not None:
        checks.append(("notional_min", F.coalesce(F.col("Notional") < F.lit(rules["notional_min"]), F.lit(False))))
    if rules.get("currency_length") is not None:
        n = int(rules["currency_length"])
        ok = F.coalesce(F.col("Currency").rlike(rf"\A[A-Z]{{{n}}}\z"), F.lit(False))
        checks.append(("currency_length", ~ok))
    return checks


def apply_rules(df: DataFrame, rules: Mapping[str, Any], column: str = "failed_rules") -> DataFrame:
    """Add ``failed_rules``: names of the rules this row breaks (empty array if none)."""
    checks = rule_checks(rules)
    names = F.array(*[F.when(pred, F.lit(name)) for name, pred in checks]) if checks else F.array()
    return df.withColumn(column, F.array_compact(names))


def quality_status(df: DataFrame, rules: Mapping[str, Any] | None, strict: bool) -> DataFrame:
    """``data_quality_status``: CLEANSED for every row (default), or, in strict
    mode, REJECTED for rows failing a rule, with ``failed_rules`` kept."""
    if not strict:
        return df.withColumn("data_quality_status", F.lit(CLEANSED))
    checked = apply_rules(df, rules or {})
    return checked.withColumn(
        "data_quality_status",
        F.when(F.size("failed_rules") == 0, F.lit(CLEANSED)).otherwise(F.lit(REJECTED)))
