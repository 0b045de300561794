"""Column expressions. All are built-in Spark expressions, so they stay inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Trade-size buckets and their bounds (in notional units).
SMALL, MEDIUM, LARGE = "SMALL", "MEDIUM", "LARGE"
SMALL_BELOW = 1_000_000
MEDIUM_BELOW = 10_000_000

def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_currency(c: str | Column, length: int = 3) -> Column:
    """Upper-case, strip spaces, keep only exactly ``length`` letters A-Z.

    Anything else becomes null (the row is kept). ``\\A..\\z`` anchors the
    whole string, so a trailing newline does not slip through.
    """
    v = F.upper(F.trim(_col(c)))
    return F.when(v.rlike(rf"\A[A-Z]{{{length}}}\z"), v)


def volume_category(c: str | Column, small_below: float = SMALL_BELOW,
                    medium_below: float = MEDIUM_BELOW) -> Column:
    """SMALL below ``small_below``, MEDIUM below ``medium_below``, else LARGE.

    Negative amounts are SMALL; NaN and null fall through to LARGE.
    """
    v = _col(c)
    return F.when(v < small_below, F.lit(SMALL)).when(v < medium_below, F.lit(MEDIUM)).otherwise(F.lit(LARGE))


def as_timestamp(c: str, dtype: T.DataType) -> Column:
    """Timestamp form of a column, by its declared type.

    Timestamps pass through unchanged; dates widen; text is parsed with
    ``try_to_timestamp`` so a bad value becomes null instead of failing the
    job under ANSI mode.
    """
    col = F.col(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return col
    if isinstance(dtype, T.DateType):
        return col.cast(T.TimestampType())
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(col)
    raise TypeError(f"column {c} of type {dtype.simpleString()} is not a timestamp")


def time_dimensions(date_col: str, prefix: str = "Trade") -> dict[str, Column]:
    """Calendar attributes of a date (day of week: 1 = Sunday .. 7 = Saturday)."""
    d = F.col(date_col)
    return {
        f"{prefix}Year": F.year(d),
        f"{prefix}Month": F.month(d),
        f"{prefix}Quarter": F.quarter(d),
        f"{prefix}DayOfWeek": F.dayofweek(d),
        f"{prefix}MonthName": F.date_format(d, "MMMM"),
    }


def desc_nulls_last(cols: list[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in cols]
