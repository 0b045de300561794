from settleframe.functions.columns import (
    as_timestamp,
    desc_nulls_last,
    normalize_currency,
    time_dimensions,
    volume_category,
)

__all__ = [
    "as_timestamp",
    "desc_nulls_last",
    "normalize_currency",
    "time_dimensions",
    "volume_category",
]
