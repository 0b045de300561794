"""DataFrame -> DataFrame operators."""

from settleframe.operators.aggregates import (
    counterparty_totals,
    daily_metrics,
    with_time_dimensions,
    with_volume_category,
)
from settleframe.operators.dedup import keep_latest
from settleframe.operators.enrichment import (
    convert_to_usd,
    convert_to_usd_as_of,
    daily_usd_notional,
    enrich_trades,
    fx_rates,
    latest_instruments,
    orphan_trades,
    rates_as_of,
)
from settleframe.operators.ranking import global_rank, top_ranked
from settleframe.operators.rollups import period_rollup, running_total, trade_counts_cube
from settleframe.operators.sketches import daily_sketches, period_statistics
from settleframe.operators.skew import join_skewed
from settleframe.operators.validation import (
    apply_rules,
    classify_records,
    drop_missing,
    quality_status,
    rename_alias,
    require_columns,
)

__all__ = [
    "apply_rules", "classify_records", "convert_to_usd", "convert_to_usd_as_of", "counterparty_totals",
    "daily_metrics", "daily_sketches", "daily_usd_notional", "drop_missing", "enrich_trades", "fx_rates",
    "global_rank", "join_skewed", "keep_latest", "latest_instruments", "orphan_trades", "period_rollup", "period_statistics", "rates_as_of",
    "quality_status", "rename_alias", "require_columns", "running_total", "top_ranked",
    "trade_counts_cube", "with_time_dimensions", "with_volume_category",
]
