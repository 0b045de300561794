from settleframe.plans.bronze import (
    accepted,
    ingest_instruments,
    ingest_trades,
    quarantined,
    read_bronze,
    read_quarantine,
    run_bronze,
)
from settleframe.plans.gold import counterparty_summary, run_gold, trade_aggregates
from settleframe.plans.medallion import run_medallion
from settleframe.plans.silver import cleanse_trades, run_silver

__all__ = [
    "accepted", "cleanse_trades", "counterparty_summary", "ingest_instruments", "ingest_trades",
    "quarantined", "read_bronze", "read_quarantine", "run_bronze", "run_gold", "run_medallion", "run_silver", "trade_aggregates",
]
