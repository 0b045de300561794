"""Period rollups, running totals and multi-dimensional trade counts.

GROUPING SETS run as one Expand + partial aggregate, not one job per level. Both
first sum per smallest cell (a day, a pair of codes), so trades are grouped once and
only one row per cell goes through the Expand; sums stay mergeable until the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settleframe.functions.columns import time_dimensions
from settleframe.operators.money import merge_states, money_states, running_sum

# Period level labels.
YEAR, QUARTER, MONTH = "YEAR", "QUARTER", "MONTH"


def period_rollup(trades: DataFrame, date_col: str = "TradeDateYYYYMMDD") -> DataFrame:
    """Per counterparty: yearly, quarterly and monthly totals
    (``GROUPING SETS ((cp, y), (cp, y, q), (cp, y, m))``) from daily sums that
    are still mergeable, so no digit is lost on the way up."""
    daily = money_states(trades, ["Counterparty", date_col], "Notional", {"TotalNotional": None},
                         {"__trades": ("count", "TradeID"), "__priced": ("count", "Notional")})
    dims = ["TradeYear", "TradeQuarter", "TradeMonth"]
    calendar = time_dimensions(date_col)
    out = merge_states(
        daily.withColumns({c: calendar[c] for c in dims}), ["Counterparty", *dims], ["TotalNotional"],
        {"TradeCount": F.sum("__trades"), "__priced": F.sum("__priced"),
         "__gq": F.grouping("TradeQuarter"), "__gm": F.grouping("TradeMonth")},
        sets=[["Counterparty", "TradeYear"],
              ["Counterparty", "TradeYear", "TradeQuarter"],
              ["Counterparty", "TradeYear", "TradeMonth"]],
        told_by=["__gq", "__gm"])
    level = (F.when(F.col("__gq") == 0, F.lit(QUARTER))
             .when(F.col("__gm") == 0, F.lit(MONTH))
             .otherwise(F.lit(YEAR)))
    average = F.when(F.col("__priced") > 0, F.col("TotalNotional") / F.col("__priced"))
    return out.select("Counterparty", *dims, "TradeCount", "TotalNotional", average.alias("AverageTradeSize"), level.alias("PeriodLevel"))


def running_total(daily: DataFrame, amount: str = "DailyNotional", key: str = "Counterparty",
                  order_col: str = "TradeDateYYYYMMDD", out: str = "RunningNotional") -> DataFrame:
    """Cumulative ``amount`` per ``key`` in ``order_col`` order.

    Runs over the daily table (one row per key and day), so a window
    partition holds at most one row per calendar day of that key, however
    many trades the key has.
    """
    w = (Window.partitionBy(key).orderBy(F.col(order_col).asc_nulls_last())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return running_sum(daily, amount, w, out)


def trade_counts_cube(trades: DataFrame, dims: tuple[str, ...] = ("Currency", "Status")) -> DataFrame:
    """Trade counts and notional for every combination of ``dims``
    (``CUBE``), with ``grouping_id`` telling subtotal rows from data nulls."""
    cells = money_states(trades, list(dims), "Notional", {"TotalNotional": None}, {"__trades": ("count", "TradeID")})
    sets = [[d for i, d in enumerate(dims) if not left_out >> i & 1] for left_out in range(1 << len(dims))]
    # the bin is the last key of every set, so it is the lowest digit of the id
    out = merge_states(cells, list(dims), ["TotalNotional"],
                       {"TradeCount": F.sum("__trades"), "grouping_id": F.shiftright(F.grouping_id(), 1).cast("int")},
                       sets=sets, told_by=["grouping_id"])
    return out.select(*dims, "TradeCount", "TotalNotional", "grouping_id")
