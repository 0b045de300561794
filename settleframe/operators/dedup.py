"""Keep one row per key: the latest copy, chosen deterministically.

``row_number() = 1`` over the key lets Catalyst insert a partial
``WindowGroupLimit`` *before* the shuffle: each map task forwards at most one
row per key, so a key repeated across a third of all rows still shuffles only
one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settleframe.functions.columns import desc_nulls_last


def keep_latest(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str],
                tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Per ``key``, keep the row with the greatest ``order_by`` values.

    Order is descending with nulls last for ``order_by`` and then for every
    ``tie_breakers`` column, so copies that tie on the ingestion stamp still
    resolve to the same survivor on every run and every partitioning.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rn = "__rn"
    w = Window.partitionBy(*keys).orderBy(*desc_nulls_last(list(order_by) + list(tie_breakers)))
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)
