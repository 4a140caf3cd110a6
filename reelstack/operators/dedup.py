"""Deduplication.

``keep_first`` is ``row_number() = 1``: Spark plans it with a partial
WindowGroupLimit before the shuffle, so every map task forwards at most one row
per key. A key holding a third of all rows therefore costs one row per map
task in the exchange, not a third of the table in one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import as_cols, names

_RN = "_dedup_rn"


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """First row per key in ``order`` (give a total order for a stable pick)."""
    w = Window.partitionBy(*names(keys)).orderBy(*as_cols(order))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def keep_one(df: DataFrame, keys, order=None) -> DataFrame:
    """One row per key.

    With ``order`` the pick is the first in that order. Without it the pick is
    any row; use this only where the kept columns depend on the key alone, so
    every pick is the same (hash aggregation with map-side combine, no sort).
    """
    if order is not None:
        return keep_first(df, keys, order)
    return df.dropDuplicates(names(keys))


def distinct_rows(df: DataFrame, cols=None) -> DataFrame:
    """``SELECT DISTINCT cols`` (partial aggregation before the shuffle)."""
    return (df.select(*names(cols)) if cols else df).distinct()
