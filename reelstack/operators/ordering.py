"""Sorting and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions._util import as_cols


def sort_by(df: DataFrame, *cols) -> DataFrame:
    """Global sort (range-partitioned, so it runs in parallel); files written
    after it carry tight min/max statistics on the sort key."""
    return df.orderBy(*as_cols(list(cols)))


def preview(df: DataFrame, order, n: int = 20) -> DataFrame:
    """First ``n`` rows in ``order`` (a top-k: each task keeps only n rows)."""
    return df.orderBy(*as_cols(order)).limit(n)
