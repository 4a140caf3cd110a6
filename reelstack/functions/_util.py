from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_cols(cols) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [as_col(c) for c in cols]


def names(cols) -> list[str]:
    if isinstance(cols, str):
        return [cols]
    return list(cols)
