"""Row filters by id lists.

A Python list becomes an ``IN`` predicate, whatever its length: it is part of
the plan already, and Catalyst pushes it into the Parquet scan and through joins
on the same key. Ids that live in a table come as a DataFrame and become a
semi/anti join, whose strategy AQE picks from measured sizes. Both forms give
the same rows: null ids in the list are ignored, and a row with a null id is
neither allowed nor kept past a deny-list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ids(df: DataFrame, ids: DataFrame, col: str) -> DataFrame:
    return ids.select(F.col(ids.columns[0]).cast(df.schema[col].dataType).alias(col)).na.drop()


def _list(ids) -> list:
    return [i for i in dict.fromkeys(ids) if i is not None]


def keep_ids(df: DataFrame, col: str, ids) -> DataFrame:
    """Allow-list: keep rows whose ``col`` is one of ``ids`` (a list, or a
    DataFrame whose first column holds them)."""
    if isinstance(ids, DataFrame):
        return df.join(_ids(df, ids, col), on=col, how="left_semi").select(*df.columns)
    return df.filter(F.col(col).isin(_list(ids)))


def drop_ids(df: DataFrame, col: str, ids) -> DataFrame:
    """Deny-list: keep rows whose ``col`` is present and none of ``ids``."""
    present = df.filter(F.col(col).isNotNull())
    if isinstance(ids, DataFrame):
        return present.join(_ids(df, ids, col), on=col, how="left_anti").select(*df.columns)
    return present.filter(~F.col(col).isin(_list(ids)))
