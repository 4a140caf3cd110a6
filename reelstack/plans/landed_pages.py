"""Test input of the acceptance queries: rows as landed page documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_cols, names
from ..operators.keys import row_number_scaled

_RN = "_pg_rn"


def paginate(df: DataFrame, group_by, order, page_size: int, result_cols,
             status: Column | None = None, page_col: str = "page") -> DataFrame:
    """Landed page documents of ``df``: per group, rows in ``order`` cut into
    pages of ``page_size``. Columns: group columns, page, status, total_pages,
    results (array of structs of ``result_cols`` in row order).

    ``status`` is an expression over the group columns, ``page`` and
    ``total_pages`` (200 when omitted). A page holds at most ``page_size``
    rows, so no group larger than that is ever collected.
    """
    groups = names(group_by)
    result_cols = names(result_cols)
    numbered = row_number_scaled(df, order, _RN, partition_by=groups)
    paged = numbered.withColumn(page_col, F.floor((F.col(_RN) - 1) / page_size) + 1)
    docs = (paged.groupBy(*groups, page_col)
            .agg(F.array_sort(F.collect_list(F.struct(F.col(_RN), *as_cols(result_cols))))
                 .alias("_rows")))
    totals = (df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("total_pages", F.ceil(F.col("_n") / page_size)).drop("_n"))
    docs = docs.join(totals, on=groups)
    return docs.select(
        *groups, F.col(page_col).cast("bigint").alias(page_col),
        (status if status is not None else F.lit(200)).alias("status"),
        F.col("total_pages").cast("bigint").alias("total_pages"),
        F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in result_cols]))
        .alias("results"),
    )
