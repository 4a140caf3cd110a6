"""Surrogate keys.

* ``dense_key``        – ``prefix || row_number() OVER (ORDER BY ...)``. A window
  without PARTITION BY runs in one task, so use it only where the row count
  has a known small bound (years of a date dimension).
* ``dense_key_scaled`` – the same numbers without a single task.
* ``row_number_scaled`` – the general form, ``row_number() OVER (PARTITION BY g
  ORDER BY o)``, which also splits a group holding a large share of all rows.
* ``unique_key``       – ``monotonically_increasing_id() + 1``: unique, not dense,
  depends on partitioning.

How the scaled numbering works: the rows are range partitioned and sorted by the
sort key (group columns, then order columns, then a hash of the row, so that rows
with equal or null keys spread over partitions too). The place of a row inside
its partition and the row counts of the partitions before it give its rank; a
group's first rank is taken off again. The ranges follow the data and the
session's number of shuffle partitions; the sorted rows are stored, so every
later step sees the same ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import names
from ..session import materialize, shuffle_partitions

_TIE, _SAME, _PART, _AT, _RANK, _G = "_rk_tie", "_rk_same", "_rk_part", "_rk_at", "_rk_rank", "_rk_group"


def with_prefix(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def dense_key(df: DataFrame, order, name: str, prefix: str | None = None) -> DataFrame:
    """Dense key 1..n in ``order`` (single-task window: small inputs only)."""
    order = [order] if isinstance(order, (str, Column)) else list(order)
    number = F.row_number().over(Window.orderBy(*[F.col(c) if isinstance(c, str) else c
                                                  for c in order]))
    return df.withColumn(name, with_prefix(prefix, number) if prefix is not None else number)


def row_number_scaled(df: DataFrame, order, name: str, partition_by=(),
                      buckets: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY partition_by ORDER BY order)`` as a
    bigint (ascending, nulls first), without sending any group, key or the
    whole input to one task. Give a total order for a reproducible numbering;
    ties follow a hash of the whole row. ``buckets`` is the number of ranges."""
    part, order = names(partition_by), names(order)
    n = buckets or shuffle_partitions(df.sparkSession)
    sort = [*part, *order, _TIE, _SAME]
    # _SAME tells rows apart that are equal in every column: any order will do.
    ranged = (df.withColumn(_TIE, F.xxhash64(*[F.col(_quote(c)) for c in df.columns]))
              .withColumn(_SAME, F.monotonically_increasing_id()))
    ranged = (ranged.repartitionByRange(n, *[F.col(_quote(c)) for c in sort])
              .sortWithinPartitions(*[F.col(_quote(c)) for c in sort]).drop(_TIE, _SAME))
    # The low 33 bits of the id count the rows of a partition in their order.
    ranged = materialize(
        ranged.withColumn(_PART, F.spark_partition_id())
        .withColumn(_AT, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + 1), "ranged")
    # One row per range: a window over them all is small by construction.
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        ranged.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"))
        .select(_PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")), "range_offsets")
    ranked = ranged.join(F.broadcast(offsets), _PART).withColumn(_RANK, F.col("_off") + F.col(_AT))
    number = F.col(_RANK)
    if part:
        # A struct keeps null groups equal; the least rank is partly aggregated.
        ranked = ranked.withColumn(_G, F.struct(*[F.col(_quote(c)) for c in part]))
        first = materialize(ranked.groupBy(_G).agg((F.min(_RANK) - 1).alias("_first")), "group_starts")
        ranked = ranked.join(first, _G)
        number = number - F.col("_first")
    return ranked.select(*[F.col(_quote(c)) for c in df.columns], number.cast("bigint").alias(name))


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def dense_key_scaled(df: DataFrame, order, name: str, prefix: str | None = None,
                     buckets: int | None = None) -> DataFrame:
    """Same keys as ``dense_key`` for inputs of any size."""
    out = row_number_scaled(df, order, name, buckets=buckets)
    return out.withColumn(name, with_prefix(prefix, F.col(name))) if prefix is not None else out


def unique_key(df: DataFrame, name: str) -> DataFrame:
    """``monotonically_increasing_id() + 1``: 1, 2, ..., 8589934593, ..."""
    return df.withColumn(name, F.monotonically_increasing_id() + F.lit(1))
