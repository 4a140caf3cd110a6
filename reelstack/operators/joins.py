"""Equi-joins of the layered jobs.

No join here forces a strategy: AQE broadcasts a side only when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a
shuffled sort-merge join otherwise (splitting skewed partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import keep_first

def join_on_key(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None,
                how: str = "inner") -> DataFrame:
    """Join on one key column. When the names differ both stay in the output
    (the reference renames the right key first so they cannot clash)."""
    right_key = right_key or left_key
    if right_key == left_key:
        return left.join(right, on=left_key, how=how)
    return left.join(right, left[left_key] == right[right_key], how)


def enrich(df: DataFrame, details: DataFrame, key: str, details_key: str | None = None) -> DataFrame:
    """Attach a detail record to every row by key; a missing detail gives nulls.

    Details are first reduced to one record per key, the first in the total
    order of their columns, so a repeated detail never multiplies a row.
    """
    details_key = details_key or key
    if details_key != key:
        details = details.withColumnRenamed(details_key, key)
    details = keep_first(details, key, [c for c in details.columns if c != key] or [key])
    return df.join(details, on=key, how="left")


def lookup_key(fact: DataFrame, dim: DataFrame, fact_on: str, dim_on: str, keys) -> DataFrame:
    """Attach surrogate key column(s) ``keys`` of ``dim`` to ``fact``.

    ``dim`` must be unique on ``dim_on`` (a date dimension of DISTINCT years,
    or a per-id dimension), so the fact keeps its grain. A fact row
    whose ``fact_on`` is null has no key and is dropped (inner join).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    side = dim.select(F.col(dim_on).alias("_lk_on"), *keys)
    return (fact.join(side, fact[fact_on] == side["_lk_on"], "inner").drop("_lk_on"))


def fanout_counts(fact: DataFrame, dim: DataFrame, fact_on: str, dim_on: str,
                  name: str = "n_rows") -> DataFrame:
    """Size, per key, of ``fact JOIN dim ON fact_on = dim_on`` when the
    dimension holds one row per movie (the per-row date grain).

    Each key contributes count_fact(key) x count_dim(key) rows; the pairs
    themselves are never produced. Both counts are partial aggregations.
    """
    f = fact.groupBy(F.col(fact_on).alias("_fo_key")).agg(F.count(F.lit(1)).alias("_fo_f"))
    d = dim.groupBy(F.col(dim_on).alias("_fo_key")).agg(F.count(F.lit(1)).alias("_fo_d"))
    return (f.join(d, on="_fo_key")
            .select(F.col("_fo_key").alias(fact_on), (F.col("_fo_f") * F.col("_fo_d")).alias(name)))
