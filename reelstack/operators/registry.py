"""Surrogate keys that stay the same from one extraction to the next.

A registry holds (id, number) and only grows: ids it has not seen get the next
numbers, in their order; ids that are gone keep theirs. So every key ever handed
out still means the same id, and the numbers are dense over all ids ever seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_scope
from ..storage import Store, staging_folder
from .keys import row_number_scaled, with_prefix

ID, NUMBER = "id", "number"


def read_registry(spark: SparkSession, root: str) -> DataFrame | None:
    """(id, number) of all batches, None before the first."""
    batches = _batches(Store(spark, root), root)
    return spark.read.parquet(*[f"{root}/batch={b}" for b in batches]).select(ID, NUMBER) if batches else None


def _batches(store: Store, root: str) -> list[int]:
    return sorted(int(n[6:]) for n in store.names(root) if n.startswith("batch=") and n[6:].isdigit())


def register(ids: DataFrame, id_col: str, root: str) -> DataFrame:
    """Give every id of ``ids`` a number in the registry at ``root`` and return
    the registry (id, number). Null ids get none.

    Unseen ids are numbered without a single task (``row_number_scaled``) and
    land as one more batch folder, moved into place when it is whole: a job that
    dies has handed out nothing, and a rerun finds its ids known. Of two writers
    at once the later one fails instead of handing out numbers twice.
    """
    spark = ids.sparkSession
    store, staging = Store(spark, root), staging_folder(root)
    batches = _batches(store, root)
    known = read_registry(spark, root)
    fresh = ids.select(F.col(id_col).alias(ID)).filter(F.col(ID).isNotNull()).distinct()
    start = 0
    if known is not None:
        fresh = fresh.join(known.select(ID), ID, "left_anti")
        start = known.agg(F.max(NUMBER)).first()[0] or 0
    try:
        with scratch_scope(spark):
            numbered = row_number_scaled(fresh, ID, NUMBER)
            numbered.withColumn(NUMBER, F.col(NUMBER) + F.lit(start)).write.parquet(staging)
        if not batches or not spark.read.parquet(staging).isEmpty():
            store.rename(staging, f"{root}/batch={batches[-1] + 1 if batches else 1}")
    finally:
        store.delete(staging)
    return read_registry(spark, root)


def registered_key(df: DataFrame, id_col: str, name: str, root: str, prefix: str | None = None) -> DataFrame:
    """``df`` with the stable key of ``id_col``; new ids are registered first. A
    null id has a null key."""
    registry = register(df, id_col, root)
    keys = registry.select(F.col(ID).alias("_rg_id"), F.col(NUMBER).alias(name))
    out = df.join(keys, F.col(id_col) == F.col("_rg_id"), "left").drop("_rg_id")
    return out.withColumn(name, with_prefix(prefix, F.col(name))) if prefix is not None else out
