"""Bag unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ..functions import casts

_TAG = "_branch"
_LENIENT = {"int": casts.to_int, "bigint": casts.to_long, "float": casts.to_float,
            "double": casts.to_double, "string": casts.to_string}


def _cast(c: Column, dtype: DataType) -> Column:
    lenient = _LENIENT.get(dtype.simpleString())
    return lenient(c) if lenient else c.try_cast(dtype)


def union_all(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_typed(schema: StructType, *dfs: DataFrame) -> DataFrame:
    """UNION ALL of inputs whose column types differ: every input is first
    projected onto ``schema`` (by name, with lenient casts: dirty text gives
    null, fractional text is cut), so the result type is the declared one and
    not the coercion of whatever the branches produced."""
    def align(df: DataFrame) -> DataFrame:
        return df.select(*[_cast(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])
    return union_all(*[align(df) for df in dfs])


def union_filters(df: DataFrame, branches: dict[str, Column], tag: str | None = None) -> DataFrame:
    """``UNION ALL`` of ``df.filter(p)`` for every branch predicate, in one scan.

    A row appears once per branch it satisfies (bag semantics, as the union
    of the filtered branches); a null predicate does not match. ``tag`` keeps
    the branch name as a column.
    """
    tags = F.array(*[F.when(pred, F.lit(name)) for name, pred in branches.items()])
    # Rows of no branch go first, by a predicate the scan can take.
    df = df.filter(reduce(lambda a, b: a | b, branches.values()))
    out = df.withColumn(_TAG, F.explode(tags)).filter(F.col(_TAG).isNotNull())
    return out.withColumnRenamed(_TAG, tag) if tag else out.drop(_TAG)
