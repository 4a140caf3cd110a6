"""Projections: select/alias, rename, drop, constant stamp, null fill, reorder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_col


def project(df: DataFrame, columns: dict[str, str | Column]) -> DataFrame:
    """``SELECT expr AS out, ...`` — ``columns`` maps output name to source."""
    return df.select(*[as_col(src).alias(out) for out, src in columns.items()])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns; a name that is not present is ignored."""
    return df.withColumnsRenamed(mapping)


def drop_cols(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns; a name that is not present is ignored."""
    return df.drop(*cols)


def stamp(df: DataFrame, name: str, value) -> DataFrame:
    """Add a constant column (for example the extraction date)."""
    return df.withColumn(name, F.lit(value))


def fill_nulls(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace nulls per column. Each value is cast to its column's type, so
    ``{'text_col': 0}`` fills ``'0'`` and ``{'int_col': 0}`` fills 0; a value
    that does not convert (``{'int_col': 'x'}``) leaves the column as it is."""
    types = dict(df.dtypes)
    fills = {}
    for name, value in values.items():
        if name not in types:
            continue
        fills[name] = F.coalesce(F.col(name), F.lit(value).try_cast(types[name]))
    return df.withColumns(fills) if fills else df


def move_last(df: DataFrame, name: str) -> DataFrame:
    """Move one column to the end of the schema."""
    return df.select(*[c for c in df.columns if c != name], name)


def cast_columns(df: DataFrame, casts: dict[str, Column]) -> DataFrame:
    """Replace columns by typed expressions (for example lenient casts)."""
    return df.withColumns(casts)
