"""Row predicates used by the quality gates. All are plain Catalyst
expressions, so a filter built from them is pushed to the Parquet scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def between(c, lo, hi) -> Column:
    """Inclusive range."""
    return as_col(c).between(lo, hi)


def at_least(c, n) -> Column:
    return as_col(c) >= F.lit(n)


def positive(c) -> Column:
    return as_col(c) > F.lit(0)


def present(c) -> Column:
    return as_col(c).isNotNull()


def all_of(*preds: Column) -> Column:
    return reduce(lambda a, b: a & b, preds)


def any_of(*preds: Column) -> Column:
    return reduce(lambda a, b: a | b, preds)


def id_in(c, ids) -> Column:
    return as_col(c).isin(list(ids))


def id_not_in(c, ids) -> Column:
    return ~as_col(c).isin(list(ids))
