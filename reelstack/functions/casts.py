"""Lenient casts that never throw, whatever ``spark.sql.ansi.enabled`` says.

Dirty text columns hold values such as ``'\\N'``, ``''`` or ``'29.9'``. A plain
ANSI cast throws on them; these helpers return null instead and truncate
fractional text toward zero (``'29.9'`` -> 29), like a non-ANSI cast would.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def whole(c, dtype) -> Column:
    """Whole number of a type from text or number; exact for integral text, null on
    garbage or overflow. A cast that fails raises inside Spark, some 15 microseconds
    a row, so text without a digit, or with a letter or a point, which is no
    integral text, is spared the first one."""
    c = as_col(c)
    text = c.cast("string")
    integral = (F.typeof(c) != "string") | (text.rlike("[0-9]") & ~text.rlike("[.A-Za-z]"))
    return F.coalesce(F.when(integral, c.try_cast(dtype)), c.try_cast("double").try_cast(dtype))


def to_int(c) -> Column:
    """Integer from text or number; null on garbage or int32 overflow."""
    return whole(c, "int")


def to_long(c) -> Column:
    """64-bit integer (money columns); exact for integral text."""
    return whole(c, "bigint")


def to_float(c) -> Column:
    return as_col(c).try_cast("float")


def to_double(c) -> Column:
    return as_col(c).try_cast("double")


def to_string(c) -> Column:
    return as_col(c).cast("string")
