"""Text, JSON and path column functions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from ._util import as_col

_JAVA_REGEX_SPECIAL = re.compile(r"([\\^$.|?*+()\[\]{}])")


def regex_escape(word: str) -> str:
    """Escape a literal for a Java regular expression."""
    return _JAVA_REGEX_SPECIAL.sub(r"\\\1", word)


def keyword_any(c, words, regex: bool = False) -> Column:
    """True when the text holds any of ``words`` (case-sensitive substring).

    Literal words compile to ``contains`` terms, which stay in generated code
    and are handed to the Parquet reader as pushed filters. ``regex=True``
    treats the words as patterns joined by ``|``. Null text gives null, so a
    filter drops the row.
    """
    c = as_col(c)
    words = list(words)
    if not words:
        return F.lit(False)
    if regex:
        return c.rlike("|".join(words))
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def json_fields(c, fields: dict[str, DataType | str]) -> Column:
    """Parse a JSON text once into a struct of the declared fields.

    A missing key gives null (the ``dict.get(key, None)`` behaviour).
    """
    schema = StructType([
        StructField(name, dtype if isinstance(dtype, DataType) else _parse_type(dtype), True)
        for name, dtype in fields.items()
    ])
    return F.from_json(as_col(c), schema)


def _parse_type(name: str) -> DataType:
    return StructType.fromDDL(f"x {name}").fields[0].dataType


def date_path(c) -> Column:
    """``yyyy/MM/dd`` text of a date or timestamp column."""
    return F.date_format(as_col(c), "yyyy/MM/dd")


def base_name(c) -> Column:
    """Last segment of a path (file name)."""
    return F.element_at(F.split(as_col(c), "/"), -1)
