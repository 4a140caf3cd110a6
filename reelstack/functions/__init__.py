"""Column functions (all JVM-side Catalyst expressions, no Python UDFs)."""

from .casts import to_double, to_float, to_int, to_long, to_string
from .predicates import all_of, any_of, at_least, between, id_in, id_not_in, positive, present
from .text import base_name, date_path, json_fields, keyword_any, regex_escape

__all__ = [
    "to_double", "to_float", "to_int", "to_long", "to_string",
    "all_of", "any_of", "at_least", "between", "id_in", "id_not_in", "positive", "present",
    "base_name", "date_path", "json_fields", "keyword_any", "regex_escape",
]
