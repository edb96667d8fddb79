"""Scalar helpers built from Spark's own functions (no Python UDFs)."""

from tallysheet.functions.casts import cast_as, dtype_tag, load_timestamp, parse_timestamp, truncate_seconds
from tallysheet.functions.keys import composite_key, quoted, sanitize, sanitize_col, source_key

__all__ = [
    "cast_as",
    "composite_key",
    "dtype_tag",
    "load_timestamp",
    "parse_timestamp",
    "quoted",
    "sanitize",
    "sanitize_col",
    "source_key",
    "truncate_seconds",
]
