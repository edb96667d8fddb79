"""Key columns and column-name helpers (O-20, O-24, O-53)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEPARATOR = "-"


def source_key(url: str) -> Column:
    """``sourceid``: MD5 of the source url (folded to one constant by Catalyst)."""
    return F.md5(F.lit(url))


def composite_key(cols: Iterable[str | Column], sep: str = KEY_SEPARATOR) -> Column:
    """Key values as text joined by ``sep``; NULL if any part is NULL, so two keys never look alike."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit(sep), part)
    return joined


def sanitize(name: str) -> str:
    """Warehouse column name for a metadata name: spaces removed."""
    return name.replace(" ", "")


def merge_named(columns: Iterable[tuple[str, Column]]) -> list[Column]:
    """One column per name, in order of first mention: a later non-NULL value wins, else an earlier one.

    The one policy for generated names that meet (two metadata names that sanitise
    alike); names are compared without case, as Spark resolves them.
    """
    columns = list(columns)
    values: dict[str, list[Column]] = {}
    for name, value in columns:
        values.setdefault(name.lower(), []).insert(0, value)
    merged = {key: vs[0] if len(vs) == 1 else F.coalesce(*vs) for key, vs in values.items()}
    return [merged[name.lower()].alias(name) for name in merged_names(n for n, _ in columns)]


def merged_names(names: Iterable[str]) -> list[str]:
    """The names of ``merge_named``'s columns."""
    first: dict[str, str] = {}
    for name in names:
        first.setdefault(name.lower(), name)
    return list(first.values())


def sanitize_col(col: Column) -> Column:
    return F.replace(col, F.lit(" "), F.lit(""))


def quoted(name: str) -> str:
    """Backtick-quote a column name that may hold '-', '#', '>' or '.'."""
    return "`" + name.replace("`", "``") + "`"
