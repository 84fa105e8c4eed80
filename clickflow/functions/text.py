"""String helpers with the original pipeline's null/blank semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Surrounding whitespace, Unicode-aware like Python's str.strip(). Spark's trim() only
# removes spaces.
_STRIP = r"(?U)^\s+|\s+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_text(c) -> Column:
    """Cast to string (booleans become 'true'/'false')."""
    return _c(c).cast("string")


def strip_ws(c) -> Column:
    """Remove leading/trailing whitespace of all kinds."""
    return F.regexp_replace(_c(c), _STRIP, "")


def blank_to_null(c) -> Column:
    """'' -> null, everything else unchanged (truthiness of a string field)."""
    return F.nullif(_c(c), F.lit(""))


def is_blank(c) -> Column:
    """null or exactly '' (whitespace-only is not blank)."""
    col = _c(c)
    return col.isNull() | (col == F.lit(""))


def truthy_text(c, dtype: T.DataType | None = None) -> Column:
    """The value as text when it is truthy in Python terms, else null: strings drop '',
    numbers drop 0, booleans drop False (True becomes 'true')."""
    col = _c(c)
    if isinstance(dtype, T.NumericType):
        return F.when(col != 0, col.cast("string"))
    if isinstance(dtype, T.BooleanType):
        return F.when(col, col.cast("string"))
    return F.nullif(col.cast("string"), F.lit(""))


def first_truthy(*cols, types: dict | None = None) -> Column:
    """First truthy value as text (Python ``a or b``); null when none is. ``types`` maps
    column names to their data types (string assumed when absent)."""
    types = types or {}
    return F.coalesce(*[truthy_text(c, types.get(c) if isinstance(c, str) else None) for c in cols])
