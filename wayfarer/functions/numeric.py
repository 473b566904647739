"""Numeric coercion with pandas ``to_numeric(errors='coerce')`` semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text accepted as a number: decimal / scientific notation, inf, infinity, nan.
NUMERIC_TEXT = r"^[+-]?(([0-9]+([.][0-9]*)?|[.][0-9]+)([e][+-]?[0-9]+)?|inf|infinity|nan)$"


def nan_to_null(c: Column) -> Column:
    """NaN is not a value: it becomes NULL so aggregates skip it."""
    return F.when(~F.isnan(c), c)


def to_double(c, dtype: T.DataType | None = None) -> Column:
    """Coerce to double; bad text -> NULL, NaN -> NULL, +/-inf kept.

    ``dtype`` is the input column's type; numeric columns are cast directly,
    anything else goes through a guarded text cast (Spark alone would accept
    Java suffixes such as ``1d``).
    """
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.NumericType):
        return nan_to_null(col.cast("double"))
    if isinstance(dtype, T.NullType):
        return F.lit(None).cast("double")
    text = F.lower(F.trim(col.cast("string")))
    value = F.when(text.rlike(NUMERIC_TEXT), text.try_cast("double"))
    return nan_to_null(value)
