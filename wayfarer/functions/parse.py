"""Free-text price and duration parsers as native column expressions.

Behaviour kept on purpose (it is what the listing feeds produce today):
the sign is dropped, thousands separators split a number ("$1,250" -> 1.0),
scientific notation keeps only its mantissa ("1e-05" -> 1.0) and a duration
ending in "h" is read as hours ("1 month" -> 0.04).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfarer.functions.text import strip

PRICE_NUMBER = r"[0-9]+(?:[.][0-9]+)?"
DURATION_NUMBER = r"[0-9]+(?:[.,][0-9]+)?"


def _first_number_of_numeric(x: Column) -> Column:
    """First unsigned number in Python's text form of a numeric value.

    Python prints plain decimals for 1e-4 <= |x| < 1e16 and scientific
    notation outside; in the scientific case only the mantissa survives.
    """
    ax = F.abs(x)
    plain = (ax >= F.lit(1e-4)) & (ax < F.lit(1e16))
    mantissa = F.regexp_extract(x.cast("string"), PRICE_NUMBER, 0)
    return (F.when(F.isnan(x) | (ax == F.lit(float("inf"))), F.lit(None).cast("double"))
            .when(plain | (ax == 0), ax)
            .otherwise(F.when(mantissa != "", mantissa.cast("double"))))


def parse_price(c, dtype: T.DataType | None = None) -> Column:
    """Price text -> double: first ``\\d+(.\\d+)?`` after ',' and NBSP become spaces."""
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.NumericType):
        return _first_number_of_numeric(col.cast("double"))
    text = F.translate(col.cast("string"), ",\u00a0", "  ")
    m = F.regexp_extract(text, PRICE_NUMBER, 0)
    return F.when(m != "", m.cast("double"))


def parse_duration(c, dtype: T.DataType | None = None, digits: int = 2) -> Column:
    """Duration text -> days (weeks x7, hours /24), rounded half-even."""
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.NumericType):
        return F.bround(_first_number_of_numeric(col.cast("double")), digits)
    text = F.lower(strip(col))
    m = F.regexp_extract(text, DURATION_NUMBER, 0)
    value = F.when(m != "", F.regexp_replace(m, ",", ".").cast("double"))
    hours = text.contains("hour") | text.contains("hr") | text.endswith("h")
    days = (F.when(text.contains("week"), value * 7)
            .when(hours, value / 24.0)
            .otherwise(value))
    return F.bround(days, digits)
