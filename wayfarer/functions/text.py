"""String normalisation matching Python's ``str.strip`` and CSV NA tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfarer.schema import NA_TOKENS, PY_WHITESPACE


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove leading/trailing Unicode whitespace (Spark ``trim`` only removes spaces)."""
    return F.btrim(_col(c).cast("string"), F.lit(PY_WHITESPACE))


def null_if_na_token(c) -> Column:
    """NULL when the text is blank or a CSV NA token, else the text itself."""
    c = _col(c)
    return F.when(~c.isin(NA_TOKENS), c)


def clean_review(c) -> Column:
    """Review text: missing, blank or 'nan' (any case) -> NULL, else stripped."""
    s = strip(c)
    return F.when((s != "") & (F.lower(s) != "nan"), s)
