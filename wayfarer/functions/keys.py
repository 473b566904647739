"""Stable row identity and reproducible pseudo-random draws.

``hash_u`` gives every row a 60-bit unsigned integer from md5 of its key and
a seed. It replaces positional random sampling: the same row always draws the
same number, so results survive task retries and can be checked in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

U_BITS = 60
U_RANGE = float(1 << U_BITS)
KEY_SEPARATOR = "\u0001"


def _field(c: Column) -> Column:
    # 'v' + text for values, 'n' for NULL, so NULL and any text stay distinct.
    return F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n"))


def listing_key(name="name", location="location", price="price", source="source") -> Column:
    """md5 over the dedup key (name, location, price, source)."""
    cols = [F.col(x) if isinstance(x, str) else x for x in (name, location, price, source)]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[_field(c) for c in cols]))


def hash_u(key, seed) -> Column:
    """Uniform 60-bit integer in [0, 2**60) derived from ``key`` and ``seed``."""
    k = F.col(key) if isinstance(key, str) else key
    s = seed if isinstance(seed, Column) else F.lit(str(seed))
    digest = F.md5(F.concat(k.cast("string"), F.lit(":"), s.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
