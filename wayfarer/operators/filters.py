"""Row filters: explorer sidebar filters, preference constraints, filter domain."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.functions.text import strip


def _is_in(column: str, values: Sequence[str]) -> Column:
    """Membership of a text column in which a missing value is the text 'nan', as a predicate that a scan can take."""
    c = F.col(column).cast("string")
    found = c.isin(list(values))
    return found | c.isNull() if "nan" in values else found


def explorer_filter(df: DataFrame, price_range: tuple[float, float], rating_range: tuple[float, float],
                    locations: Sequence[str] = (), sources: Sequence[str] = (), types: Sequence[str] = (),
                    include_missing_price: bool = False, include_missing_rating: bool = False) -> DataFrame:
    """Inclusive price / rating ranges (optionally keeping NULLs), location and
    source membership (exact text), type membership (case-insensitive); empty
    lists do not filter. All predicates are plain ``where`` clauses that
    Catalyst can push into a Parquet scan."""
    p, r = F.col("price"), F.col("rating")
    mp = p.between(*price_range)
    if include_missing_price:
        mp = mp | p.isNull()
    mr = r.between(*rating_range)
    if include_missing_rating:
        mr = mr | r.isNull()
    out = df.where(mp).where(mr)
    if locations:
        out = out.where(_is_in("location", locations))
    if sources and "source" in df.columns:
        out = out.where(_is_in("source", sources))
    if types:
        tset = sorted({t.lower() for t in types})
        out = out.where(F.lower(F.coalesce(F.col("type").cast("string"), F.lit("nan"))).isin(tset))
    return out


def preference_filter(df: DataFrame, max_price: float | None = None, min_rating: float | None = None,
                      preferred_locations: Sequence[str] | None = None,
                      types: Sequence[str] | None = None) -> DataFrame:
    """Hard constraints before ranking: price <= max, rating >= min, location in
    the (stripped, lower-cased) preferences, type in the chosen types."""
    out = df
    if types:
        tset = sorted({t.lower() for t in types})
        out = out.where(F.lower(F.coalesce(F.col("type").cast("string"), F.lit("nan"))).isin(tset))
    if max_price is not None:
        out = out.where(F.col("price") <= F.lit(float(max_price)))
    if min_rating is not None:
        out = out.where(F.col("rating") >= F.lit(float(min_rating)))
    if preferred_locations:
        prefs = sorted({str(p).strip().lower() for p in preferred_locations if str(p).strip()})
        if prefs:
            loc = F.lower(F.coalesce(F.col("location").cast("string"), F.lit("nan")))
            out = out.where(loc.isin(prefs))
    return out


def filter_domain(df: DataFrame) -> DataFrame:
    """Slider ranges and option lists of the explorer, as rows.

    Columns: dimension, value, lo, hi. 'price' / 'rating' rows carry the
    default range (price: min..max, hi = lo + 1 if equal, 0..1 without data;
    rating: clamped to [0, 5], hi >= lo + 0.1, 0..5 without data). Option rows
    ('location', 'source', 'type') carry one distinct value each (type text
    stripped). All of them come from one pass over the table, by grouping sets;
    no list is gathered into a single row.
    """
    keys = ("location", "source", "type")
    rows = df.select(F.col("location").cast("string").alias("location"), F.col("source").cast("string").alias("source"),
                     strip(F.col("type")).alias("type"), "price", "rating")
    sets = rows.groupingSets([["location"], ["source"], ["type"], []], *keys).agg(
        F.grouping_id().alias("_g"), F.min("price").alias("pmin"), F.max("price").alias("pmax"),
        F.min("rating").alias("rmin"), F.max("rating").alias("rmax"))
    p_lo = F.coalesce(F.col("pmin"), F.lit(0.0))
    p_hi = F.when(F.col("pmin").isNull(), F.lit(1.0)).when(
        F.col("pmin") >= F.col("pmax"), F.col("pmin") + 1.0).otherwise(F.col("pmax"))
    r_hi_raw = F.least(F.lit(5.0), F.greatest(F.col("rmax"), F.col("rmin") + 0.1))
    r_lo = F.when(F.col("rmin").isNull(), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.col("rmin")))
    r_hi = F.when(F.col("rmin").isNull(), F.lit(5.0)).otherwise(F.least(F.lit(5.0), r_hi_raw))
    null_text, nd = F.lit(None).cast("string"), F.lit(None).cast("double")

    def row(dim, value, lo, hi):
        return F.struct(F.lit(dim).alias("dimension"), value.alias("value"), lo.alias("lo"), hi.alias("hi"))

    # the grouping id has a bit for each key that a set leaves out: 7 is the total, the others hold one key
    one = F.when(F.col("_g") == 7, F.array(row("price", null_text, p_lo, p_hi), row("rating", null_text, r_lo, r_hi)))
    for i, dim in enumerate(keys):
        one = one.when((F.col("_g") == 7 - (4 >> i)) & F.col(dim).isNotNull(), F.array(row(dim, F.col(dim), nd, nd)))
    return sets.select(F.explode(one).alias("r")).select("r.*")
