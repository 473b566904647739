"""Hotel-booking-demand table -> listing rows.

Rows are numbered 1..n in an explicit total order (a file's row order is not
meaningful on a distributed scan); the number becomes part of the listing
name, the optional row limit applies to it before any filter, and rows
without a price are dropped after numbering, so numbering gaps remain.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.functions.numeric import to_double
from wayfarer.functions.text import null_if_na_token, strip
from wayfarer.operators.mapping import normalize_headers
from wayfarer.operators.ranking import consecutive_index
from wayfarer.schema import LISTING_COLUMNS

REQUIRED = ["hotel", "country", "adr", "stays_in_weekend_nights", "stays_in_week_nights"]
SOURCE_LABEL = "kaggle:hotel_booking_demand"
NAME_JOIN = " — booking "


def transform_booking_demand(df: DataFrame, order_cols: Sequence | None = None,
                             max_rows: int | None = None) -> DataFrame:
    """Map normalised booking rows to listings; raises ValueError when a
    required column is missing."""
    work = normalize_headers(df, underscores=True)
    missing = sorted(set(REQUIRED) - set(work.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}; found {work.columns[:30]}")
    order = list(order_cols) if order_cols else [F.col(c).asc_nulls_last() for c in work.columns]
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    types = {f.name: f.dataType for f in work.schema.fields}
    if max_rows is not None and max_rows > 0:
        work = work.orderBy(*order).limit(int(max_rows))   # only the head is numbered
    numbered = consecutive_index(work, order, "_row")

    def num(c: str) -> Column:
        return F.coalesce(to_double(c, types[c]), F.lit(0.0))

    duration = F.greatest(F.lit(1.0), num("stays_in_weekend_nights") + num("stays_in_week_nights"))
    hotel = strip(F.coalesce(F.col("hotel").cast("string"), F.lit("nan")))
    country = null_if_na_token(strip(F.coalesce(F.col("country").cast("string"), F.lit("nan"))))
    out = numbered.select(
        F.concat(hotel, F.lit(NAME_JOIN), F.col("_row").cast("string")).alias("name"),
        F.lit("hotel").alias("type"),
        country.alias("location"),
        to_double("adr", types["adr"]).alias("price"),
        duration.alias("duration"),
        F.lit(None).cast("double").alias("rating"),
        F.lit(SOURCE_LABEL).alias("source"),
        F.lit(None).cast("string").alias("review_text"),
    )
    return out.where(F.col("price").isNotNull()).select(*LISTING_COLUMNS)


def booking_demand_or_empty(df: DataFrame, **kw) -> DataFrame:
    """The import job's behaviour: an unexpected layout yields an empty table."""
    from wayfarer.operators.mapping import empty_listings
    try:
        return transform_booking_demand(df, **kw)
    except ValueError:
        return empty_listings(df.sparkSession)
