"""Analytics projections shared by charts, insights and recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.functions.numeric import to_double

INF = float("inf")


def finite_or_null(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(INF)), c)


def cost_per_day_raw(price="price", duration="duration", digits: int | None = 2) -> Column:
    """Summary variant: price / raw duration, rounded, +/-inf -> NULL."""
    v = F.try_divide(_c(price), _c(duration))
    v = F.bround(v, digits) if digits is not None else v
    return finite_or_null(v)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def defaulted_duration(duration="duration") -> Column:
    d = _c(duration)
    return F.when(d.isNull() | (d == 0), F.lit(1.0)).otherwise(d)


def cost_per_day(price="price", duration="duration") -> Column:
    """Clustering / recommender / chart variant: duration NULL or 0 -> 1 first."""
    return finite_or_null(F.try_divide(_c(price), defaulted_duration(duration)))


def with_cost_per_day(df: DataFrame) -> DataFrame:
    if "cost_per_day" in df.columns:
        return df
    return df.withColumn("cost_per_day", cost_per_day())


def analytics_projection(df: DataFrame) -> DataFrame:
    """Numeric coercion, defaulted duration, cost_per_day (kept if present) and
    categorical text where a missing value is the category 'nan'."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df.withColumns({
        "price": to_double("price", types.get("price")),
        "rating": to_double("rating", types.get("rating")),
        "duration": defaulted_duration(to_double("duration", types.get("duration"))),
    })
    out = with_cost_per_day(out)
    cats = {c: F.coalesce(F.col(c).cast("string"), F.lit("nan"))
            for c in ("location", "type", "source", "name") if c in out.columns}
    return out.withColumns(cats)


def complete_rows(df: DataFrame, subset) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any of ``subset``."""
    return df.dropna(subset=list(subset))
