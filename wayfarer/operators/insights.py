"""Summaries, rankings and KPIs over a listing table.

Floating results take ``digits``: the listing reports' own rounding is the
default; ``None`` leaves values unrounded. Rounding is half-even (``bround``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.operators.analytics import cost_per_day_raw
from wayfarer.operators.ranking import exact_quantiles
from wayfarer.schema import KEY_COLUMN


def _r(c: Column, digits: int | None) -> Column:
    return F.bround(c, digits) if digits is not None else c


def _tie(df: DataFrame) -> list[Column]:
    return [F.col(KEY_COLUMN).asc()] if KEY_COLUMN in df.columns else []


def type_summary(df: DataFrame, digits: int | None = 2) -> DataFrame:
    """Per type: mean price, exact median price, mean rounded cost/day, count(name)."""
    work = df.where(F.col("type").isNotNull()).withColumn("_cpd", cost_per_day_raw("price", "duration", 2))
    base = work.groupBy("type").agg(
        F.avg("price").alias("avg_price"),
        F.avg("_cpd").alias("avg_cost_per_day"),
        F.count("name").alias("count"))
    med = exact_quantiles(work, "price", [0.5], ["type"], names=["median_price"])
    out = base.join(med, "type", "left")
    return out.select(
        "type", _r(F.col("avg_price"), digits).alias("avg_price"),
        _r(F.col("median_price"), digits).alias("median_price"),
        _r(F.col("avg_cost_per_day"), digits).alias("avg_cost_per_day"),
        F.col("count")).orderBy("type")


def popular_destinations(df: DataFrame, digits: int | None = 3) -> DataFrame:
    """Per location: listings = count(name), mean price, mean rating; most listings first."""
    out = (df.where(F.col("location").isNotNull()).groupBy("location")
           .agg(F.count("name").alias("listings"), F.avg("price").alias("avg_price"),
                F.avg("rating").alias("avg_rating")))
    return out.select("location", "listings", _r(F.col("avg_price"), digits).alias("avg_price"),
                      _r(F.col("avg_rating"), digits).alias("avg_rating")) \
        .orderBy(F.col("listings").desc(), F.col("location").asc())


def price_rating_stats(df: DataFrame, digits: int | None = None) -> DataFrame:
    """One row: Pearson r of price vs rating (NULL unless n > 2 and both spreads > 0),
    n_points, mean_price, mean_rating over rows having both."""
    sub = df.where(F.col("price").isNotNull() & F.col("rating").isNotNull())
    agg = sub.agg(F.corr("price", "rating").alias("_r"), F.count(F.lit(1)).alias("n_points"),
                  F.avg("price").alias("mean_price"), F.avg("rating").alias("mean_rating"),
                  F.stddev_samp("price").alias("_sp"), F.stddev_samp("rating").alias("_sr"))
    ok = (F.col("n_points") > 2) & (F.col("_sp") > 0) & (F.col("_sr") > 0)
    return agg.select(
        _r(F.when(ok, F.col("_r")), digits).alias("pearson_correlation_price_rating"),
        F.col("n_points"), _r(F.col("mean_price"), digits).alias("mean_price"),
        _r(F.col("mean_rating"), digits).alias("mean_rating"))


def top_price_locations(df: DataFrame, n: int = 15, digits: int | None = None) -> DataFrame:
    """Top-n locations by mean price (a TakeOrderedAndProject, no full sort)."""
    out = (df.where(F.col("price").isNotNull() & F.col("location").isNotNull())
           .groupBy("location").agg(F.avg("price").alias("price")))
    return (out.orderBy(F.col("price").desc(), F.col("location").asc()).limit(n)
            .select("location", _r(F.col("price"), digits).alias("price")))


def kpis(df: DataFrame, filtered: DataFrame | None = None, digits: int | None = None) -> DataFrame:
    """One row of headline numbers: filtered rows / mean / median price / mean
    rating, and over all rows: distinct sources, distinct locations, rows.
    A missing source / location counts as the category 'nan'."""
    filtered = df if filtered is None else filtered
    med = exact_quantiles(filtered, "price", [0.5], names=["median_price"]).select("median_price").scalar()
    over_all = df.agg(F.count_distinct(F.coalesce(F.col("source").cast("string"), F.lit("nan"))).alias("s"),
                      F.count_distinct(F.coalesce(F.col("location").cast("string"), F.lit("nan"))).alias("l"),
                      F.count(F.lit(1)).alias("n"))
    return filtered.agg(
        F.count(F.lit(1)).alias("rows_filtered"),
        _r(F.avg("price"), digits).alias("avg_price"),
        _r(med, digits).alias("median_price"),
        _r(F.avg("rating"), digits).alias("avg_rating"),
        over_all.select("s").scalar().alias("n_sources"),
        over_all.select("l").scalar().alias("n_locations"),
        over_all.select("n").scalar().alias("rows_loaded"))


def source_share(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Listings per source (missing -> 'nan') and share of all rows, largest first."""
    src = F.coalesce(F.col("source").cast("string"), F.lit("nan"))
    total = df.agg(F.count(F.lit(1))).scalar()
    out = df.groupBy(src.alias("source")).agg(F.count(F.lit(1)).alias("count"))
    return out.select("source", "count", _r(F.col("count") / total, digits).alias("share")) \
        .orderBy(F.col("count").desc(), F.col("source").asc())


def top_locations(df: DataFrame, n: int = 12, count_names: bool = False) -> DataFrame:
    """Top-n locations by listing count.

    Explorer flavour (default): count(*) with a missing location as 'nan'.
    Dashboard flavour (``count_names``): count(name), missing locations dropped.
    """
    if count_names:
        out = df.where(F.col("location").isNotNull()).groupBy("location").agg(
            F.count("name").alias("listings"))
    else:
        loc = F.coalesce(F.col("location").cast("string"), F.lit("nan"))
        out = df.groupBy(loc.alias("location")).agg(F.count(F.lit(1)).alias("listings"))
    return out.orderBy(F.col("listings").desc(), F.col("location").asc()).limit(max(1, n))


def price_quantile(df: DataFrame, q: float = 0.75, name: str = "price_p75") -> DataFrame:
    """One row: the exact q-quantile of price (default budget = 75th percentile)."""
    return exact_quantiles(df, "price", [q], names=[name])


def best_rated(df: DataFrame, n: int = 25) -> DataFrame:
    """Top-n by rating desc then price asc (NULLs last), key breaks ties."""
    cols = [c for c in ("name", "location", "rating", "price", "source", "sentiment_compound") if c in df.columns]
    if KEY_COLUMN in df.columns:
        cols.append(KEY_COLUMN)
    order = [F.col("rating").desc_nulls_last(), F.col("price").asc_nulls_last(), *_tie(df)]
    return df.orderBy(*order).limit(n).select(*cols)


def preview(df: DataFrame, n: int = 1000) -> DataFrame:
    """The first n rows in key order."""
    n = max(0, int(n))
    return df.orderBy(*_tie(df)).limit(n)
