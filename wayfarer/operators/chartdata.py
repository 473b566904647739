"""Chart data: histograms, box statistics, tier counts.

Histograms follow numpy's equal-width binning exactly (index from the scaled
offset, corrected against the linspace edges, right edge closed); a one-row
statistics subquery supplies min / max / n, so no join is needed to bin.
Every bin is returned, empty ones with count 0.
"""

from __future__ import annotations

import math
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.operators.ranking import exact_quantiles
from wayfarer.session import small_table

BinsRule = Callable[[int], int]


def bins_between(lo: int, hi: int, root: float = 0.5) -> BinsRule:
    """n -> min(hi, max(lo, int(n ** root)))."""
    return lambda n: min(hi, max(lo, math.floor(float(n) ** root)))


def fixed_bins(k: int) -> BinsRule:
    return lambda n: int(k)


PRICE_BINS = bins_between(15, 50)           # static price histogram (linear case)
RATING_BINS = bins_between(10, 35, 0.25)    # static rating histogram
RATING_BINS_DASHBOARD = bins_between(15, 40, 0.25)
COST_BINS = bins_between(20, 50)            # dashboard cost / day
EXPLORER_PRICE_BINS = bins_between(15, 45)
SENTIMENT_BINS = fixed_bins(32)
SENTIMENT_BINS_DASHBOARD = fixed_bins(30)
LOG_EDGES = 40


def _values(df: DataFrame, column: str) -> DataFrame:
    v = F.col(column).cast("double")
    return df.select(v.alias("_x")).where(v.isNotNull() & ~F.isnan(v))


def histogram(df: DataFrame, column: str, rule: BinsRule, n_rule_rows: DataFrame | None = None) -> DataFrame:
    """Equal-width histogram of a column: bin, bin_lo, bin_hi, count.

    ``rule`` maps the number of values (or of ``n_rule_rows`` rows) to a bin
    count. A constant column gets the range [v - 0.5, v + 0.5].
    """
    vals = _values(df, column)
    st = vals.agg(F.min("_x").alias("mn"), F.max("_x").alias("mx"), F.count(F.lit(1)).alias("n")).first()
    if not st["n"]:
        return df.sparkSession.createDataFrame([], "bin int, bin_lo double, bin_hi double, count bigint")
    n_rule = st["n"] if n_rule_rows is None else n_rule_rows.count()
    nb = F.lit(rule(n_rule))
    lo_v, hi_v = (st["mn"] - 0.5, st["mx"] + 0.5) if st["mn"] == st["mx"] else (st["mn"], st["mx"])
    lo, hi = F.lit(float(lo_v)), F.lit(float(hi_v))
    step = (hi - lo) / nb
    norm = nb / (hi - lo)

    def edge(k: Column) -> Column:
        return F.when(k == nb, hi).otherwise(k * step + lo)

    x = F.col("_x")
    i0 = F.floor((x - lo) * norm)
    i0 = F.when(i0 >= nb, nb - 1).otherwise(i0)
    binned = vals.withColumn("_i0", i0)
    i = F.col("_i0")
    binned = binned.withColumn("_i", F.when(x < edge(i), i - 1).when((x >= edge(i + 1)) & (i != nb - 1), i + 1)
                                .otherwise(i))
    counts = binned.groupBy(F.col("_i").cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), nb - 1)).alias("bin"))
    out = all_bins.join(counts, "bin", "left")
    b = F.col("bin")
    return out.select(b, edge(b).alias("bin_lo"), edge(b + 1).alias("bin_hi"),
                      F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))


def log_histogram(df: DataFrame, column: str = "price", edges: int = LOG_EDGES) -> DataFrame:
    """Histogram over ``edges`` log-spaced edges from max(min, 1e-6) to max:
    bin k holds [e_k, e_k+1), the last bin also its right edge; values
    outside the edges are not counted."""
    vals = _values(df, column)
    st = vals.agg(F.min("_x").alias("mn"), F.max("_x").alias("mx")).first()
    if st["mx"] is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_lo double, bin_hi double, count bigint")
    a = F.log10(F.greatest(F.lit(float(st["mn"])), F.lit(1e-6)))
    b = F.log10(F.lit(float(st["mx"])))
    nb = edges - 1
    step = (b - a) / nb

    def edge(k: Column) -> Column:
        return F.pow(F.lit(10.0), F.when(k == nb, b).otherwise(k * step + a))

    x = F.col("_x")
    i0 = F.floor((F.log10(x) - a) / step)
    i0 = F.least(F.greatest(i0, F.lit(0)), F.lit(nb - 1))
    binned = vals.where(x > 0).withColumn("_i0", i0)
    i = F.col("_i0")
    binned = binned.withColumn("_i", F.when(x < edge(i), i - 1).when((i < nb - 1) & (x >= edge(i + 1)), i + 1)
                                .otherwise(i))
    inside = binned.where((x >= edge(F.lit(0))) & (x <= edge(F.lit(nb))) & (F.col("_i") >= 0))
    counts = inside.groupBy(F.col("_i").cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("bin"))
    out = all_bins.join(counts, "bin", "left")
    bcol = F.col("bin")
    return out.select(bcol, edge(bcol).alias("bin_lo"), edge(bcol + 1).alias("bin_hi"),
                      F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))


def price_histogram(df: DataFrame, column: str = "price") -> DataFrame:
    """Static price chart data: log bins for a wide range, linear otherwise.
    The switch is data-dependent, so it is decided from one small aggregate."""
    row = _values(df, column).agg(F.min("_x").alias("mn"), F.max("_x").alias("mx")).first()
    mn, mx = row["mn"], row["mx"]
    if mx is not None and mx > 0 and mx / max(mn, 1e-9) > 50:
        return log_histogram(df, column)
    return histogram(df, column, PRICE_BINS)


def box_stats(df: DataFrame, value: str = "rating", group: str = "type", whisker: float = 1.5) -> DataFrame:
    """Per group: n, q1, median, q3 (linear interpolation), whisker ends (most
    extreme values within ``whisker`` x IQR of the quartiles) and outliers.

    The quartiles are selected for all groups together; the rest is one more
    map-side-combined aggregate against them.
    """
    sub = df.where(F.col(group).isNotNull()).select(group, value)
    q = exact_quantiles(sub, value, [0.25, 0.5, 0.75], [group], ["q1", "median", "q3"])
    small = small_table(q)
    v = F.col(value)
    j = sub.where(v.isNotNull() & ~F.isnan(v)).join(small if small is not None else q, group)
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - whisker * iqr, F.col("q3") + whisker * iqr
    return j.groupBy(group, "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(v >= lo_f, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi_f, v)).alias("whisker_hi"),
        F.count_if((v < lo_f) | (v > hi_f)).alias("n_outliers"),
        F.min(v).alias("min"), F.max(v).alias("max"))


def tier_counts(df: DataFrame, label: str = "cluster_label") -> DataFrame:
    """Listings per tier label, largest first."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), F.col(label))
