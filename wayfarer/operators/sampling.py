"""Reproducible row caps and samples.

No ``rand()`` / ``sample()``: every row draws ``hash_u(listing_key, seed)``,
and "take n at random" means "keep the n smallest draws", which is exact,
order-independent and retry-safe. The n-th smallest draw is found by
``hash_thresholds`` (``hash_top_k`` where keys repeat or sources are very many),
so quotas and thresholds are one row per source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.functions.keys import hash_u
from wayfarer.operators.analytics import complete_rows
from wayfarer.operators.ranking import hash_thresholds, hash_top_k
from wayfarer.schema import KEY_COLUMN
from wayfarer.session import small_table

CAP_SEED = 42
FILL_SEED = 99
DEFAULT_CAP = 30_000
MAX_SOURCES = 10_000          # sources whose counts and thresholds the driver holds


def _src() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit("nan"))


def source_counts(df: DataFrame) -> DataFrame:
    """One row per source (missing -> 'nan'): _src, n_s, i (0-based in name order), k."""
    counts = df.groupBy(_src().alias("_src")).agg(F.count(F.lit(1)).alias("n_s"))
    by_name = Window.orderBy("_src")      # over the per-source table only
    return counts.select("_src", "n_s", (F.row_number().over(by_name) - 1).alias("i"),
                         F.count(F.lit(1)).over(Window.partitionBy()).alias("k"))


def _with_quota(df: DataFrame, quotas: DataFrame, max_sources: int = 100_000) -> DataFrame:
    """Attach each row's source quota; the quota table (one row per source) is
    broadcast after a size check, else joined with a shuffle."""
    q = quotas.select("_src", "quota")
    small = small_table(q, max_sources)
    return df.withColumn("_src", _src()).join(small if small is not None else q, "_src")


def _upto(u: Column, tie: Column, at: tuple) -> Column:
    return (u < F.lit(at[0])) | ((u == F.lit(at[0])) & (tie <= F.lit(at[1])))


def _few_sources(counts: DataFrame) -> list | None:
    """The per-source table on the driver, in name order; None where it has more than MAX_SOURCES rows."""
    rows = counts.limit(MAX_SOURCES + 1).collect()
    return None if len(rows) > MAX_SOURCES else sorted(rows, key=lambda r: r["_src"].encode())


def _quota_flag(d: DataFrame, sizes: dict, quota: dict, u: str, key: str) -> DataFrame | None:
    """``d`` (with _src) and ``_chosen``: the ``quota`` smallest draws of each source; None where thresholds stay unproven."""
    at = hash_thresholds(d, u, key, {s: (n, quota[s]) for s, n in sizes.items() if 0 < quota[s] < n}, "_src")
    if at is None:
        return None
    # one row a source; a source kept or dropped whole has no threshold
    rows = [(s, quota[s] >= n, *at.get(s, (None, None))) for s, n in sizes.items()]
    table = d.sparkSession.createDataFrame(rows, f"_src string, _whole boolean, _tu bigint, _tt {d.schema[key].dataType.simpleString()}")
    upto = (F.col(u) < F.col("_tu")) | ((F.col(u) == F.col("_tu")) & (F.col(key) <= F.col("_tt")))
    return (d.join(F.broadcast(table), "_src").withColumn("_chosen", F.col("_whole") | F.coalesce(upto, F.lit(False)))
            .drop("_whole", "_tu", "_tt"))


def uniform_cap(df: DataFrame, cap: int, key: str = KEY_COLUMN, seed: int = CAP_SEED) -> DataFrame:
    """``cap`` rows drawn uniformly without replacement (all rows if fewer)."""
    d = df.withColumn("_u", hash_u(key, seed))
    n = df.count()
    if n <= cap or cap <= 0:
        return df if cap > 0 else df.limit(0)
    at = hash_thresholds(d, "_u", key, {None: (n, cap)})
    if at is None:
        return hash_top_k(d, "_u", key, cap).drop("_u")
    return d.where(_upto(F.col("_u"), F.col(key), at[None])).drop("_u")


def balanced_cap(df: DataFrame, cap: int, key: str = KEY_COLUMN, seed: int = CAP_SEED,
                 fill_seed: int = FILL_SEED) -> DataFrame:
    """About equal rows per source: quota = cap // k (+1 for the first cap % k
    sources by name); a source with fewer rows gives all of them, and the
    shortfall is filled uniformly from the rows not yet taken.

    Thresholds of the draws, one per source and one for the fill, come from
    counts over the draws alone; the rows themselves are read once, with those
    as a filter.
    """
    cols, counts = df.columns, source_counts(df)
    few = _few_sources(counts)
    if few is None:
        return _balanced_cap_many_sources(df, counts, cap, key, seed, fill_seed)
    sizes = {r["_src"]: r["n_s"] for r in few}
    quota = {s: cap // len(sizes) + (i < cap % len(sizes)) for i, s in enumerate(sizes)}
    left = sum(max(n - quota[s], 0) for s, n in sizes.items())
    need = max(int(cap) - sum(min(n, quota[s]) for s, n in sizes.items()), 0)
    flagged = _quota_flag(df.withColumn("_src", _src()).withColumn("_u", hash_u(key, seed)), sizes, quota, "_u", key)
    if flagged is None:
        return _balanced_cap_many_sources(df, counts, cap, key, seed, fill_seed)
    if need == 0:
        return flagged.where("_chosen").select(*cols)
    if left <= need:
        return flagged.select(*cols)
    rest = flagged.withColumn("_u2", hash_u(key, fill_seed))
    at = hash_thresholds(rest.where("not _chosen"), "_u2", key, {None: (left, need)})
    if at is None:
        return _balanced_cap_many_sources(df, counts, cap, key, seed, fill_seed)
    return rest.where(F.col("_chosen") | _upto(F.col("_u2"), F.col(key), at[None])).select(*cols)


def _balanced_cap_many_sources(df: DataFrame, counts: DataFrame, cap: int, key: str, seed: int, fill_seed: int) -> DataFrame:
    """``balanced_cap`` with the per-source table kept on the cluster, for any hash."""
    cols = df.columns
    base = F.floor(F.lit(cap) / F.col("k"))
    quota = (base + F.when(F.col("i") < F.lit(cap) % F.col("k"), 1).otherwise(0)).cast("bigint")
    quotas = counts.withColumn("quota", quota).withColumn("take", F.least(F.col("n_s"), F.col("quota")))
    quotas = small_table(quotas) or quotas
    taken = quotas.agg(F.sum("take")).first()[0] or 0
    need = max(int(cap) - int(taken), 0)
    biggest = quotas.agg(F.max("n_s")).first()[0]
    d = _with_quota(df, quotas).withColumn("_u", hash_u(key, seed))
    flagged = hash_top_k(d, "_u", key, "quota", ["_src"], flag="_chosen", max_group_rows=biggest)
    if need == 0:
        return flagged.where("_chosen").select(*cols)
    # the fill: the chosen rows count as taken whatever their second draw, so they get none
    rest = flagged.withColumn("_u2", F.when(~F.col("_chosen"), hash_u(key, fill_seed)))
    first = hash_top_k(rest.where("_u2 is not null"), "_u2", key, need, max_group_rows=int(counts.agg(F.sum("n_s")).first()[0]))
    last = first.agg(F.max(F.struct("_u2", key)).alias("m")).first()["m"]
    if last is None:
        return flagged.where("_chosen").select(*cols)
    fill = _upto(F.col("_u2"), F.col(key), (last["_u2"], last[key]))
    return rest.where(F.col("_chosen") | F.coalesce(fill, F.lit(False))).select(*cols)


def proportional_quotas(counts: DataFrame, cap: int) -> DataFrame:
    """Largest-remainder allocation of ``cap`` over sources (ties: name order)."""
    total = F.sum("n_s").over(Window.partitionBy())
    q = counts.withColumn("_c", F.col("n_s") / total * F.lit(float(cap)))
    q = q.withColumn("_f", F.floor("_c"))
    q = q.withColumn("_need", F.lit(cap) - F.sum("_f").over(Window.partitionBy()))
    rank = F.row_number().over(Window.orderBy((F.col("_c") - F.col("_f")).desc(), F.col("_src").asc()))
    return q.withColumn("quota", (F.col("_f") + F.when(rank <= F.col("_need"), 1).otherwise(0)).cast("bigint"))


def proportional_cap(df: DataFrame, cap: int, key: str = KEY_COLUMN, seed: int = CAP_SEED) -> DataFrame:
    """Exactly ``cap`` rows stratified by source; when strata are infeasible
    (<= 1 source besides missing ones, a source with one row, cap or remainder below the number
    of sources) falls back to ``uniform_cap``."""
    counts = source_counts(df)
    few = _few_sources(counts)
    if few is not None:
        n, k = sum(r["n_s"] for r in few), len(few)
        m, named = min((r["n_s"] for r in few), default=0), sum(r["_src"] != "nan" for r in few)
    else:
        s = counts.agg(F.sum("n_s").alias("n"), F.count(F.lit(1)).alias("k"), F.min("n_s").alias("m"),
                       F.count(F.when(F.col("_src") != "nan", 1)).alias("named")).first()
        n, k, m, named = int(s["n"]), int(s["k"]), int(s["m"]), int(s["named"])
    if named <= 1 or m < 2 or cap < k or n - cap < k:
        return uniform_cap(df, cap, key, seed)
    if few is not None:
        share = {r["_src"]: r["n_s"] / n * float(cap) for r in few}
        quota = {s: math.floor(c) for s, c in share.items()}
        short = cap - sum(quota.values())
        for s in sorted(share, key=lambda s: (quota[s] - share[s], s.encode()))[:short]:
            quota[s] += 1
        flagged = _quota_flag(df.withColumn("_src", _src()).withColumn("_u", hash_u(key, seed)), {r["_src"]: r["n_s"] for r in few},
                              quota, "_u", key)
        if flagged is not None:
            return flagged.where("_chosen").select(*df.columns)
    quotas = proportional_quotas(counts, cap)
    quotas = small_table(quotas) or quotas
    d = _with_quota(df, quotas).withColumn("_u", hash_u(key, seed))
    return hash_top_k(d, "_u", key, "quota", ["_src"], max_group_rows=n).select(*df.columns)


def cap_policy(df: DataFrame, cap: int | None = DEFAULT_CAP, proportional: bool = False,
               key: str = KEY_COLUMN) -> DataFrame:
    """No cap (None / 0) or n <= cap: unchanged. Otherwise proportional (if
    asked), else balanced when there are several non-missing sources, else
    uniform."""
    if not cap:
        return df
    s = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source").alias("k")).first()
    if s["n"] <= cap:
        return df
    if proportional:
        return proportional_cap(df, cap, key)
    if s["k"] > 1:
        return balanced_cap(df, cap, key)
    return uniform_cap(df, cap, key)


def scatter_sample(df: DataFrame, max_points: int = 4000, color_by: str = "type",
                   key: str = KEY_COLUMN, seed: int = CAP_SEED) -> DataFrame:
    """Points for a price-vs-rating scatter: rows having both, at most
    ``max_points`` of them, with hover columns and the colour column."""
    sub = complete_rows(df, ["price", "rating"])
    sub = uniform_cap(sub, max_points, key, seed)
    hover = [c for c in ("name", "location", "type", "source") if c in df.columns]
    color = [color_by] if color_by in df.columns and color_by not in hover else []
    return sub.select("price", "rating", *hover, *color, key)
