"""Caps and samples: sizes, quotas, fallbacks."""

import pytest
from pyspark.sql import functions as F

from wayfarer.functions.keys import listing_key
from wayfarer.operators import sampling as S


def _listings(spark, sizes):
    rows = []
    for src, n in sizes.items():
        rows += [(f"{src}-{i}", float(i), 4.0, src) for i in range(n)]
    df = spark.createDataFrame(rows, "name string, price double, rating double, source string")
    return df.withColumn("location", F.lit("L")).withColumn("listing_key", listing_key())


def test_balanced_cap_quota_and_fill(spark):
    df = _listings(spark, {"a": 500, "b": 400, "c": 30})
    out = S.balanced_cap(df, 301)
    counts = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert sum(counts.values()) == 301
    assert counts["c"] == 30                       # short source gives everything
    assert counts["a"] >= 101 and counts["b"] >= 100
    assert out.select("listing_key").distinct().count() == 301


def test_balanced_cap_is_deterministic(spark):
    df = _listings(spark, {"a": 300, "b": 300})
    a = sorted(r.listing_key for r in S.balanced_cap(df.repartition(3), 101).collect())
    b = sorted(r.listing_key for r in S.balanced_cap(df.repartition(11), 101).collect())
    assert a == b


def test_proportional_cap_exact_and_fallback(spark):
    df = _listings(spark, {"a": 600, "b": 300, "c": 100})
    out = S.proportional_cap(df, 100)
    counts = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert counts == {"a": 60, "b": 30, "c": 10}
    one = _listings(spark, {"a": 600, "b": 1})     # a one-row stratum -> uniform
    assert S.proportional_cap(one, 50).count() == 50


@pytest.mark.parametrize("cap", [0, None, 10_000])
def test_cap_policy_no_cap(spark, cap):
    df = _listings(spark, {"a": 50, "b": 50})
    assert S.cap_policy(df, cap).count() == 100


def test_cap_policy_single_source_uniform(spark):
    df = _listings(spark, {"a": 200})
    assert S.cap_policy(df, 70).count() == 70


def test_cap_below_number_of_sources(spark):
    df = _listings(spark, {"a": 20, "b": 20, "c": 20})
    out = S.balanced_cap(df, 2)
    assert out.count() == 2


def test_scatter_sample(spark):
    df = _listings(spark, {"a": 100}).withColumn("rating", F.when(F.col("price") < 10, None).otherwise(4.0))
    out = S.scatter_sample(df.withColumn("type", F.lit("t")), 50)
    assert out.count() == 50 and out.where(F.col("rating").isNull()).count() == 0


def test_caps_agree_with_the_path_for_many_sources(spark, monkeypatch):
    df = _listings(spark, {"a": 500, "b": 400, "c": 30, "d": 1, "é": 77}).withColumn(
        "source", F.when(F.col("source") != "d", F.col("source")))
    keys = lambda d: sorted(r.listing_key for r in d.collect())
    for cap in (7, 301, 900, 1007, 5000):
        a, b = keys(S.balanced_cap(df, cap)), keys(S.proportional_cap(df.where("source is not null"), cap))
        assert len(a) == min(cap, 1008) and len(b) == min(cap, 1007)
        with monkeypatch.context() as m:
            m.setattr(S, "MAX_SOURCES", 2)
            assert keys(S.balanced_cap(df, cap)) == a and keys(S.proportional_cap(df.where("source is not null"), cap)) == b


def test_caps_of_repeated_keys(spark):
    """A third of the rows share one key, so their draws are no uniform sample: the counts show it and the general path serves."""
    df = _listings(spark, {"a": 300, "b": 300}).withColumn(
        "listing_key", F.when(F.col("price") % 3 == 0, F.lit("same")).otherwise(F.col("listing_key")))
    for cap in (50, 150, 420):
        assert S.uniform_cap(df, cap).count() >= cap and S.balanced_cap(df, cap).count() >= cap


def test_thresholds_are_exact(spark):
    from wayfarer.functions.keys import hash_u
    from wayfarer.operators.ranking import hash_thresholds

    df = _listings(spark, {"a": 3000, "b": 40}).withColumn("u", hash_u("listing_key", 5))
    rows = df.select("source", "u", "listing_key").collect()
    order = {s: sorted((r.u, r.listing_key) for r in rows if r.source == s) for s in "ab"}
    for ka, kb in ((1, 39), (1500, 20), (2999, 1)):
        got = hash_thresholds(df, "u", "listing_key", {"a": (3000, ka), "b": (40, kb)}, "source")
        assert got == {"a": order["a"][ka - 1], "b": order["b"][kb - 1]}
    assert hash_thresholds(df, "u", "listing_key", {}) == {}
    assert hash_thresholds(df.withColumn("u", F.lit(0).cast("long")), "u", "listing_key", {None: (3040, 2000)}) is None
