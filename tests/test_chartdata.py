"""Histograms and box statistics against numpy."""

import numpy as np

from wayfarer.operators import chartdata as CD


def _vals(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


def test_linear_histogram_matches_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.normal(50, 20, 4000), 3)
    df = _vals(spark, vals)
    got = CD.histogram(df, "x", CD.PRICE_BINS).orderBy("bin").toPandas()
    nb = min(50, max(15, int(len(vals) ** 0.5)))
    counts, edges = np.histogram(vals, bins=nb)
    assert got["count"].tolist() == counts.tolist()
    assert np.allclose(got["bin_lo"], edges[:-1]) and np.allclose(got["bin_hi"], edges[1:])


def test_constant_column_histogram(spark):
    got = CD.histogram(_vals(spark, [5.0] * 20), "x", CD.fixed_bins(10)).orderBy("bin").toPandas()
    counts, edges = np.histogram(np.array([5.0] * 20), bins=10)
    assert got["count"].tolist() == counts.tolist()
    assert np.allclose(got["bin_lo"], edges[:-1])


def test_log_histogram_matches_numpy(spark):
    rng = np.random.default_rng(4)
    vals = np.concatenate([[0.0], np.round(rng.lognormal(6, 2, 3000), 2)])
    df = _vals(spark, vals)
    got = CD.price_histogram(df, "x").orderBy("bin").toPandas()
    edges = np.logspace(np.log10(max(vals.min(), 1e-6)), np.log10(vals.max()), 40)
    counts, _ = np.histogram(vals, bins=edges)
    assert len(got) == 39
    assert got["count"].tolist() == counts.tolist()


def test_box_stats(spark):
    rng = np.random.default_rng(5)
    rows = [("a", float(v)) for v in rng.normal(3, 1, 301)] + [("b", 1.0), ("b", 2.0), ("b", 9.0), ("b", 2.5)]
    df = spark.createDataFrame(rows, "type string, rating double")
    got = {r.type: r for r in CD.box_stats(df).collect()}
    for t in ("a", "b"):
        v = np.array([x for g, x in rows if g == t])
        q1, med, q3 = np.percentile(v, [25, 50, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        r = got[t]
        assert np.isclose(r.q1, q1) and np.isclose(r.median, med) and np.isclose(r.q3, q3)
        assert np.isclose(r.whisker_lo, v[v >= lo].min()) and np.isclose(r.whisker_hi, v[v <= hi].max())
        assert r.n_outliers == int(((v < lo) | (v > hi)).sum())
