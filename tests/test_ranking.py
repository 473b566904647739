"""Distributed ranking primitives against brute force, including a hot group."""

import numpy as np
from pyspark.sql import functions as F

from wayfarer.functions.keys import hash_u
from wayfarer.operators.ranking import (
    consecutive_index, exact_quantiles, hash_top_k, ranked_values, row_at_hash_rank,
)


def _skewed(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    g = np.where(np.arange(n) < n // 3, "hot", rng.choice(["a", "b", "c", "d"], n))
    v = np.round(rng.lognormal(3, 2, n), 2)
    v[::17] = np.nan
    rows = [(int(i), str(g[i]), None if np.isnan(v[i]) else float(v[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, g string, v double")


def test_exact_quantiles_match_numpy(spark):
    df = _skewed(spark)
    pdf = df.toPandas()
    qs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r["g"]: r for r in exact_quantiles(df, "v", qs, ["g"]).collect()}
    for g, part in pdf.dropna().groupby("g"):
        want = np.percentile(part["v"].to_numpy(), [q * 100 for q in qs])
        for q, w in zip(qs, want):
            assert abs(got[g][f"q{int(round(q * 100))}"] - w) <= 1e-9 * max(1.0, abs(w))
    glob = exact_quantiles(df, "v", [0.5], names=["m"]).first()["m"]
    assert abs(glob - np.median(pdf["v"].dropna())) < 1e-9


def test_exact_quantiles_ties_and_single(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 1.0), ("x", 1.0), ("y", 5.0), ("z", None)], "g string, v double")
    got = {r.g: r.q50 for r in exact_quantiles(df, "v", [0.5], ["g"]).collect()}
    assert got == {"x": 1.0, "y": 5.0}


def test_ranked_values_below(spark):
    df = _skewed(spark)
    pdf = df.toPandas().dropna()
    r = ranked_values(df, "v", ["g"]).toPandas()
    for _, row in r.sample(200, random_state=1).iterrows():
        part = pdf[pdf.g == row.g]["v"]
        assert row.below == (part < row.v).sum()
        assert row.cnt == (part == row.v).sum()


def test_hash_top_k_matches_sort(spark):
    df = _skewed(spark).withColumn("key", F.col("id").cast("string"))
    d = df.withColumn("u", hash_u("key", 3))
    pdf = d.toPandas()
    for k in (0, 1, 57, 1000, 5000):
        got = {r.key for r in hash_top_k(d, "u", "key", k).collect()}
        want = set(pdf.sort_values(["u", "key"]).head(k)["key"])
        assert got == want
    got_g = hash_top_k(d.withColumn("k", F.lit(40)), "u", "key", "k", ["g"]).toPandas()
    want_g = pdf.sort_values(["u", "key"]).groupby("g").head(40)
    assert set(got_g["key"]) == set(want_g["key"])
    flagged = hash_top_k(d, "u", "key", 100, flag="sel").toPandas()
    assert len(flagged) == len(pdf) and flagged["sel"].sum() == 100


def test_row_at_hash_rank(spark):
    d = spark.range(500).withColumn("key", F.col("id").cast("string")).withColumn("u", hash_u("key", 5))
    order = d.toPandas().sort_values(["u", "key"])["key"].tolist()
    for r in (0, 1, 250, 499):
        assert row_at_hash_rank(d, "u", "key", r).first().key == order[r]
    assert row_at_hash_rank(d, "u", "key", 500).count() == 0


def test_consecutive_index(spark):
    df = _skewed(spark, 800)
    out = consecutive_index(df, [F.col("g").asc(), F.col("v").asc_nulls_last(), F.col("id").asc()], "idx", 5)
    got = out.orderBy("idx").toPandas()
    want = df.toPandas().sort_values(["g", "v", "id"], na_position="last")
    assert got["idx"].tolist() == list(range(1, 801))
    assert got["id"].tolist() == want["id"].tolist()


def test_exact_quantiles_of_a_hot_group(spark):
    df = _skewed(spark, 2000, 9)
    qs = [0.1, 0.25, 0.5, 0.75]
    got = {r["g"]: tuple(r[1:]) for r in exact_quantiles(df, "v", qs, ["g"]).collect()}
    rows = df.where("v is not null").toPandas().groupby("g")["v"]
    assert set(got) == set(rows.groups)
    for k, v in rows:
        assert np.allclose(got[k], np.quantile(v, qs))


def test_exact_quantiles_over_all_magnitudes(spark, monkeypatch):
    """Negative, tiny, huge and infinite values; bins of a few rows are cut again and again."""
    import wayfarer.operators.ranking as R

    rng = np.random.default_rng(11)
    v = np.concatenate([rng.normal(0, 1, 400) * 10.0 ** rng.integers(-300, 300, 400), 7 + rng.random(900) * 1e-9, np.full(50, 7.0),
                        [0.0, -0.0, 5e-324, -5e-324, np.inf, -np.inf, np.inf], -np.round(rng.random(300), 1)])
    rng.shuffle(v)
    df = spark.createDataFrame([(("a", "b", "hot", "hot")[i % 4], float(x)) for i, x in enumerate(v)], "g string, v double")
    qs = [0.01, 0.1, 0.33, 0.5, 0.75, 0.9]
    for limit in (R.EDGE_LIMIT, 20):
        monkeypatch.setattr(R, "EDGE_LIMIT", limit)
        got = {r["g"]: r for r in exact_quantiles(df, "v", qs, ["g"]).collect()}
        for g in ("a", "b", "hot"):
            part = np.sort([x for i, x in enumerate(v) if ("a", "b", "hot", "hot")[i % 4] == g])
            for q in qs:
                pos = (len(part) - 1) * q
                lo, hi = part[int(np.floor(pos))], part[int(np.ceil(pos))]
                want = lo if pos == np.floor(pos) else lo + (hi - lo) * (pos - np.floor(pos))
                assert got[g][f"q{int(round(q * 100))}"] == want
        assert exact_quantiles(df.where("g = 'hot'"), "v", [0.5], names=["m"]).count() == 1
        assert exact_quantiles(df.where("v > 1 and v < 1"), "v", [0.5], ["g"]).count() == 0


def test_exact_quantiles_sort_nothing(spark):
    """No range sort and no sort of rows: only bins, and the values of the wanted bins, are put in order."""
    df = _skewed(spark)
    plan = exact_quantiles(df, "v", [0.25, 0.5], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "BroadcastHashJoin" in plan
