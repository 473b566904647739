"""Column-only cosine similarity against dense one-hot vectors in numpy."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from wayfarer.functions.keys import listing_key
from wayfarer.operators import recommend as R


def _listings(spark, n=240, seed=11):
    rng = np.random.default_rng(seed)
    locs = [f"L{i}" for i in range(20)] + [None]
    rows = [(f"n{i}", str(rng.choice(["Hotel", "tour", "offer"])), locs[rng.integers(0, 21)],
             float(rng.integers(10, 500)), float(rng.integers(0, 5)),
             None if i % 9 == 0 else float(rng.integers(1, 6)), "s") for i in range(n)]
    df = spark.createDataFrame(rows, "name string, type string, location string, price double, duration double, "
                                     "rating double, source string")
    return df.withColumn("listing_key", listing_key())


def _dense(pdf):
    num = pdf[["price", "duration", "rating", "cost_per_day"]].to_numpy(float)
    z = (num - num.mean(0)) / np.where(num.std(0) > 0, num.std(0), 1.0)
    loc = pdf["location"].fillna("nan").astype(str)
    counts = loc.value_counts()
    order = sorted(counts.index, key=lambda x: (-counts[x], x))[:15]
    bucket = loc.where(loc.isin(order), "Other")
    oh = pd.get_dummies(pd.DataFrame({"b": bucket, "t": pdf["type"].fillna("nan").str.lower()}), dtype=float)
    return np.hstack([z, oh.to_numpy()])


def _prep_pandas(df):
    pdf = df.toPandas()
    pdf["duration"] = pdf["duration"].replace(0, 1.0).fillna(1.0)
    pdf["rating"] = pdf["rating"].fillna(pdf["rating"].median())
    pdf["cost_per_day"] = pdf["price"] / pdf["duration"]
    return pdf.sort_values("listing_key").reset_index(drop=True)


def test_similar_listings_match_dense(spark):
    df = _listings(spark)
    pdf = _prep_pandas(df)
    x = _dense(pdf)
    feats = R.features(R.prepare_numeric(df))
    q = feats.orderBy("listing_key").limit(1)
    got = R.similar_listings(feats, q, 5).toPandas()
    qi = 0
    xn = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = xn @ xn[qi]
    sims[qi] = -np.inf
    order = sorted(range(len(sims)), key=lambda i: (-sims[i], pdf["listing_key"][i]))[:5]
    assert got["listing_key"].tolist() == pdf["listing_key"][order].tolist()
    assert np.allclose(got["similarity"], sims[order])
    assert pdf["listing_key"][qi] not in set(got["listing_key"])


def test_recommend_preferences_match_dense(spark):
    df = _listings(spark, 300, 12)
    got = R.recommend_preferences(df, max_price=400.0, min_rating=2.0, preferred_locations=[" l1 ", "L2", "l3"],
                                  top_k=6).toPandas()
    pdf = _prep_pandas(df)
    work = pdf[(pdf.price <= 400) & (pdf.rating >= 2) & pdf.location.fillna("nan").str.lower().isin({"l1", "l2", "l3"})]
    work = work.reset_index(drop=True)
    x = _dense(work)
    ideal = np.median(x, axis=0)
    sims = (x @ ideal) / (np.linalg.norm(x, axis=1) * np.linalg.norm(ideal))
    order = sorted(range(len(sims)), key=lambda i: (-sims[i], work["listing_key"][i]))[:6]
    assert got["listing_key"].tolist() == work["listing_key"][order].tolist()
    assert np.allclose(got["similarity_to_ideal"], sims[order])


def test_preferences_single_survivor_and_none(spark):
    df = _listings(spark, 60, 13)
    one = R.recommend_preferences(df, max_price=10.5)
    rows = one.collect()
    assert len(rows) <= 1 and all(r.similarity_to_ideal is None for r in rows)
    assert R.recommend_preferences(df, preferred_locations=["nowhere"]).count() == 0


def test_batch_recommend_seeds(spark):
    df = _listings(spark, 50, 14)
    feats = R.features(R.prepare_numeric(df))
    out = R.batch_recommend(feats, None, 3).toPandas()
    n = feats.count()
    assert sorted(out["seed_index"].unique().tolist()) == [0, n // 2, n - 1]
    assert (out.groupby("seed_index").size() == 3).all()
    assert (out["listing_key"] != out["query_key"]).all()


def test_batch_edge_cases(spark):
    rows = [(f"n{i}", "t", "x", float(10 + i), 1.0, 4.0, "s", None, f"k{i}") for i in range(6)]
    schema = ("name string, type string, location string, price double, duration double, rating double, source string, "
              "review_text string, listing_key string")
    feats = R.features(R.prepare_numeric(spark.createDataFrame(rows, schema)))
    full = R.batch_recommend(feats, [0, 2, 5, 99, -1], 2)
    got = full.collect()
    assert sorted({r.seed_index for r in got}) == [0, 2, 5] and len(got) == 6
    for s in (0, 2, 5):
        want = R.similar_listings(feats, R.row_at(feats, s).drop("_order_u"), 2).collect()
        assert [(r.listing_key, round(r.similarity, 9)) for r in want] == [
            (r.listing_key, round(r.similarity, 9)) for r in sorted((g for g in got if g.seed_index == s),
                                                                    key=lambda g: (-g.similarity, g.listing_key))]
    none = R.batch_recommend(feats, [77], 2)
    assert none.columns == full.columns and none.count() == 0
    one = R.batch_recommend(R.features(R.prepare_numeric(spark.createDataFrame(rows[:1], schema))), None, 2)
    assert one.columns == full.columns and one.count() == 0


def test_many_seeds_by_blocks(spark):
    n = 6000
    df = _listings(spark, n, 15).withColumn("price", F.round(F.col("price") + F.rand(3) * 100, 2))
    df = df.withColumn("listing_key", listing_key())
    feats = R.materialize(R.features(R.prepare_numeric(df)))
    seeds = list(range(0, n, 120)) + [n + 5]
    order = lambda d: sorted((r.seed_index, r.query_key, r.listing_key, round(r.similarity, 12)) for r in d.collect())
    got, want = R.batch_recommend(feats, seeds, 4), R.batch_recommend(feats, seeds, 4, few_seeds=1000)
    assert got.columns == want.columns and order(got) == order(want) and got.count() == 4 * 50
    blocked = R._with_blocks(feats)
    found = R.rows_at(feats, seeds[:-1])
    asked = R.candidate_blocks(blocked, R._seed_array(found), 4)
    assert asked.agg(F.sum("_rows")).first()[0] < n * 50 / 10


def test_many_seeds_of_equal_and_few_rows(spark):
    rows = [(f"n{i}", None if i % 4 == 0 else "t", None, 10.0 + (i >= 30), 1.0, 4.0, "s", None, f"k{i:03d}") for i in range(40)]
    schema = ("name string, type string, location string, price double, duration double, rating double, source string, "
              "review_text string, listing_key string")
    for part in (rows, rows[:3]):
        feats = R.features(R.prepare_numeric(spark.createDataFrame(part, schema)))
        seeds = list(range(len(part)))
        by = lambda d: sorted((r.seed_index, r.listing_key, round(r.similarity, 12)) for r in d.collect())
        assert by(R.batch_recommend(feats, seeds, 5, few_seeds=0)) == by(R.batch_recommend(feats, seeds, 5))


def test_type_filter_comes_before_the_fill(spark):
    ratings = [("x", None), ("x", 5.0), ("x", 5.0)] + [("y", 1.0)] * 4
    rows = [(f"n{i}", t, "l", 10.0 + i, 1.0, r, "s", None, f"k{i}") for i, (t, r) in enumerate(ratings)]
    df = spark.createDataFrame(rows, "name string, type string, location string, price double, duration double, rating double, "
                                     "source string, review_text string, listing_key string")
    assert R.recommend_preferences(df, min_rating=4.0, types=["X"]).count() == 3


def test_few_seeds_rank_only_rows_that_can_win(spark):
    schema = "listing_key string, name string, type string, location string, price double, duration double, rating double, source string, review_text string"
    rows = [(f"k{i}", f"n{i}", f"t{i % 5}", f"L{i % 9}", float(i * 37 % 1009), float(1 + i % 11), float(i % 7), "s", None) for i in range(6000)]
    feats = R.features(R.prepare_numeric(spark.createDataFrame(rows + rows[:40], schema))).persist()
    found = R.rows_at(feats, [0, 3000, 5999])
    pairs = feats.withColumn("_q", F.explode(R._seed_array(found))).where("listing_key != _q.listing_key").withColumn("similarity", R._similar())
    kept = R._likely(pairs, 5, 3)
    assert kept.count() < pairs.count() / 4
    ranked = lambda d: sorted(
        (r.s, r.similarity, r.listing_key) for r in d.selectExpr("_q.seed_index as s", "similarity", "listing_key").collect())
    best = [sorted(((x, -y, k) for x, y, k in ranked(pairs) if x == s), key=lambda t: (t[1], t[2]))[:5] for s in (0, 3000, 5999)]
    got = R.batch_recommend(feats, None, 5).collect()
    want = R.batch_recommend(feats, [0, 3020, 6039], 5).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 15
    assert [sorted(((x, -y, k) for x, y, k in ranked(kept) if x == s), key=lambda t: (t[1], t[2]))[:5] for s in (0, 3000, 5999)] == best


def test_row_filter_is_short_and_drops_what_has_no_cost(spark):
    inf, nan = float("inf"), float("nan")
    prices, days = [None, nan, inf, -inf, 0.0, 1e308, 5.0], [None, nan, inf, 0.0, -0.0, 1e-10, -2.0]
    df = spark.createDataFrame([(f"{i}-{j}", p, d, 3.0) for i, p in enumerate(prices) for j, d in enumerate(days)],
                               "listing_key string, price double, duration double, rating double")
    prep = R.prepare_numeric(df)
    every = R.prepare_numeric(df.limit(0)).columns
    ok = lambda p, d: p is not None and abs(p / (1.0 if d is None or d != d or d == 0 else d)) < inf
    assert sorted(r.listing_key for r in prep.collect()) == sorted(
        f"{i}-{j}" for i, p in enumerate(prices) for j, d in enumerate(days) if ok(p, d))
    assert prep.columns == every and prep.where("cost_per_day is null or price is null").count() == 0
    condition = next(x for x in prep._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x)
    assert condition.count("CASE WHEN") < 12
