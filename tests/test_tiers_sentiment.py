"""Tier assignment, K-means invariants and lexicon scoring."""

import math

import numpy as np
from pyspark.sql import functions as F

from wayfarer.operators import sentiment as X
from wayfarer.operators import tiers as T


def test_assign_centers_brute_force(spark):
    rng = np.random.default_rng(2)
    pts = [(float(p), float(c)) for p, c in rng.uniform(0, 100, (300, 2))]
    df = spark.createDataFrame(pts, "price double, cost_per_day double")
    centers = [(80.0, 10.0), (10.0, 10.0), (50.0, 50.0)]
    got = T.assign_centers(df, centers).collect()
    for r in got:
        d = [(r.price - cx) ** 2 + (r.cost_per_day - cy) ** 2 for cx, cy in centers]
        assert r.cluster == int(np.argmin(d))
        assert r.cluster_label == {0: "premium", 1: "budget", 2: "mid-range"}[r.cluster]


def test_kmeans_invariants(spark):
    rng = np.random.default_rng(3)
    pts = np.vstack([rng.normal(c, 3, (100, 2)) for c in ((10, 5), (60, 30), (150, 80))])
    df = spark.createDataFrame([(float(p), 1.0) for p, _ in pts], "price double, duration double")
    out = T.kmeans_tiers(df, k=3, restarts=3).toPandas()
    assert len(out) == 300 and set(out["cluster_label"]) == {"budget", "mid-range", "premium"}
    means = out.groupby("cluster_label")["price"].mean()
    assert means["budget"] < means["mid-range"] < means["premium"]
    xy = out[["price", "cost_per_day"]].to_numpy()
    centre = out.groupby("cluster")[["price", "cost_per_day"]].mean()
    far = ((xy[:, None, :] - centre.to_numpy()[None]) ** 2).sum(axis=2)
    assert (centre.index.to_numpy()[far.argmin(axis=1)] == out["cluster"]).all()      # nearest their own centre
    one = T.kmeans_tiers(df, k=3, restarts=1).toPandas()
    cost = lambda t: t.groupby("cluster")["price"].var(ddof=0).mul(t.groupby("cluster").size()).sum()
    assert cost(out) <= cost(one) + 1e-6


def test_lloyd_steps(spark):
    rng = np.random.default_rng(9)
    pts = rng.uniform(0, 100, (200, 2))
    df = spark.createDataFrame([(float(p), float(d) / 20 + 0.5) for p, d in pts], "price double, duration double")
    start = [(90.0, 10.0), (10.0, 10.0), (1e9, 1e9)]
    got = T.lloyd_tiers(df, start, 2).toPandas()
    xy = got[["price", "cost_per_day"]].to_numpy()
    cen = np.array(start)
    for _ in range(2):
        own = ((xy[:, None, :] - cen[None]) ** 2).sum(axis=2).argmin(axis=1)
        cen = np.array([xy[own == i].mean(axis=0) if (own == i).any() else cen[i] for i in range(3)])
    assert (((xy[:, None, :] - cen[None]) ** 2).sum(axis=2).argmin(axis=1) == got["cluster"]).all()


def _plain_kmeans(pts, k, seed):
    rng = np.random.default_rng(seed)
    far = lambda c: ((pts[:, None, :] - c[None]) ** 2).sum(axis=2)
    c = pts[rng.choice(len(pts), 1)]
    while len(c) < k:
        d = far(c).min(axis=1)
        c = np.vstack([c, pts[rng.choice(len(pts), p=d / d.sum())]])
    for _ in range(200):
        own = far(c).argmin(axis=1)
        c = np.array([pts[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(k)])
    return far(c).min(axis=1).sum()


def test_kmeans_costs_no_more_than_the_best_of_many_plain_fits(spark):
    rng = np.random.default_rng(8)
    pts = np.round(np.vstack([rng.normal(c, s, (150, 2)) for c, s in (((10, 5), 4), ((30, 9), 9), ((200, 90), 30), ((25, 30), 5))]), 0)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pts], "price double, cost_per_day double")
    for k in (3, 5):
        centers, cost = T.kmeans_centers(df, k=k)
        own = ((pts[:, None, :] - np.array(centers)[None]) ** 2).sum(axis=2)
        assert len(centers) == k and abs(own.min(axis=1).sum() - cost) <= 1e-3 * cost
        assert cost <= min(_plain_kmeans(pts, k, s) for s in range(40)) * 1.001
    a, b = (sorted(T.kmeans_centers(d, k=3)[0]) for d in (df, df.repartition(7)))
    assert np.allclose(a, b)


def test_kmeans_odd_points(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0, 1.0)] * 40 + [(9.0, 2.0)] * 3 + [(inf, 1.0), (2.0, -inf)], "price double, cost_per_day double")
    centers, cost = T.kmeans_centers(df, k=3)
    assert sorted(centers) == [(1.0, 1.0), (9.0, 2.0)] and cost == 0.0
    assert T.kmeans_centers(df.limit(0)) == ([], 0.0)


def test_kmeans_too_few_rows(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0)], "price double, duration double")
    out = T.kmeans_tiers(df, k=3, restarts=1).collect()
    assert len(out) == 2 and all(r.cluster is None for r in out)


LEX = {"good": 1.9, "bad": -2.5, "great": 3.1, "kind": 2.4}

# (text, summed valence after punctuation, pos, neg, neu) worked out by hand from the rules
HAND = [
    ("good", 1.9, 2.9, 0.0, 0),
    ("GOOD", 1.9, 2.9, 0.0, 0),                                      # all capitals: no contrast
    ("a GOOD stay", 1.9 + 0.733, 3.633, 0.0, 2),
    ("very good", 1.9 + 0.293, 3.193, 0.0, 1),
    ("really nice and good", 1.9 + 0.293 * 0.9, 1.9 + 0.2637 + 1, 0.0, 3),
    ("slightly good", 1.9 - 0.293, 2.607, 0.0, 1),
    ("extremely bad", -2.5 - 0.293, 0.0, -3.793, 1),
    ("isn't good", 1.9 * -0.74, 0.0, -1.406 - 1, 1),
    ("wasn’t good", 1.9 * -0.74, 0.0, -2.406, 1),
    ("don't think it is good", 1.9, 2.9, 0.0, 4),                     # four tokens away
    ("don't think it good", 1.9 * -0.74, 0.0, -2.406, 3),
    ("not very good", (1.9 + 0.293) * -0.74, 0.0, -2.193 * 0.74 - 1, 2),
    ("never so good", (1.9 + 0.293) * 1.25, 2.193 * 1.25 + 1, 0.0, 2),
    ("without doubt good", 1.9, 2.9, 0.0, 2),
    ("least good", 1.9 * -0.74, 0.0, -2.406, 1),
    ("at least good", 1.9, 2.9, 0.0, 2),
    ("good!!!", 1.9 + 3 * 0.292, 2.9 + 0.876, 0.0, 0),
    ("good!!!!!!", 1.9 + 4 * 0.292, 2.9 + 1.168, 0.0, 0),
    ("bad??", -2.5 - 0.36, 0.0, -3.5 - 0.36, 0),
    ("good?", 1.9, 2.9, 0.0, 0),
    ("good ????", 1.9 + 0.96, 2.9 + 0.96, 0.0, 0),
    ("good but bad", 0.5 * 1.9 + 1.5 * -2.5, 1.95, -4.75, 1),
    ("kind of good", 1.9 - 0.293, 2.607, 0.0, 2),                     # a degree phrase
    ("kind and good", 2.4 + 1.9, 6.3, 0.0, 1),
    ("so kind", 2.4 + 0.293, 3.693, 0.0, 1),
    ("très good été", 1.9, 2.9, 0.0, 2),                              # accented words are whole tokens
    ("good bad", 1.9 - 2.5, 2.9, -3.5, 0),
    ("NOT good", 1.9 * -0.74, 0.0, -2.406, 1),
]


def test_sentiment_by_hand(spark):
    import pytest

    df = spark.createDataFrame([(k, t[0]) for k, t in enumerate(HAND)], "k long, review_text string")
    got = {r.k: r for r in X.sentiment(df, X.lexicon_frame(spark, LEX.items()), "k", digits=None).collect()}
    for k, (text, s, p, n, u) in enumerate(HAND):
        r, total = got[k], p + abs(n) + u
        want = (s / math.sqrt(s * s + 15), p / total, abs(n) / total, u / total)
        assert (r.sentiment_compound, r.sentiment_pos, r.sentiment_neg, r.sentiment_neu) == pytest.approx(want), text
    score = {t[0]: got[k].sentiment_compound for k, t in enumerate(HAND)}
    assert score["isn't good"] < 0 < score["good"] < score["very good"] < score["good!!!!!!"]


PHRASE_LEX = LEX | {"kiss of death": -1.5, "bus stop": 0.0, "to die for": 3.0, "of death or": 1.0, "die": -2.9, "Not Bad": 1.1, ":)": 2.0, ":D": 2.3,
                    ":'(": -2.2, "<3": 1.9}

# phrases, degree phrases and emoticons, worked out by hand
HAND_PHRASES = [
    ("the kiss of death", -1.5, 0.0, -2.5, 3),                        # the phrase is one scoring unit
    ("to die for", 3.0, 4.0, 0.0, 2),                                 # what lies inside takes no part
    ("die for", -2.9, 0.0, -3.9, 1),
    ("very to die for", 3.293, 4.293, 0.0, 3),                        # rules hold for phrases
    ("not a kiss of death", 1.11, 2.11, 0.0, 4),
    ("great bus stop", 3.1, 4.1, 0.0, 2),                             # a phrase without valence is neutral
    ("kiss of death or good", -1.5 + 1.9, 2.9, -2.5, 3),              # equal lengths: the first match stands
    ("not bad", 1.1, 2.1, 0.0, 1),                                    # a phrase with a negation in it
    ("not so bad", -2.793 * -0.74, 2.793 * 0.74 + 1, 0.0, 2),
    ("sort of good", 1.607, 2.607, 0.0, 2),
    ("sort of very good", 1.9 + 0.293 - 0.293 * 0.95, 1.9 + 0.293 * 0.05 + 1, 0.0, 3),  # it counts from its last word
    ("just enough good", 1.607, 2.607, 0.0, 2),
    ("good of kind", 1.9 + 2.4, 6.3, 0.0, 1),
    ("good :) :)", 1.9 + 4.0, 2.9 + 6.0, 0.0, 0),
    ("good:) :-)", 1.9, 2.9, 0.0, 0),                                 # only between blanks, and only known ones
    ("very :D", 2.3 + 0.733 + 0.293, 4.326, 0.0, 1),                  # its letter is a capital
    ("bad :'( <3", -2.5 - 2.2 + 1.9, 2.9, -6.7, 0),
]


def test_sentiment_phrases_by_hand(spark):
    import pytest

    df = spark.createDataFrame([(k, t[0]) for k, t in enumerate(HAND_PHRASES)], "k long, review_text string")
    got = {r.k: r for r in X.sentiment(df, X.lexicon_frame(spark, PHRASE_LEX.items()), "k", digits=None).collect()}
    for k, (text, s, p, n, u) in enumerate(HAND_PHRASES):
        r, total = got[k], p + abs(n) + u
        want = (s / math.sqrt(s * s + 15), p / total, abs(n) / total, u / total)
        assert (r.sentiment_compound, r.sentiment_pos, r.sentiment_neg, r.sentiment_neu) == pytest.approx(want), text


def test_sentiment_tokenises_once(spark):
    df = spark.createDataFrame([(1, "a good stay")], "k long, review_text string")
    plan = X.token_scores(df, X.lexicon_frame(spark, LEX.items()), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_too_many_emoticons(spark):
    import pytest

    odd = spark.range(X.MAX_EMOTICONS + 1).selectExpr("concat(':', id) as token", "1.0D as valence")
    with pytest.raises(ValueError):
        X.token_scores(spark.createDataFrame([(1, "x")], "k long, review_text string"), odd, "k")


def test_sentiment_of_nothing(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "nan"), (4, "!!!"), (5, "  "), (6, "just words")], "k long, review_text string")
    got = X.sentiment(df, X.lexicon_frame(spark, LEX.items()), "k").collect()
    assert len(got) == 6
    assert {(r.sentiment_compound, r.sentiment_pos, r.sentiment_neg, r.sentiment_neu) for r in got} == {(0.0, 0.0, 0.0, 1.0)}


def test_sentiment_without_lexicon_passes_through(spark):
    df = spark.createDataFrame([(1, "good")], "k int, review_text string")
    assert X.sentiment(df, None, "k").columns == ["k", "review_text"]
