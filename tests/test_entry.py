"""Driver contract: entry, registry and SQL twins line up."""

import __spark_entry__ as E


def test_registry_and_oracle_keys():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert {"kmeans_fixed_start", "kmeans_check", "batch_recommend_many", "sentiment"} <= set(sql)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["location", "listings", "avg_price", "avg_rating"]


def test_small_queries_run_on_smoke_data(spark):
    qs = E.queries()
    for name in ("type_summary", "balanced_cap", "price_histogram_log", "similar_listings", "sentiment"):
        assert qs[name](spark, E.SMOKE_DIR).count() >= 0
