"""Listing-shaped views: what their joins shuffle, and their rows where keys repeat or are missing."""

import os

import pytest

from wayfarer.plans import queries as Q
from wayfarer.session import store
from wayfarer.sources import fixtures as FX


@pytest.fixture()
def star(spark, tmpdir_path):
    line = [(i % 5 if i % 9 else None, i % 4, i % 3, 1 + i % 7, float(i % 6), 1000.0 * i + 0.5, 0.01 * (i % 3), 0.02 * (i % 5), "RAN"[i % 3])
            for i in range(60)]
    tables = {
        "lineitem": (line, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                           "l_discount double, l_tax double, l_returnflag string"),
        "orders": ([(k % 4, "FO"[k % 2], ["1-URGENT", None, "5-LOW"][k % 3]) for k in range(5)], "o_orderkey bigint, o_orderstatus string, o_orderpriority string"),
        "part": ([(k % 3, f"p{k}", f"B#{k}", "LARGE") for k in range(4)], "p_partkey bigint, p_name string, p_brand string, p_type string"),
        "supplier": ([(0, 24), (1, 3), (1, 4), (None, 3)], "s_suppkey bigint, s_nationkey int"),
        "nation": ([(3, "N3"), (4, "N4"), (24, "N24")], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(tmpdir_path, f"{name}.parquet"))
    return tmpdir_path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_is_shuffled_narrow_and_not_sorted(spark, star, monkeypatch):
    want = sorted(map(str, FX.raw_listings(spark, star).collect()))
    assert len(want) > 40 and any("source='rare'" in r for r in want) and any("source=None" in r for r in want)
    for few in ("FEW_NUMBERS", "FEW_TEXTS"):
        monkeypatch.setattr(FX, few, 0)
    df = FX.raw_listings(spark, star)
    assert "SortMergeJoin" not in _plan(df) and "ShuffledHashJoin" in _plan(df)
    # the texts of a part join after the orders, so their shuffle is narrow (the last mention is the scan)
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert logical.rindex("p_name") > logical.rindex("o_orderkey")
    assert sorted(map(str, df.collect())) == want


def test_feeds_read_the_joined_rows_once(spark, star):
    for name, rows in (("union_sources", 2), ("external_distinct", None)):
        df = Q.QUERIES[name](spark, star)
        assert "Join" not in _plan(df)
        assert rows is None or df.count() == rows * FX.feed_frames(spark, star)["feed_a"].count()


def test_stored_keys_take_half_their_digits(spark):
    df = spark.range(20000).selectExpr("md5(cast(id as string)) as k")
    path = store(df.coalesce(1), "digests").scratch_path.replace("file:", "")
    size = sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.endswith(".parquet"))
    assert size < 20000 * 24
