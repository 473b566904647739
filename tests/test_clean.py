"""Clean-stage semantics on hand-built edge tables."""

from pyspark.sql import functions as F

from wayfarer.operators import clean as C
from wayfarer.schema import LISTING_COLUMNS

SCHEMA = "name string, type string, location string, price string, duration string, rating string, " \
         "source string, review_text string"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_clean_order_and_rules(spark):
    rows = [
        ("  Hotel A ", " HOTEL ", "Paris", "100", "0", "4.5", "s1", "  "),
        ("Hotel A", None, "Paris", "100", "2", None, "s1", None),        # duplicate key: loses (type NULL last)
        ("nan", "tour", "Rome", "50", None, "3", "s1", None),            # 'nan' name dropped
        ("Hotel B", "", "Rome", "abc", "1", "4", "s2", "ok"),            # bad price dropped
        ("Hotel C", "", "NULL", "80", None, None, "s2", "nice"),         # NULL text location -> missing
        ("Hotel D", "Tour", None, "1d", "3", "2", "s2", None),          # Java-suffixed price invalid
    ]
    out = {r.name: r for r in C.clean_listings(_df(spark, rows)).collect()}
    assert set(out) == {"Hotel A", "Hotel C"}
    a = out["Hotel A"]
    assert a.type == "hotel" and a.duration == 1.0 and a.rating == 4.5 and a.review_text is None
    c = out["Hotel C"]
    assert c.type == "offer" and c.location is None and c.duration == 1.0
    assert c.rating == 4.5            # the only observed rating
    assert len(a.listing_key) == 32


def test_impute_draws_from_observed(spark):
    rows = [(f"n{i}", "x", "L", str(10 + i), "1", (str(1 + i % 3) if i % 4 else None), "s", None)
            for i in range(400)]
    df = C.clean_listings(_df(spark, rows))
    observed = {1.0, 2.0, 3.0}
    ratings = [r.rating for r in df.collect()]
    assert len(ratings) == 400 and set(ratings) <= observed


def test_impute_without_observed_is_uniform_3_5(spark):
    rows = [(f"n{i}", "x", "L", str(i + 1), "1", None, "s", None) for i in range(200)]
    vals = [r.rating for r in C.clean_listings(_df(spark, rows)).collect()]
    assert all(3.0 <= v < 5.0 for v in vals) and len(set(vals)) > 150


def test_clean_is_partitioning_invariant(spark):
    rows = [(f"n{i % 50}", "t", f"L{i % 7}", str(i % 13), str(i % 4), str(i % 5) if i % 3 else None,
             f"s{i % 3}", None) for i in range(600)]
    base = _df(spark, rows)
    a = C.clean_listings(base.repartition(1)).orderBy("listing_key").collect()
    b = C.clean_listings(base.repartition(37)).orderBy("listing_key").collect()
    assert a == b
    keys = [r.listing_key for r in a]
    assert len(keys) == len(set(keys))


def test_clean_idempotent_on_clean_output(spark):
    rows = [(f"n{i}", "t", "L", str(i), "2", "4", "s", None) for i in range(50)]
    once = C.clean_listings(_df(spark, rows))
    twice = C.clean_listings(once.select(*LISTING_COLUMNS))
    assert once.orderBy("listing_key").collect() == twice.orderBy("listing_key").collect()


def test_dedup_first_keeps_nulls_last(spark):
    df = spark.createDataFrame([("k", None, 1.0), ("k", "b", None), ("k", "a", 5.0), ("j", None, None)],
                               "k string, t string, d double")
    got = {r.k: (r.t, r.d) for r in C.dedup_first(df, ["k"], ["t", "d"]).collect()}
    assert got == {"k": ("a", 5.0), "j": (None, None)}


def test_valid_rows_and_defaults(spark):
    df = spark.createDataFrame([("NaN", 1.0, None, ""), ("", 2.0, 0.0, None), ("ok", None, -2.0, "x"),
                                ("fine", 3.0, -2.0, None)], "name string, price double, duration double, type string")
    v = C.valid_rows(df)
    assert [r.name for r in v.collect()] == ["fine"]
    d = C.apply_defaults(df).collect()
    assert [r.duration for r in d] == [1.0, 1.0, -2.0, -2.0]
    assert [r.type for r in d] == ["offer", "offer", "x", "offer"]


def test_hot_duplicate_key(spark):
    # a third of all rows share one key: dedup must still return one row for it
    rows = [("Hot", "x", "L", "1", "1", "4", "s", None)] * 300 + \
           [(f"n{i}", "x", "L", "1", "1", "4", "s", None) for i in range(600)]
    out = C.clean_listings(_df(spark, rows))
    assert out.count() == 601
    assert out.where(F.col("name") == "Hot").count() == 1


def test_impute_by_shuffle_join_matches_broadcast(spark, monkeypatch):
    rows = [(f"n{i}", "x", "L", str(10 + i), "1", (str(1 + (i % 7) / 10) if i % 3 else None), "s", None)
            for i in range(300)]
    small = C.clean_listings(_df(spark, rows)).orderBy("listing_key").collect()
    monkeypatch.setattr(C, "small_table", lambda df, max_rows=0: None)
    spread = C.clean_listings(_df(spark, rows)).orderBy("listing_key").collect()
    assert small == spread
