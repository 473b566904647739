"""Plan shape of every registered query: no pairs, pushdown where it matters."""

import __spark_entry__ as E

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_products_in_any_query(spark):
    from wayfarer.plans.queries import QUERIES

    bad = {}
    for name, fn in QUERIES.items():
        if name == "kmeans_tiers":
            continue
        plan = _plan(fn(spark, E.SMOKE_DIR))
        hits = [f for f in FORBIDDEN if f in plan]
        if hits:
            bad[name] = hits
    assert not bad, bad


def test_scan_pruning_and_pushdown(spark):
    from pyspark.sql import functions as F

    from wayfarer.plans.queries import clean_fixture
    clean = clean_fixture(spark, E.SMOKE_DIR)
    q = clean.where(F.col("price") > 1000).groupBy("location").agg(F.count("name").alias("n"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(price), GreaterThan(price,1000.0)]" in plan
    schemas = [seg.split("]")[0] for seg in plan.split("ReadSchema: ")[1:]]
    read = [x for x in schemas if "price:double" in x][0]
    # columns the query and the rating fill need are read; the others are pruned
    for col in ("type", "duration", "source", "review_text"):
        assert f"{col}:" not in read, read


def test_no_local_checkpoint_in_library():
    import pathlib
    root = pathlib.Path(__file__).resolve().parents[1] / "wayfarer"
    for p in root.rglob("*.py"):
        assert "localCheckpoint" not in p.read_text(), p
