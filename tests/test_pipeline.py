"""The batch pipeline end to end on small feeds in a temporary folder."""

import os

from wayfarer.operators.sentiment import lexicon_frame
from wayfarer.plans.pipeline import PipelineConfig, run_pipeline
from wayfarer.schema import attraction_spec, booking_spec


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_run_pipeline(spark, tmpdir_path):
    feeds = os.path.join(tmpdir_path, "feeds")
    ext = os.path.join(tmpdir_path, "external")
    os.makedirs(feeds)
    os.makedirs(ext)
    rows = "\n".join(f"Hotel {i},{['Paris', 'Rome', 'Oslo'][i % 3]},hotel,{50 + 7 * i},{1 + i % 4},"
                     f"{'' if i % 5 == 0 else 3 + (i % 3) / 2},Good stay {i}" for i in range(40))
    _write(os.path.join(feeds, "booking.csv"),
           "hotel_name,city,property_type,price_per_night,nights,rating,review_snippet\n" + rows + "\n")
    _write(os.path.join(feeds, "tours.csv"),
           "title,destination,attraction_type,total_price,days,review_rating,review_excerpt\n"
           + "\n".join(f"Tour {i},Prague,tour,{20 + i},1,4.{i % 9},not bad" for i in range(30)) + "\n")
    _write(os.path.join(ext, "tourism.csv"), "hotel_name,price,rating,location,review\n"
           + "\n".join(f"Ext {i},{100 + i},4.{i % 7},Lisbon,great" for i in range(20)) + "\n")
    bd = os.path.join(tmpdir_path, "bookings.csv")
    _write(bd, "hotel,country,adr,stays_in_weekend_nights,stays_in_week_nights\n"
           + "\n".join(f"City Hotel,PRT,{60 + i},{i % 2},{i % 3}" for i in range(25)) + "\n")
    cfg = PipelineConfig(
        out_dir=os.path.join(tmpdir_path, "out"),
        specs=[booking_spec(os.path.join(feeds, "booking.csv")), attraction_spec(os.path.join(feeds, "tours.csv"))],
        external_folder=ext, booking_demand_path=bd, cap=80,
        lexicon=lexicon_frame(spark, [("good", 1.9), ("great", 3.1), ("bad", -2.5)]))
    out = run_pipeline(spark, cfg)
    clean = spark.read.parquet(out["clean_data"])
    assert clean.count() == 80
    assert {r.source for r in clean.select("source").distinct().collect()} == {
        "booking:export_sample", "tripadvisor:export_sample", "external:tourism", "kaggle:hotel_booking_demand"}
    enriched = spark.read.parquet(out["enriched_listings"])
    assert "sentiment_compound" in enriched.columns
    assert spark.read.parquet(out["results"]).select("cluster_label").distinct().count() == 3
    recs = spark.read.option("header", True).csv(out["recommendations_demo"])
    assert recs.count() == 15
    for name in ("popular_destinations", "best_rated_places", "analysis_summary", "price_distribution",
                 "rating_distribution", "avg_price_top_locations", "cluster_tier_counts", "rating_by_type_box",
                 "dashboard_top_locations", "dashboard_source_share", "dashboard_cost_per_day", "dashboard_ratings",
                 "dashboard_scatter", "dashboard_sentiment"):
        assert spark.read.option("header", True).csv(out[name]).count() > 0, name
    assert spark.read.json(out["price_vs_rating"]).count() == 1


def test_resolve_stage_input(spark, tmpdir_path):
    import pytest

    from wayfarer.plans.pipeline import RECOMMENDER_INPUTS, resolve_stage_input

    out = os.path.join(tmpdir_path, "stages")
    with pytest.raises(FileNotFoundError):
        resolve_stage_input(spark, out)
    spark.createDataFrame([("a", 1.0)], "name string, price double").write.parquet(os.path.join(out, "clean_data"))
    assert resolve_stage_input(spark, out).columns == ["name", "price"]
    spark.createDataFrame([("a", 1.0, 2)], "name string, price double, cluster int").write.parquet(
        os.path.join(out, "results"))
    assert "cluster" in resolve_stage_input(spark, out, RECOMMENDER_INPUTS).columns
    assert "cluster" not in resolve_stage_input(spark, out).columns
