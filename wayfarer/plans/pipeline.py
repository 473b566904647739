"""The batch pipeline: feeds -> raw tables -> clean -> cap -> enrich -> analytics.

Every stage is a DataFrame function; stage tables that feed several
consumers are written once to the output folder (Parquet) and re-read, so each
analytic scans only the columns it needs. The clean and the enriched table are
laid out by source, price and rating, so that an explorer's filters skip row groups.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from wayfarer.operators import chartdata as CD
from wayfarer.operators import clean as C
from wayfarer.operators import insights as I
from wayfarer.operators import recommend as R
from wayfarer.operators import sampling as S
from wayfarer.operators import sentiment as X
from wayfarer.operators import tiers as T
from wayfarer.operators.analytics import analytics_projection
from wayfarer.operators.mapping import union_frames
from wayfarer.schema import SourceSpec
from wayfarer.session import scratch_scope
from wayfarer.sources import booking_demand as BD
from wayfarer.sources import csv as CSV
from wayfarer.sources import feeds as FD


DASHBOARD_POINTS = 20_000     # of the scatter sample


@dataclass
class PipelineConfig:
    out_dir: str
    specs: Sequence[SourceSpec] = ()
    external_folder: str | None = None
    booking_demand_path: str | None = None
    booking_demand_max_rows: int | None = None
    extra_raw: Sequence[DataFrame] = ()
    cap: int | None = None        # rows kept at most; None keeps all
    proportional: bool = False
    lexicon: DataFrame | None = None
    seeds: Sequence[int] | None = None
    outputs: dict = field(default_factory=dict)


def _save(df: DataFrame, cfg: PipelineConfig, name: str, fmt: str = "parquet") -> str:
    path = os.path.join(cfg.out_dir, name)
    CSV.write_table(df, path, fmt)
    cfg.outputs[name] = path
    return path


def _save_stage(df: DataFrame, cfg: PipelineConfig, name: str) -> str:
    path = os.path.join(cfg.out_dir, name)
    CSV.write_stage(df, path)
    cfg.outputs[name] = path
    return path


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Run every stage; returns {output name: path}. Tables written on the way
    are removed at the end."""
    with scratch_scope(spark):
        return _run_stages(spark, cfg)


def _run_stages(spark: SparkSession, cfg: PipelineConfig) -> dict:
    raw_parts = []
    if cfg.specs or cfg.external_folder:
        raw_parts.append(FD.external_import(spark, cfg.specs, cfg.external_folder))
    if cfg.booking_demand_path:
        bd = CSV.read_csv_text(spark, cfg.booking_demand_path)
        raw_parts.append(BD.booking_demand_or_empty(bd, max_rows=cfg.booking_demand_max_rows))
    raw_parts.extend(cfg.extra_raw)
    raw = union_frames(raw_parts, spark)

    clean = C.clean_listings(raw)
    capped = S.cap_policy(clean, cfg.cap, cfg.proportional)
    _save_stage(capped, cfg, "clean_data")
    base = spark.read.parquet(cfg.outputs["clean_data"])

    enriched = base
    if cfg.lexicon is not None:
        enriched = X.sentiment(base, cfg.lexicon, "listing_key")
        _save_stage(enriched, cfg, "enriched_listings")
        enriched = spark.read.parquet(cfg.outputs["enriched_listings"])

    _save(I.popular_destinations(enriched), cfg, "popular_destinations", "csv")
    _save(I.best_rated(enriched), cfg, "best_rated_places", "csv")
    _save(I.price_rating_stats(enriched), cfg, "price_vs_rating", "json")
    _save(I.type_summary(enriched), cfg, "analysis_summary", "csv")
    _save(CD.price_histogram(enriched), cfg, "price_distribution", "csv")
    _save(CD.histogram(enriched, "rating", CD.RATING_BINS), cfg, "rating_distribution", "csv")
    _save(I.top_price_locations(enriched), cfg, "avg_price_top_locations", "csv")

    tiers = T.kmeans_tiers(enriched)
    _save(tiers, cfg, "results")
    results = spark.read.parquet(cfg.outputs["results"])
    _save(CD.tier_counts(results), cfg, "cluster_tier_counts", "csv")

    feats = R.features(R.prepare_numeric(results))
    _save(R.batch_recommend(feats, cfg.seeds), cfg, "recommendations_demo", "csv")
    shown = analytics_projection(enriched)
    _save(CD.box_stats(shown), cfg, "rating_by_type_box", "csv")
    # the dashboard's tables
    _save(I.top_locations(enriched, 18, count_names=True), cfg, "dashboard_top_locations", "csv")
    _save(I.source_share(shown), cfg, "dashboard_source_share", "csv")
    _save(CD.histogram(shown, "cost_per_day", CD.COST_BINS), cfg, "dashboard_cost_per_day", "csv")
    _save(CD.histogram(enriched, "rating", CD.RATING_BINS_DASHBOARD, n_rule_rows=enriched), cfg, "dashboard_ratings", "csv")
    _save(S.scatter_sample(results, DASHBOARD_POINTS, "cluster_label"), cfg, "dashboard_scatter", "csv")
    if cfg.lexicon is not None:
        _save(CD.histogram(enriched, "sentiment_compound", CD.SENTIMENT_BINS_DASHBOARD), cfg, "dashboard_sentiment", "csv")
    return dict(cfg.outputs)


ANALYTICS_INPUTS = ("enriched_listings", "clean_data")
RECOMMENDER_INPUTS = ("results", "clean_data")


def resolve_stage_input(spark: SparkSession, out_dir: str, prefer: Sequence[str] = ANALYTICS_INPUTS) -> DataFrame:
    """The first stage table that exists under ``out_dir`` (enriched listings
    if present, else the clean table; the recommender prefers the clustered
    results). Raises FileNotFoundError when none exists."""
    for name in prefer:
        path = os.path.join(out_dir, name)
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of {list(prefer)} under {out_dir}; run the pipeline first")
