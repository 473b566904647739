"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All run over the whole generated tables (no id subsets, no row caps); limits
appear only where the operator is itself a top-k, a preview or a capped
sample. Floating aggregates are rounded to 6 decimals (half-even) so the SQL
twins compare exactly.
"""

from __future__ import annotations

import os
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfarer.functions.currency import format_price
from wayfarer.functions.numeric import to_double
from wayfarer.functions.parse import parse_duration, parse_price
from wayfarer.operators import analytics as AN
from wayfarer.operators import clean as C
from wayfarer.operators import filters as FL
from wayfarer.operators import insights as I
from wayfarer.operators.mapping import complete_columns, map_to_listing_schema, union_frames
from wayfarer.plans import pipeline as PL
from wayfarer.schema import KEY_COLUMN, LISTING_COLUMNS, SourceSpec, ATTRACTION_MAPPING, BOOKING_MAPPING
from wayfarer.session import scratch_table_path
from wayfarer.sources import booking_demand as BD
from wayfarer.sources import csv as CSV
from wayfarer.sources import feeds as FD
from wayfarer.sources import fixtures as FX

D = 6  # digits for oracle-checked floating outputs

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

BOOKING = SourceSpec("booking:export_sample", "", BOOKING_MAPPING, "hotel")
ATTRACTION = SourceSpec("tripadvisor:export_sample", "", ATTRACTION_MAPPING, "offer")

# explorer / preference parameters used by the registered queries
EXPLORER = dict(price_range=(5000.0, 60000.0), rating_range=(3.2, 4.6),
                locations=["NATION_1", "NATION_5", "NATION_7", "NATION_12", "NATION_18", "nan"],
                sources=["1-URGENT", "2-HIGH", "rare", "5-LOW"], types=["Standard", "LARGE", "offer"])
PREFS = dict(max_price=50000.0, min_rating=3.5, preferred_locations=[" nation_3 ", "NATION_7", "Nation_18"])


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


_STAGE_CACHE: dict = {}


def clean_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean stage over the raw fixture, materialised once per session and
    input folder (like the pipeline's stage table, it feeds every analytic)."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _STAGE_CACHE:
        _STAGE_CACHE[key] = C.clean_listings(FX.raw_listings(spark, sf_dir))
    return _STAGE_CACHE[key]


def normalized_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.coerce_numeric(C.normalize_strings(FX.raw_listings(spark, sf_dir)))


def r6(c):
    return F.bround(c, D)


# ---- clean stage -------------------------------------------------------------

@register("clean_pipeline")
def q_clean_pipeline(spark, sf_dir):
    """The whole clean stage, recomputed from the raw tables on every call."""
    return C.clean_listings(FX.raw_listings(spark, sf_dir))


@register("string_norm")
def q_string_norm(spark, sf_dir):
    return C.normalize_strings(FX.raw_listings(spark, sf_dir)).select("name", "location", "type", "source",
                                                                       "review_text")


@register("numeric_coerce")
def q_numeric_coerce(spark, sf_dir):
    df = FX.numeric_text(spark, sf_dir)
    return df.select("p_partkey", "value_text", to_double("value_text").alias("value"))


@register("dedup_listings")
def q_dedup_listings(spark, sf_dir):
    return C.dedup_first(normalized_raw(spark, sf_dir), C.DEDUP_KEY, ["type", "duration", "rating", "review_text"])


@register("valid_rows")
def q_valid_rows(spark, sf_dir):
    return C.valid_rows(normalized_raw(spark, sf_dir))


@register("defaults")
def q_defaults(spark, sf_dir):
    return C.apply_defaults(normalized_raw(spark, sf_dir))


@register("impute_rating")
def q_impute_rating(spark, sf_dir):
    return clean_fixture(spark, sf_dir).select(KEY_COLUMN, "rating")


@register("complete_rows")
def q_complete_rows(spark, sf_dir):
    return AN.complete_rows(normalized_raw(spark, sf_dir), ["price", "rating"])


# ---- parsing / mapping / imports ----------------------------------------------

@register("parse_price")
def q_parse_price(spark, sf_dir):
    df = FX.text_listings(spark, sf_dir)
    return df.select("p_partkey", "price_text", parse_price("price_text").alias("price"))


@register("parse_duration")
def q_parse_duration(spark, sf_dir):
    df = FX.text_listings(spark, sf_dir)
    return df.select("p_partkey", "duration_text", parse_duration("duration_text").alias("duration"))


@register("map_schema")
def q_map_schema(spark, sf_dir):
    f = FX.feed_frames(spark, sf_dir)
    return map_to_listing_schema(f["feed_a"], BOOKING.mapping, BOOKING.name, BOOKING.default_type)


@register("import_sources")
def q_import_sources(spark, sf_dir):
    f = FX.feed_frames(spark, sf_dir)
    return FD.import_frames([(f["feed_a"], BOOKING), (f["feed_b"], ATTRACTION)])


@register("import_report")
def q_import_report(spark, sf_dir):
    """What became of three feeds: one with short and long records and missing cells, one whose file is gone, and one
    whose header lacks the mapped name."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    k = F.col("p_partkey")
    cell = lambda gone, text: F.when(k % gone == 0, F.lit("")).otherwise(text)
    full = F.concat_ws(",", cell(13, F.concat(F.lit("Stay "), k)), F.lit("Rome"), F.lit("hotel"), cell(7, k.cast("string")),
                       F.lit("2"), F.lit("4.5"), F.lit("fine"))
    line = F.when(k % 97 == 0, F.concat(full, F.lit(",more"))).when(k % 89 == 0, F.regexp_replace(full, ",fine$", "")).otherwise(full)
    folder = scratch_table_path(spark, f"report-{uuid.uuid4().hex}")

    def feed(name, value, header):
        # one column that holds the whole record, so that its commas stay as they are
        part.select(value.alias(header)).write.option("header", "true").option("sep", "\x01").option("quote", "\x02") \
            .csv(f"{folder}/{name}")
        return SourceSpec(name, f"{folder}/{name}", BOOKING_MAPPING, "hotel")

    head = "hotel_name,city,property_type,price_per_night,nights,rating,review_snippet"
    specs = [feed("booking", line, head), SourceSpec("gone", f"{folder}/gone", BOOKING_MAPPING, "hotel"),
             feed("wrong", F.concat_ws(",", k.cast("string"), F.lit("Rome"), cell(5, F.lit("12"))), "label,city,price_per_night")]
    return FD.import_report(spark, specs).drop("error")


@register("header_alias_import")
def q_header_alias_import(spark, sf_dir):
    return FD.header_alias_import(FX.feed_frames(spark, sf_dir)["feed_c"], "external:feed_c")


@register("external_distinct")
def q_external_distinct(spark, sf_dir):
    f = FX.feed_frames(spark, sf_dir, once=True)
    specs = FD.import_frames([(f["feed_a"], BOOKING), (f["feed_b"], ATTRACTION)])
    folder = FD.header_alias_import(f["feed_c"], "external:feed_c")
    return union_frames([specs, folder]).dropDuplicates()


@register("union_sources")
def q_union_sources(spark, sf_dir):
    f = FX.feed_frames(spark, sf_dir, once=True)
    mapped = map_to_listing_schema(f["feed_a"], BOOKING.mapping, BOOKING.name, BOOKING.default_type)
    partial = f["feed_b"].select(F.col("title").alias("name"), F.col("total_price").alias("price"))
    return complete_columns(union_frames([mapped, partial])).select(*LISTING_COLUMNS)


@register("booking_demand")
def q_booking_demand(spark, sf_dir):
    return BD.transform_booking_demand(FX.booking_demand_raw(spark, sf_dir))


@register("booking_demand_head")
def q_booking_demand_head(spark, sf_dir):
    return BD.transform_booking_demand(FX.booking_demand_raw(spark, sf_dir), max_rows=20000)


@register("csv_round_trip")
def q_csv_round_trip(spark, sf_dir):
    """Raw listings written by the fixed-column sink, one half with the columns in another order and in Latin-1,
    and read back by column name."""
    raw = FX.raw_listings(spark, sf_dir).withColumn("location", F.concat(F.lit("é"), F.col("location")))
    folder = scratch_table_path(spark, f"round-trip-{uuid.uuid4().hex}")
    half = F.pmod(F.xxhash64("name", "price", "duration", "rating"), F.lit(2))
    CSV.write_listings(raw.where(half == 0), f"{folder}/utf8", "csv")
    swapped = raw.where(half == 1).select(*reversed(LISTING_COLUMNS))
    swapped.write.option("header", "true").option("encoding", "ISO-8859-1").csv(f"{folder}/latin1")
    return CSV.read_listing_files(spark, f"{folder}/*/*.csv")


@register("result_sinks")
def q_result_sinks(spark, sf_dir):
    """A result table through each of the three result sinks."""
    table = I.popular_destinations(clean_fixture(spark, sf_dir), digits=D)
    folder = scratch_table_path(spark, f"sinks-{uuid.uuid4().hex}")
    parts = []
    for fmt in ("parquet", "csv", "json"):
        CSV.write_table(table, f"{folder}/{fmt}", fmt)
        r = spark.read.schema(table.schema)
        back = r.option("header", "true").csv(f"{folder}/csv") if fmt == "csv" else r.format(fmt).load(f"{folder}/{fmt}")
        parts.append(back.select(F.lit(fmt).alias("sink"), *table.columns))
    return union_frames(parts)


# ---- projections ---------------------------------------------------------------

@register("cost_per_day")
def q_cost_per_day(spark, sf_dir):
    df = clean_fixture(spark, sf_dir)
    return df.select(KEY_COLUMN, r6(AN.cost_per_day_raw()).alias("cost_per_day_summary"),
                     r6(AN.cost_per_day()).alias("cost_per_day"))


@register("analytics_projection")
def q_analytics_projection(spark, sf_dir):
    df = AN.analytics_projection(clean_fixture(spark, sf_dir))
    return df.withColumn("cost_per_day", r6(F.col("cost_per_day")))


@register("format_price")
def q_format_price(spark, sf_dir):
    df = clean_fixture(spark, sf_dir)
    return df.select(KEY_COLUMN, "price", format_price("price", "EUR").alias("price_fmt"),
                     format_price("rating", "XYZ").alias("rating_fmt"))


# ---- filters -------------------------------------------------------------------

def explorer_rows(spark, sf_dir):
    return FL.explorer_filter(AN.analytics_projection(clean_fixture(spark, sf_dir)), **EXPLORER)


@register("explorer_filter")
def q_explorer_filter(spark, sf_dir):
    return explorer_rows(spark, sf_dir).withColumn("cost_per_day", r6(F.col("cost_per_day")))


@register("explorer_filter_missing")
def q_explorer_filter_missing(spark, sf_dir):
    """Ranges that also let rows without a price or a rating through."""
    return FL.explorer_filter(normalized_raw(spark, sf_dir), EXPLORER["price_range"], EXPLORER["rating_range"],
                              sources=EXPLORER["sources"], include_missing_price=True, include_missing_rating=True)


@register("explorer_stage")
def q_explorer_stage(spark, sf_dir):
    """The explorer's filters on the clean table as the pipeline lays it out."""
    path = scratch_table_path(spark, f"explorer-{uuid.uuid4().hex}")
    CSV.write_stage(clean_fixture(spark, sf_dir), path)
    rows = FL.explorer_filter(spark.read.parquet(path), **EXPLORER)
    return rows.select(KEY_COLUMN, "name", "location", "source", "price", "rating")


@register("stage_inputs")
def q_stage_inputs(spark, sf_dir):
    """Rows by source of the table that the analytics, then the recommender, take: with only a clean table in the
    folder, with an enriched one and clustered results beside it, and with none (no rows)."""
    clean = clean_fixture(spark, sf_dir)
    folder = scratch_table_path(spark, f"stages-{uuid.uuid4().hex}")
    CSV.write_stage(clean, f"{folder}/first/clean_data")
    CSV.write_stage(clean, f"{folder}/second/clean_data")
    CSV.write_table(clean.where(F.col("rating") >= 4.0), f"{folder}/second/enriched_listings")
    CSV.write_table(clean.where(F.col("rating") < 2.0), f"{folder}/second/results")
    parts = []
    for case in ("none", "first", "second"):
        for stage, prefer in (("analytics", PL.ANALYTICS_INPUTS), ("recommender", PL.RECOMMENDER_INPUTS)):
            try:
                found = PL.resolve_stage_input(spark, f"{folder}/{case}", prefer)
            except FileNotFoundError:
                found = clean.limit(0)
            parts.append(found.groupBy("source").agg(F.count("*").alias("n"), F.min("rating").alias("least"))
                         .select(F.lit(case).alias("case"), F.lit(stage).alias("stage"), "source", "n", "least"))
    return union_frames(parts)


@register("filter_domain")
def q_filter_domain(spark, sf_dir):
    return FL.filter_domain(AN.analytics_projection(clean_fixture(spark, sf_dir)))


# ---- aggregates and top-k ------------------------------------------------------

@register("popular_destinations")
def q_popular_destinations(spark, sf_dir):
    return I.popular_destinations(clean_fixture(spark, sf_dir), digits=D)


@register("type_summary")
def q_type_summary(spark, sf_dir):
    return I.type_summary(clean_fixture(spark, sf_dir), digits=D)


@register("price_rating_stats")
def q_price_rating_stats(spark, sf_dir):
    return I.price_rating_stats(clean_fixture(spark, sf_dir), digits=D)


@register("top_price_locations")
def q_top_price_locations(spark, sf_dir):
    return I.top_price_locations(clean_fixture(spark, sf_dir), 15, digits=D)


@register("kpis")
def q_kpis(spark, sf_dir):
    full = AN.analytics_projection(clean_fixture(spark, sf_dir))
    return I.kpis(full, FL.explorer_filter(full, **EXPLORER), digits=D)


@register("source_share")
def q_source_share(spark, sf_dir):
    return I.source_share(AN.analytics_projection(clean_fixture(spark, sf_dir)), digits=D)


@register("top_locations")
def q_top_locations(spark, sf_dir):
    return I.top_locations(AN.analytics_projection(clean_fixture(spark, sf_dir)), 12)


@register("top_locations_dashboard")
def q_top_locations_dashboard(spark, sf_dir):
    return I.top_locations(clean_fixture(spark, sf_dir), 18, count_names=True)


@register("price_p75")
def q_price_p75(spark, sf_dir):
    return I.price_quantile(clean_fixture(spark, sf_dir), 0.75).select(r6(F.col("price_p75")).alias("price_p75"))


@register("best_rated")
def q_best_rated(spark, sf_dir):
    return I.best_rated(clean_fixture(spark, sf_dir), 25)


@register("preview")
def q_preview(spark, sf_dir):
    return I.preview(clean_fixture(spark, sf_dir), 1000)


# ---- sampling and caps ---------------------------------------------------------

from wayfarer.operators import chartdata as CD  # noqa: E402
from wayfarer.operators import recommend as R  # noqa: E402
from wayfarer.operators import sampling as S  # noqa: E402
from wayfarer.operators import sentiment as X  # noqa: E402
from wayfarer.operators import tiers as T  # noqa: E402

CAP = 10_001       # bites: six sources, 'rare' below its quota -> the fill path runs
SCATTER_POINTS = 4000
CENTER_QS = (0.2, 0.5, 0.8)
# a small lexicon table (token, valence) supplied to the sentiment operator
LEXICON = [("the", 0.5), ("and", 1.2), ("that", -0.8), ("for", 0.3), ("was", -1.1),
           ("good", 1.9), ("great", 3.1), ("bad", -2.5), ("poor", -2.1), ("excellent", 2.7),
           ("terrible", -2.5), ("love", 3.2), ("hate", -2.7), ("nice", 1.8), ("awful", -2.0)]
# phrases (two overlap, one lies inside another) and an emoticon on top of the words
PHRASES = [("of the", 1.3), ("the and", -0.7), ("in the and", 2.2), ("de la", 1.1), ("und die", -1.4), ("to be", 0.0), ("|", -0.4)]


@register("balanced_cap")
def q_balanced_cap(spark, sf_dir):
    return S.balanced_cap(clean_fixture(spark, sf_dir), CAP)


@register("proportional_cap")
def q_proportional_cap(spark, sf_dir):
    return S.proportional_cap(clean_fixture(spark, sf_dir), CAP)


@register("uniform_cap")
def q_uniform_cap(spark, sf_dir):
    return S.uniform_cap(clean_fixture(spark, sf_dir), CAP)


@register("cap_policy")
def q_cap_policy(spark, sf_dir):
    return S.cap_policy(clean_fixture(spark, sf_dir), S.DEFAULT_CAP)


@register("scatter_sample")
def q_scatter_sample(spark, sf_dir):
    return S.scatter_sample(clean_fixture(spark, sf_dir), SCATTER_POINTS, "type")


@register("impute_median")
def q_impute_median(spark, sf_dir):
    prep = R.prepare_numeric(clean_fixture(spark, sf_dir))
    return prep.select(KEY_COLUMN, "rating", "duration", r6(F.col("cost_per_day")).alias("cost_per_day"))


# ---- chart data ----------------------------------------------------------------

def _hist6(h):
    return h.select("bin", r6(F.col("bin_lo")).alias("bin_lo"), r6(F.col("bin_hi")).alias("bin_hi"), "count")


@register("price_histogram_log")
def q_price_histogram_log(spark, sf_dir):
    return _hist6(CD.price_histogram(clean_fixture(spark, sf_dir)))


@register("price_histogram")
def q_price_histogram(spark, sf_dir):
    """Explorer price histogram (linear bins) over the filtered rows."""
    return _hist6(CD.histogram(explorer_rows(spark, sf_dir), "price", CD.EXPLORER_PRICE_BINS))


@register("price_histogram_static")
def q_price_histogram_static(spark, sf_dir):
    """The static chart's linear price bins."""
    return _hist6(CD.histogram(clean_fixture(spark, sf_dir), "price", CD.PRICE_BINS))


@register("rating_histogram")
def q_rating_histogram(spark, sf_dir):
    return _hist6(CD.histogram(clean_fixture(spark, sf_dir), "rating", CD.RATING_BINS))


@register("rating_histogram_dashboard")
def q_rating_histogram_dashboard(spark, sf_dir):
    df = clean_fixture(spark, sf_dir)
    return _hist6(CD.histogram(df, "rating", CD.RATING_BINS_DASHBOARD, n_rule_rows=df))


@register("cost_per_day_histogram")
def q_cost_per_day_histogram(spark, sf_dir):
    return _hist6(CD.histogram(AN.analytics_projection(clean_fixture(spark, sf_dir)), "cost_per_day", CD.COST_BINS))


@register("rating_box_by_type")
def q_rating_box_by_type(spark, sf_dir):
    b = CD.box_stats(clean_fixture(spark, sf_dir), "rating", "type")
    return b.select("type", *[r6(F.col(c)).alias(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi",
                                                                "min", "max")], "n", "n_outliers")


# ---- tiers ---------------------------------------------------------------------

def _assigned(spark, sf_dir):
    rows = T.model_rows(clean_fixture(spark, sf_dir))
    return T.assign_centers(rows, T.quantile_centers(rows, CENTER_QS))


@register("assign_centers")
def q_assign_centers(spark, sf_dir):
    return _assigned(spark, sf_dir).select(KEY_COLUMN, "price", r6(F.col("cost_per_day")).alias("cost_per_day"),
                                           "cluster", "cluster_label")


@register("tier_counts")
def q_tier_counts(spark, sf_dir):
    return CD.tier_counts(_assigned(spark, sf_dir))


@register("kmeans_tiers")
def q_kmeans_tiers(spark, sf_dir):
    return T.kmeans_tiers(clean_fixture(spark, sf_dir)).select(KEY_COLUMN, "price", "cost_per_day", "cluster",
                                                               "cluster_label")


@register("kmeans_fixed_start")
def q_kmeans_fixed_start(spark, sf_dir):
    """Three Lloyd rounds from the quantile centres."""
    rows = T.model_rows(clean_fixture(spark, sf_dir))
    out = T.lloyd_tiers(rows, T.quantile_centers(rows, CENTER_QS), 3)
    return out.select(KEY_COLUMN, "price", "cluster", "cluster_label")


@register("kmeans_check")
def q_kmeans_check(spark, sf_dir):
    """What must hold of the fit: rows by label, rows nearer to another cluster's mean (none, up to where the
    fit stopped moving), labels in the order of their prices."""
    out = T.kmeans_tiers(clean_fixture(spark, sf_dir))
    means = out.groupBy("cluster", "cluster_label").agg(F.avg("price").alias("x"), F.avg("cost_per_day").alias("y"))
    rank = {"budget": 0, "mid-range": 1, "premium": 2}
    found = sorted(means.collect(), key=lambda r: r["cluster"])
    near = T.assign_centers(out.withColumnRenamed("cluster", "_own").drop("cluster_label"), [(r["x"], r["y"]) for r in found])
    prices = [r["x"] for r in sorted(found, key=lambda r: rank[r["cluster_label"]])]
    return near.agg(F.count(F.lit(1)).alias("rows"),
                    (F.count(F.when(F.col("_own") != F.col("cluster"), 1)) * 1000 > F.count(F.lit(1))).alias("misplaced"),
                    F.lit(prices == sorted(prices)).alias("labels_ordered"), F.lit(len(prices)).alias("clusters"))


# ---- recommendations -----------------------------------------------------------

def _feats(spark, sf_dir):
    return R.features(R.prepare_numeric(clean_fixture(spark, sf_dir)))


@register("features")
def q_features(spark, sf_dir):
    f = _feats(spark, sf_dir)
    return f.select(KEY_COLUMN, *[r6(F.col(z)).alias(z) for z in R.Z], "location_bucket", "type_key",
                    r6(F.col("norm")).alias("norm"))


@register("similar_listings")
def q_similar_listings(spark, sf_dir):
    f = _feats(spark, sf_dir)
    out = R.similar_listings(f, R.row_at(f, 0).drop("_order_u"), 5)
    return out.withColumn("similarity", r6(F.col("similarity"))).withColumn("cost_per_day", r6(F.col("cost_per_day")))


@register("batch_recommend")
def q_batch_recommend(spark, sf_dir):
    out = R.batch_recommend(_feats(spark, sf_dir), None, 5)
    return out.withColumn("similarity", r6(F.col("similarity"))).withColumn("cost_per_day", r6(F.col("cost_per_day")))


@register("batch_recommend_many")
def q_batch_recommend_many(spark, sf_dir):
    """200 seeds spread over the table, and two beyond its end."""
    f = _feats(spark, sf_dir)
    n = f.count()
    out = R.batch_recommend(f, [i * n // 200 for i in range(200)] + [n, n + 7], 3)
    return out.select("seed_index", "query_key", KEY_COLUMN, r6(F.col("similarity")).alias("similarity"))


@register("recommend_preferences")
def q_recommend_preferences(spark, sf_dir):
    out = R.recommend_preferences(clean_fixture(spark, sf_dir), top_k=8, **PREFS)
    return (out.withColumn("similarity_to_ideal", r6(F.col("similarity_to_ideal")))
            .withColumn("cost_per_day", r6(F.col("cost_per_day"))))


@register("preference_filter")
def q_preference_filter(spark, sf_dir):
    prep = R.prepare_numeric(clean_fixture(spark, sf_dir))
    out = FL.preference_filter(prep, types=["Standard", "offer", "PROMO"], **PREFS)
    return out.select(KEY_COLUMN, "price", "rating", "location", "type")


# ---- sentiment -----------------------------------------------------------------

def _scored(spark, sf_dir, digits=None):
    lex = X.lexicon_frame(spark, LEXICON)
    return X.sentiment(FX.reviews(spark, sf_dir), lex, "doc_id", digits=digits)


@register("sentiment")
def q_sentiment(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.select("doc_id", *[r6(F.col(c)).alias(c) for c in ("sentiment_compound", "sentiment_pos",
                                                                 "sentiment_neg", "sentiment_neu")])


@register("sentiment_phrases")
def q_sentiment_phrases(spark, sf_dir):
    s = X.sentiment(FX.reviews(spark, sf_dir), X.lexicon_frame(spark, LEXICON + PHRASES), "doc_id", digits=None)
    return s.select("doc_id", *[r6(F.col(c)).alias(c) for c in ("sentiment_compound", "sentiment_pos",
                                                                 "sentiment_neg", "sentiment_neu")])


@register("sentiment_by_language")
def q_sentiment_by_language(spark, sf_dir):
    r = X.sentiment_rollup(_scored(spark, sf_dir, digits=(4, 3)), "location")
    return r.select("location", "reviews", *[r6(F.col(c)).alias(c) for c in r.columns if c.startswith("avg_")])


@register("sentiment_histogram")
def q_sentiment_histogram(spark, sf_dir):
    return _hist6(CD.histogram(_scored(spark, sf_dir, digits=(4, 3)), "sentiment_compound", CD.SENTIMENT_BINS))


@register("sentiment_histogram_dashboard")
def q_sentiment_histogram_dashboard(spark, sf_dir):
    return _hist6(CD.histogram(_scored(spark, sf_dir, digits=(4, 3)), "sentiment_compound", CD.SENTIMENT_BINS_DASHBOARD))


@register("sentiment_passthrough")
def q_sentiment_passthrough(spark, sf_dir):
    """Without a lexicon the rows pass through."""
    return X.sentiment(FX.reviews(spark, sf_dir), None, "doc_id").select("doc_id", "name", "location", "source", "review_text")
