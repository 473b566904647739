"""Schemas, fixed value lists and the source-spec type."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LISTING_COLUMNS = ["name", "type", "location", "price", "duration", "rating", "source", "review_text"]
STRING_COLUMNS = ["name", "type", "location", "source", "review_text"]
NUMERIC_COLUMNS = ["price", "duration", "rating"]

LISTING_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("source", T.StringType()),
    T.StructField("review_text", T.StringType()),
])

SENTIMENT_COLUMNS = ["sentiment_compound", "sentiment_pos", "sentiment_neg", "sentiment_neu"]

KEY_COLUMN = "listing_key"

# --- Fixed values (must equal the behaviour being matched) -------------------
# Text that a CSV reader with pandas defaults turns into a missing value.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]
# Characters removed by Python's str.strip(): every code point Python calls
# whitespace (the largest is U+3000), derived by rule rather than listed.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
DEFAULT_TYPE = "offer"
# Header aliases for folder auto-import: target column -> candidate headers,
# first existing header wins (compared case-insensitively).
HEADER_ALIASES = {
    "name": ["name", "title", "hotel_name"],
    "type": ["type"],
    "location": ["location", "city", "destination"],
    "price": ["price", "avg_price"],
    "duration": ["duration", "days", "duration_days"],
    "rating": ["rating", "review_score"],
    "review_text": ["review_text", "review_snippet", "comments", "user_review", "review"],
}
TIER_LABELS = ["budget", "mid-range", "premium"]
UNCLASSIFIED = "unclassified"
# Preset feed specs (booking-style and attraction-style exports).
BOOKING_MAPPING = {
    "name": "hotel_name", "location": "city", "price": "price_per_night", "duration": "nights",
    "rating": "rating", "type": "property_type", "review_text": "review_snippet",
}
ATTRACTION_MAPPING = {
    "name": "title", "location": "destination", "price": "total_price", "duration": "days",
    "rating": "review_rating", "type": "attraction_type", "review_text": "review_excerpt",
}
BOOKING_NAME, ATTRACTION_NAME = "booking:export_sample", "tripadvisor:export_sample"
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class SourceSpec:
    """One feed: where it lives, how its columns map to the listing schema."""

    name: str
    path: str
    mapping: dict = field(default_factory=dict)
    default_type: str = DEFAULT_TYPE


def booking_spec(path: str, name: str = BOOKING_NAME) -> SourceSpec:
    return SourceSpec(name=name, path=path, mapping=dict(BOOKING_MAPPING), default_type="hotel")


def attraction_spec(path: str, name: str = ATTRACTION_NAME) -> SourceSpec:
    return SourceSpec(name=name, path=path, mapping=dict(ATTRACTION_MAPPING), default_type="offer")
