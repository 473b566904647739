"""Schema mapping (arbitrary feed columns -> the eight listing columns) and unions."""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfarer.functions.numeric import to_double
from wayfarer.functions.parse import parse_duration, parse_price
from wayfarer.functions.text import clean_review, null_if_na_token, strip
from wayfarer.schema import DEFAULT_TYPE, LISTING_COLUMNS, LISTING_SCHEMA


def empty_listings(spark: SparkSession, schema: T.StructType = LISTING_SCHEMA) -> DataFrame:
    return spark.createDataFrame([], schema)


def normalize_headers(df: DataFrame, underscores: bool = False) -> DataFrame:
    """Strip + lower every header (optionally spaces -> '_'); collisions are an error."""
    names = []
    for c in df.columns:
        n = str(c).strip().lower()
        if underscores:
            n = n.replace(" ", "_")
        names.append(n)
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"header collision after normalisation: {sorted(dup)}")
    return df.toDF(*names)


def complete_columns(df: DataFrame, columns: Iterable[str] = LISTING_COLUMNS,
                     schema: T.StructType = LISTING_SCHEMA) -> DataFrame:
    """Add missing listing columns as typed NULLs and put them in order (extras kept last)."""
    types = {f.name: f.dataType for f in schema.fields}
    cols = list(columns)
    present = set(df.columns)
    sel = [F.col(c) if c in present else F.lit(None).cast(types.get(c, T.StringType())).alias(c) for c in cols]
    extras = [F.col(c) for c in df.columns if c not in cols]
    return df.select(*sel, *extras)


def map_to_listing_schema(df: DataFrame, mapping: Mapping[str, str], source_name: str,
                          default_type: str = DEFAULT_TYPE, source_col: Column | None = None,
                          keep: Sequence[str] = ()) -> DataFrame:
    """Project any feed onto the listing schema in a single ``select`` (and the columns to ``keep`` behind it).

    Unmapped / absent targets are NULL; ``source`` is the label (or the
    per-row ``source_col`` expression, e.g. built from the file name); ``type`` is
    defaulted, stripped and lower-cased; prices / durations are parsed from
    text; ratings are coerced; text that is blank or an NA token is NULL.
    """
    types = {f.name: f.dataType for f in df.schema.fields}

    def src(target: str) -> tuple[Column | None, T.DataType]:
        c = mapping.get(target)
        if c and c in types:
            return F.col(f"`{c}`"), types[c]
        return None, T.NullType()

    def text(target: str) -> Column:
        c, _ = src(target)
        if c is None:
            return F.lit(None).cast("string")
        return null_if_na_token(strip(c))

    name = text("name")
    location = text("location")
    tcol, _ = src("type")
    # an NA token in the cell is a missing type, which takes the default
    tval = (F.coalesce(null_if_na_token(tcol.cast("string")), F.lit(default_type)) if tcol is not None
            else F.lit(default_type))
    typ = null_if_na_token(F.lower(strip(tval)))
    rcol, _ = src("review_text")
    review = null_if_na_token(clean_review(rcol)) if rcol is not None else F.lit(None).cast("string")
    pcol, ptype = src("price")
    price = parse_price(pcol, ptype) if pcol is not None else F.lit(None).cast("double")
    dcol, dtype = src("duration")
    duration = parse_duration(dcol, dtype) if dcol is not None else F.lit(None).cast("double")
    rtcol, rtype = src("rating")
    rating = to_double(rtcol, rtype) if rtcol is not None else F.lit(None).cast("double")
    return df.select(
        name.alias("name"), typ.alias("type"), location.alias("location"),
        price.cast("double").alias("price"), duration.cast("double").alias("duration"),
        rating.cast("double").alias("rating"), (source_col if source_col is not None else F.lit(source_name)).alias("source"),
        review.alias("review_text"), *keep,
    )


def union_frames(frames: Iterable[DataFrame | None], spark: SparkSession | None = None) -> DataFrame:
    """Union by column name; missing columns become NULL; nothing -> empty listing table."""
    frames = [f for f in frames if f is not None]
    if not frames:
        if spark is None:
            spark = SparkSession.getActiveSession()
        return empty_listings(spark)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
