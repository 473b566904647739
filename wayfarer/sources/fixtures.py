"""Listing-shaped views over the generated star-schema test tables.

Every fixture is derived by Spark from the given tables, so its size grows
with them. Each has an ANSI-SQL twin in ``wayfarer.plans.oracle``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfarer.session import materialize, spread_if_narrow


#: Rows of a table that are broadcast at most: of two numbers each, and of texts.
FEW_NUMBERS, FEW_TEXTS = 1_000_000, 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _dimension(df: DataFrame, few: int) -> DataFrame:
    """A table of one row per key, broadcast where it has at most ``few`` rows; of a larger one only the table itself is
    held in hash maps by key range, so that the many rows beside it are shuffled but not sorted."""
    return F.broadcast(df) if df.count() <= few else df.hint("shuffle_hash")


def _lineitem_star(spark: SparkSession, sf_dir: str, line: dict, order: dict | None = None, with_part: bool = True) -> DataFrame:
    """Columns ``line`` of ``lineitem`` and ``order`` of ``orders``, n_nationkey and n_name, and the texts of ``part``.

    Both are expressions computed at the scan. The small tables come first and
    the texts last, so that what is shuffled by order and by part are a row's
    keys and its few numbers.
    """
    keys = ["l_orderkey", "l_suppkey", *(["l_partkey"] if with_part else [])]
    j = spread_if_narrow(table(spark, sf_dir, "lineitem").select(*keys, *[c.alias(n) for n, c in line.items()]), "l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", *[c.alias(n) for n, c in (order or {}).items()])
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (j.join(_dimension(supplier, FEW_NUMBERS), F.col("l_suppkey") == F.col("s_suppkey")).drop("l_suppkey", "s_suppkey")
         .join(_dimension(orders, FEW_TEXTS), F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey"))
    if with_part:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
        j = j.join(_dimension(part, FEW_TEXTS), F.col("l_partkey") == F.col("p_partkey")).drop("l_partkey", "p_partkey")
    return j.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).drop("s_nationkey")


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty listings: padded names, 'NaN' names, blank/NULL types, NULL and
    zero durations, missing ratings/prices/locations and one rare source."""
    ln = F.col("l_linenumber")
    j = _lineitem_star(spark, sf_dir, {
        "ln": ln,
        "no_name": (ln == 6) & (F.col("l_quantity") <= 2),
        "price": F.when(F.col("l_tax") >= 0.08, F.lit(None).cast("double"))
                  .otherwise((F.floor(F.col("l_extendedprice") / 1000) * 1000).cast("double")),
        "duration": F.when(ln == 2, F.lit(None).cast("double")).when(ln == 3, F.lit(0.0)).otherwise(F.col("l_quantity")),
        "rating": F.when(F.col("l_returnflag") == "R", F.lit(None).cast("double")).otherwise(3.0 + F.col("l_discount") * 20.0),
    }, {"source": F.when(F.col("o_orderkey") % 500 == 0, F.lit("rare")).otherwise(F.concat(F.col("o_orderpriority"), F.lit(" ")))})
    ln = F.col("ln")
    name = F.concat(F.when(ln == 1, F.lit("  ")).otherwise(F.lit("")),
                    F.when(F.col("no_name"), F.lit("NaN"))
                    .otherwise(F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand"))))
    return j.select(
        name.alias("name"),
        F.when(ln == 4, F.lit(None).cast("string")).when(ln == 5, F.lit(""))
         .otherwise(F.concat(F.col("p_type"), F.lit(" "))).alias("type"),
        F.when(F.col("n_nationkey") == 24, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("location"),
        "price", "duration", "rating", "source",
        F.lit(None).cast("string").alias("review_text"),
    )


DURATION_UNITS = [" days", " weeks", "h", " month"]


def text_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-text price / duration strings built from ``part``."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    unit = F.element_at(F.array(*[F.lit(u) for u in DURATION_UNITS]), (F.col("p_partkey") % 4 + 1).cast("int"))
    return part.select(
        "p_partkey",
        F.concat(F.lit("$"), F.col("p_retailprice").cast("string"), F.lit(" / night")).alias("price_text"),
        F.concat(F.col("p_size").cast("string"), unit).alias("duration_text"),
    )


def feed_frames(spark: SparkSession, sf_dir: str, once: bool = False) -> dict[str, DataFrame]:
    """Three feed shapes (booking / attraction / external CSV), each over the whole
    of ``lineitem``; some types are texts that mean a missing value. ``once``: the joined rows are written once, for
    queries that read several feeds."""
    j = _lineitem_star(spark, sf_dir, {
        "ln": F.col("l_linenumber"),
        "_price": F.col("l_extendedprice"),
        "_dur": F.col("l_quantity"),
        "_rating": F.when(F.col("l_returnflag") == "R", F.lit(None).cast("double")).otherwise(3.0 + F.col("l_discount") * 20.0),
    }, {"_review": F.col("o_orderpriority")})
    ln = F.col("ln")
    base = j.select(
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand")).alias("_name"),
        F.col("n_name").alias("_loc"),
        F.when(ln == 2, "NA").when(ln == 3, "None").when(ln == 4, "NULL").when(ln == 5, "nan").when(ln == 6, "N/A")
         .when(ln == 7, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("_type"),
        "_price", "_dur", "_rating", "_review")
    if once:
        base = materialize(base, "feeds")
    feed_a = base.select(
        F.col("_name").alias("hotel_name"), F.col("_loc").alias("city"), F.col("_type").alias("property_type"),
        F.col("_price").alias("price_per_night"), F.col("_dur").alias("nights"), F.col("_rating").alias("rating"),
        F.col("_review").alias("review_snippet"))
    feed_b = base.select(
        F.col("_name").alias("title"), F.col("_loc").alias("destination"), F.col("_type").alias("attraction_type"),
        F.col("_price").alias("total_price"), F.col("_dur").alias("days"), F.col("_rating").alias("review_rating"),
        F.col("_review").alias("review_excerpt"))
    feed_c = base.select(
        F.col("_name").alias("Hotel_Name"), F.col("_price").alias("Price"), F.col("_rating").alias("Rating"),
        F.col("_loc").alias("Location"), F.col("_review").alias("Review"))
    return {"feed_a": feed_a, "feed_b": feed_b, "feed_c": feed_c}


def booking_demand_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hotel-booking-demand shaped rows with messy headers, de-duplicated."""
    j = _lineitem_star(spark, sf_dir, {
        "ADR": F.when(F.col("l_tax") == 0, F.lit(None).cast("double")).otherwise(F.col("l_extendedprice") / 1000),
        "weekend": F.when(F.col("l_linenumber") % 4 == 0, F.lit(None).cast("int")).otherwise(F.col("l_linenumber") % 3),
        "week": F.when(F.col("l_discount") == 0, F.lit(None).cast("double")).otherwise(F.col("l_quantity") % 7),
    }, {"hotel": F.when(F.col("o_orderstatus") == "F", F.lit("City Hotel")).otherwise(F.lit("Resort Hotel"))}, with_part=False)
    return j.select(
        F.col("hotel").alias(" Hotel"),
        F.col("n_name").alias("Country"),
        "ADR",
        F.col("weekend").alias("Stays In Weekend Nights"),
        F.col("week").alias("stays_in_week_nights"),
        F.col("l_orderkey").alias("booking_ref"),
    ).distinct()


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as listings with review text (whole texts)."""
    docs = spread_if_narrow(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    return docs.select(
        F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("name"),
        F.lit("review").alias("type"),
        F.col("lang").alias("location"),
        F.lit(None).cast("double").alias("price"),
        F.lit(None).cast("double").alias("duration"),
        F.lit(None).cast("double").alias("rating"),
        F.col("source").alias("source"),
        F.col("text").alias("review_text"),
        F.col("doc_id"),
    )


def numeric_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text numbers in several shapes: plain, padded, Java-suffixed, grouped,
    infinities, NaN and junk."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    size = F.col("p_size").cast("string")
    k = F.col("p_partkey") % 7
    text = (F.when(k == 0, F.col("p_retailprice").cast("string"))
            .when(k == 1, F.concat(F.lit(" "), size, F.lit(" ")))
            .when(k == 2, F.concat(size, F.lit("d")))
            .when(k == 3, F.concat(F.lit("1,"), size))
            .when(k == 4, F.when(F.col("p_size") % 2 == 0, F.lit("inf")).otherwise(F.lit("-Infinity")))
            .when(k == 5, F.when(F.col("p_size") % 2 == 0, F.lit("NaN")).otherwise(F.lit("abc")))
            .otherwise(F.concat(size, F.lit("e-2"))))
    return part.select("p_partkey", text.alias("value_text"))
