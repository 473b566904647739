"""ANSI-SQL (DuckDB dialect) building blocks for the oracle twins.

Each macro mirrors one column function of ``wayfarer.functions`` so the SQL
twins state the same semantics independently of the DataFrame code.
"""

from __future__ import annotations

# The twins' own constants: they share none with the engine that they check.
# --- Fixed values ---------------------------------------------------------------
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
             "NULL", "NaN", "None", "n/a", "nan", "null"]
WHITESPACE = [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
PRICE_NUMBER = r"[0-9]+(?:[.][0-9]+)?"
DURATION_NUMBER = r"[0-9]+(?:[.,][0-9]+)?"
# --------------------------------------------------------------------------------

U_RANGE_SQL = "1152921504606846976.0"  # 2**60


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WHITESPACE_SQL = " || ".join(f"chr({ch})" for ch in WHITESPACE)


def strip(x: str) -> str:
    return f"trim({x}, {WHITESPACE_SQL})"


def na(x: str) -> str:
    toks = ", ".join(q(t) for t in NA_TOKENS)
    return f"(CASE WHEN {x} IN ({toks}) THEN NULL ELSE {x} END)"


def nan_null(x: str) -> str:
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"


def hash_u(key: str, seed) -> str:
    return f"CAST(concat('0x', substr(md5(concat({key}, ':', {q(str(seed))})), 1, 15)) AS BIGINT)"


def listing_key(name="name", location="location", price="price", source="source") -> str:
    parts = [f"coalesce('v' || CAST({c} AS VARCHAR), 'n')" for c in (name, location, price, source)]
    return f"md5(concat_ws(chr(1), {', '.join(parts)}))"


def rnd(x: str, digits: int = 6) -> str:
    return f"round_even({x}, {digits})"


def parse_price_text(x: str) -> str:
    m = f"regexp_extract(translate(CAST({x} AS VARCHAR), ',' || chr(160), '  '), {q(PRICE_NUMBER)}, 0)"
    return f"(CASE WHEN {m} <> '' THEN CAST({m} AS DOUBLE) END)"


def parse_duration_text(x: str) -> str:
    t = f"lower({strip(x)})"
    m = f"regexp_extract({t}, {q(DURATION_NUMBER)}, 0)"
    v = f"(CASE WHEN {m} <> '' THEN CAST(replace({m}, ',', '.') AS DOUBLE) END)"
    hours = f"(contains({t}, 'hour') OR contains({t}, 'hr') OR ends_with({t}, 'h'))"
    return (f"round_even(CASE WHEN contains({t}, 'week') THEN {v} * 7 "
            f"WHEN {hours} THEN {v} / 24.0 ELSE {v} END, 2)")


RAW_LISTINGS = """
SELECT concat(CASE WHEN l_linenumber = 1 THEN '  ' ELSE '' END,
              CASE WHEN l_linenumber = 6 AND l_quantity <= 2 THEN 'NaN' ELSE concat(p_name, ' ', p_brand) END) AS name,
       CASE WHEN l_linenumber = 4 THEN NULL WHEN l_linenumber = 5 THEN '' ELSE concat(p_type, ' ') END AS type,
       CASE WHEN n_nationkey = 24 THEN NULL ELSE n_name END AS location,
       CASE WHEN l_tax >= 0.08 THEN NULL ELSE CAST(floor(l_extendedprice / 1000) * 1000 AS DOUBLE) END AS price,
       CASE WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber = 3 THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS duration,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE 3.0 + l_discount * 20.0 END AS rating,
       CASE WHEN o_orderkey % 500 = 0 THEN 'rare' ELSE concat(o_orderpriority, ' ') END AS source,
       CAST(NULL AS VARCHAR) AS review_text
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
     JOIN nation ON s_nationkey = n_nationkey JOIN orders ON l_orderkey = o_orderkey
"""


def clean_ctes(raw: str = "raw") -> str:
    """CTEs norm..clean over a CTE named ``raw`` holding the eight listing columns."""
    return f"""
norm AS (
  SELECT {strip('name')} AS name, {strip('location')} AS location, {strip('lower(type)')} AS type,
         {strip('source')} AS source, nullif({strip('review_text')}, '') AS review_text,
         {nan_null('price')} AS price, {nan_null('duration')} AS duration, {nan_null('rating')} AS rating
  FROM {raw}),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY name, location, price, source
      ORDER BY type NULLS LAST, duration NULLS LAST, rating NULLS LAST, review_text NULLS LAST) AS rn
    FROM norm) WHERE rn = 1),
valid AS (
  SELECT * FROM dedup
  WHERE name IS NOT NULL AND name <> '' AND lower(name) <> 'nan' AND price IS NOT NULL),
keyed AS (
  SELECT name, location, price, source, review_text, rating,
         CASE WHEN duration IS NULL OR duration = 0 THEN 1.0 ELSE duration END AS duration,
         coalesce(nullif(type, ''), 'offer') AS type,
         {listing_key()} AS listing_key
  FROM valid),
obs AS (SELECT rating, count(*) AS cnt FROM keyed WHERE rating IS NOT NULL GROUP BY rating),
cum AS (
  SELECT rating AS draw,
         sum(cnt) OVER (ORDER BY rating ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cnt AS lo,
         sum(cnt) OVER (ORDER BY rating ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi
  FROM obs),
nobs AS (SELECT count(*) AS n FROM keyed WHERE rating IS NOT NULL),
drawn AS (
  SELECT keyed.*, CASE WHEN keyed.rating IS NULL AND nobs.n > 0
                       THEN {hash_u('listing_key', 42)} % nobs.n END AS d
  FROM keyed, nobs),
imputed AS (
  SELECT k.name, k.type, k.location, k.price, k.duration,
         coalesce(k.rating, c.draw, 3.0 + 2.0 * ({hash_u('k.listing_key', 42)} / {U_RANGE_SQL})) AS rating,
         k.source, k.review_text, k.listing_key
  FROM drawn k LEFT JOIN cum c ON k.d >= c.lo AND k.d < c.hi),
clean AS (
  SELECT {na('name')} AS name, {na('type')} AS type, {na('location')} AS location, price, duration, rating,
         {na('source')} AS source, {na('review_text')} AS review_text, listing_key
  FROM imputed)"""


def with_clean(body: str, extra: str = "") -> str:
    """A full statement: raw fixture -> clean stage [-> extra CTEs] -> ``body``."""
    more = f",\n{extra}" if extra else ""
    return f"WITH raw AS ({RAW_LISTINGS}),{clean_ctes()}{more}\n{body}"


def with_raw(body: str) -> str:
    return f"WITH raw AS ({RAW_LISTINGS})\n{body}"


def num_first(x: str) -> str:
    """First unsigned number of a numeric value's text form (sign dropped)."""
    ax = f"abs({x})"
    m = f"regexp_extract(CAST({x} AS VARCHAR), {q(PRICE_NUMBER)}, 0)"
    return (f"(CASE WHEN isnan({x}) OR {ax} = CAST('inf' AS DOUBLE) THEN NULL "
            f"WHEN ({ax} >= 1e-4 AND {ax} < 1e16) OR {ax} = 0 THEN {ax} "
            f"ELSE (CASE WHEN {m} <> '' THEN CAST({m} AS DOUBLE) END) END)")


def review(x: str) -> str:
    s = strip(x)
    return f"(CASE WHEN {s} <> '' AND lower({s}) <> 'nan' THEN {s} END)"


NUMERIC_TEXT_SQL = r"^[+-]?(([0-9]+([.][0-9]*)?|[.][0-9]+)([e][+-]?[0-9]+)?|inf|infinity|nan)$"


def to_double_text(x: str) -> str:
    t = f"lower(trim(CAST({x} AS VARCHAR)))"
    v = f"(CASE WHEN regexp_matches({t}, {q(NUMERIC_TEXT_SQL)}) THEN TRY_CAST({t} AS DOUBLE) END)"
    return nan_null(v)


STAR = """lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
     JOIN nation ON s_nationkey = n_nationkey JOIN orders ON l_orderkey = o_orderkey"""

FEEDS = f"""
fbase AS (
  SELECT concat(p_name, ' ', p_brand) AS _name, n_name AS _loc,
         CASE l_linenumber WHEN 2 THEN 'NA' WHEN 3 THEN 'None' WHEN 4 THEN 'NULL' WHEN 5 THEN 'nan' WHEN 6 THEN 'N/A'
              WHEN 7 THEN NULL ELSE p_type END AS _type,
         l_extendedprice AS _price, l_quantity AS _dur,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE 3.0 + l_discount * 20.0 END AS _rating,
         o_orderpriority AS _review
  FROM {STAR}),
feed_a AS (SELECT _name AS hotel_name, _loc AS city, _type AS property_type, _price AS price_per_night,
                  _dur AS nights, _rating AS rating, _review AS review_snippet FROM fbase),
feed_b AS (SELECT _name AS title, _loc AS destination, _type AS attraction_type, _price AS total_price,
                  _dur AS days, _rating AS review_rating, _review AS review_excerpt FROM fbase),
feed_c AS (SELECT _name AS Hotel_Name, _price AS Price, _rating AS Rating, _loc AS Location, _review AS Review
           FROM fbase)"""


def mapped(src: str, name: str, typ: str | None, loc: str, price: str, dur: str | None, rating: str,
           rev: str, label: str, default_type: str) -> str:
    tval = f"coalesce({na(f'CAST({typ} AS VARCHAR)')}, {q(default_type)})" if typ else q(default_type)
    d = f"round_even({num_first(dur)}, 2)" if dur else "CAST(NULL AS DOUBLE)"
    return (f"SELECT {na(strip(name))} AS name, {na(f'lower({strip(tval)})')} AS type, {na(strip(loc))} AS location, "
            f"{num_first(price)} AS price, {d} AS duration, {nan_null(f'CAST({rating} AS DOUBLE)')} AS rating, "
            f"{q(label)} AS source, {na(review(rev))} AS review_text FROM {src}")


MAP_A = mapped("feed_a", "hotel_name", "property_type", "city", "price_per_night", "nights", "rating",
               "review_snippet", "booking:export_sample", "hotel")
MAP_B = mapped("feed_b", "title", "attraction_type", "destination", "total_price", "days", "review_rating",
               "review_excerpt", "tripadvisor:export_sample", "offer")
MAP_C = mapped("feed_c", "Hotel_Name", None, "Location", "Price", None, "Rating", "Review",
               "external:feed_c", "offer")

BOOKING_RAW = """
SELECT DISTINCT CASE WHEN o_orderstatus = 'F' THEN 'City Hotel' ELSE 'Resort Hotel' END AS hotel,
       n_name AS country,
       CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice / 1000 END AS adr,
       CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_linenumber % 3 END AS stays_in_weekend_nights,
       CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity % 7 END AS stays_in_week_nights,
       l_orderkey AS booking_ref
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
     JOIN orders ON l_orderkey = o_orderkey"""


def booking_demand(max_rows: int | None = None) -> str:
    lim = f"AND rn <= {int(max_rows)}" if max_rows else ""
    return f"""
WITH bd AS ({BOOKING_RAW}),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY hotel NULLS LAST, country NULLS LAST, adr NULLS LAST,
      stays_in_weekend_nights NULLS LAST, stays_in_week_nights NULLS LAST, booking_ref NULLS LAST) AS rn
  FROM bd)
SELECT concat({strip("coalesce(hotel, 'nan')")}, ' — booking ', CAST(rn AS VARCHAR)) AS name,
       'hotel' AS type, {na(strip("coalesce(country, 'nan')"))} AS location,
       {nan_null('CAST(adr AS DOUBLE)')} AS price,
       greatest(1.0, coalesce(CAST(stays_in_weekend_nights AS DOUBLE), 0.0)
                     + coalesce(CAST(stays_in_week_nights AS DOUBLE), 0.0)) AS duration,
       CAST(NULL AS DOUBLE) AS rating, 'kaggle:hotel_booking_demand' AS source,
       CAST(NULL AS VARCHAR) AS review_text
FROM numbered WHERE adr IS NOT NULL {lim}"""


def cost_raw(price: str = "price", duration: str = "duration") -> str:
    v = f"round_even(CASE WHEN {duration} = 0 THEN NULL ELSE {price} / {duration} END, 2)"
    return f"(CASE WHEN isnan({v}) OR abs({v}) = CAST('inf' AS DOUBLE) THEN NULL ELSE {v} END)"


def cost_default(price: str = "price", duration: str = "duration") -> str:
    d = f"(CASE WHEN {duration} IS NULL OR {duration} = 0 THEN 1.0 ELSE {duration} END)"
    v = f"({price} / {d})"
    return f"(CASE WHEN isnan({v}) OR abs({v}) = CAST('inf' AS DOUBLE) THEN NULL ELSE {v} END)"


def analytics(src: str = "clean") -> str:
    """P11 over a listing relation: defaulted duration, cost_per_day, categorical 'nan'."""
    return (f"SELECT coalesce(name, 'nan') AS name, coalesce(type, 'nan') AS type, "
            f"coalesce(location, 'nan') AS location, price, "
            f"CASE WHEN duration IS NULL OR duration = 0 THEN 1.0 ELSE duration END AS duration, rating, "
            f"coalesce(source, 'nan') AS source, review_text, listing_key, {cost_default()} AS cost_per_day "
            f"FROM {src}")


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"
