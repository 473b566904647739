"""SQL twins (DuckDB dialect) of the registered queries, over the same tables.

They restate each operator's semantics with window functions and plain
aggregates (exact median = ``quantile_cont``; ordered draws = ``row_number``),
independently of the DataFrame implementation.
"""

from __future__ import annotations

from wayfarer.plans import queries as Q
from wayfarer.plans.sqlparts import (
    FEEDS, MAP_A, MAP_B, MAP_C, RAW_LISTINGS, analytics, booking_demand, clean_ctes, cost_default, cost_raw,
    in_list, na, nan_null, parse_duration_text, parse_price_text, rnd, strip, to_double_text, with_clean,
)

ORACLE: dict[str, str] = {}

NORM = f"""WITH raw AS ({RAW_LISTINGS}),
norm AS (
  SELECT {strip('name')} AS name, {strip('location')} AS location, {strip('lower(type)')} AS type,
         {strip('source')} AS source, nullif({strip('review_text')}, '') AS review_text,
         {nan_null('price')} AS price, {nan_null('duration')} AS duration, {nan_null('rating')} AS rating
  FROM raw)
"""
DEDUP = """SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY name, location, price, source
      ORDER BY type NULLS LAST, duration NULLS LAST, rating NULLS LAST, review_text NULLS LAST) AS rn
    FROM norm) WHERE rn = 1"""
TEXT = "WITH t AS (SELECT p_partkey, concat('$', CAST(p_retailprice AS VARCHAR), ' / night') AS price_text, " \
       "concat(CAST(p_size AS VARCHAR), [' days', ' weeks', 'h', ' month'][p_partkey % 4 + 1]) AS duration_text " \
       "FROM part)"
NUMTEXT = """WITH t AS (SELECT p_partkey, CASE p_partkey % 7
    WHEN 0 THEN CAST(p_retailprice AS VARCHAR)
    WHEN 1 THEN concat(' ', CAST(p_size AS VARCHAR), ' ')
    WHEN 2 THEN concat(CAST(p_size AS VARCHAR), 'd')
    WHEN 3 THEN concat('1,', CAST(p_size AS VARCHAR))
    WHEN 4 THEN CASE WHEN p_size % 2 = 0 THEN 'inf' ELSE '-Infinity' END
    WHEN 5 THEN CASE WHEN p_size % 2 = 0 THEN 'NaN' ELSE 'abc' END
    ELSE concat(CAST(p_size AS VARCHAR), 'e-2') END AS value_text FROM part)"""
ANALYTICS = f"a AS ({analytics('clean')})"


def _explorer_where() -> str:
    e = Q.EXPLORER
    (plo, phi), (rlo, rhi) = e["price_range"], e["rating_range"]
    types = sorted({t.lower() for t in e["types"]})
    return (f"price BETWEEN {plo} AND {phi} AND rating BETWEEN {rlo} AND {rhi} "
            f"AND location IN {in_list(e['locations'])} AND source IN {in_list(e['sources'])} "
            f"AND lower(type) IN {in_list(types)}")


# ---- clean stage -------------------------------------------------------------

ORACLE["clean_pipeline"] = with_clean("SELECT * FROM clean")
ORACLE["string_norm"] = NORM + "SELECT name, location, type, source, review_text FROM norm"
ORACLE["numeric_coerce"] = NUMTEXT + f"\nSELECT p_partkey, value_text, {to_double_text('value_text')} AS value FROM t"
ORACLE["dedup_listings"] = NORM + DEDUP
ORACLE["valid_rows"] = NORM + ("SELECT * FROM norm WHERE name IS NOT NULL AND name <> '' "
                               "AND lower(name) <> 'nan' AND price IS NOT NULL")
ORACLE["defaults"] = NORM + ("SELECT name, coalesce(nullif(type, ''), 'offer') AS type, location, price, "
                             "CASE WHEN duration IS NULL OR duration = 0 THEN 1.0 ELSE duration END AS duration, "
                             "rating, source, review_text FROM norm")
ORACLE["impute_rating"] = with_clean("SELECT listing_key, rating FROM clean")
ORACLE["complete_rows"] = NORM + "SELECT * FROM norm WHERE price IS NOT NULL AND rating IS NOT NULL"

# ---- parsing / mapping / imports ----------------------------------------------

ORACLE["parse_price"] = TEXT + f"\nSELECT p_partkey, price_text, {parse_price_text('price_text')} AS price FROM t"
ORACLE["parse_duration"] = TEXT + (f"\nSELECT p_partkey, duration_text, {parse_duration_text('duration_text')} "
                                   "AS duration FROM t")
ORACLE["map_schema"] = f"WITH {FEEDS}\n{MAP_A}"
ORACLE["import_sources"] = f"WITH {FEEDS}\n{MAP_A}\nUNION ALL\n{MAP_B}"
ORACLE["header_alias_import"] = f"WITH {FEEDS}\n{MAP_C}"
ORACLE["external_distinct"] = f"WITH {FEEDS}\nSELECT DISTINCT * FROM ({MAP_A}\nUNION ALL\n{MAP_B}\nUNION ALL\n{MAP_C})"
ORACLE["union_sources"] = (f"WITH {FEEDS}\n{MAP_A}\nUNION ALL\nSELECT title AS name, NULL AS type, NULL AS location, "
                           "total_price AS price, NULL AS duration, NULL AS rating, NULL AS source, "
                           "NULL AS review_text FROM feed_b")
# the sink writes text without the blanks around it
ORACLE["csv_round_trip"] = f"""WITH raw AS ({RAW_LISTINGS})
SELECT trim(name) AS name, nullif(trim(type), '') AS type, 'é' || location AS location, price, duration, rating, trim(source) AS source,
       CAST(NULL AS VARCHAR) AS review_text FROM raw"""
ORACLE["result_sinks"] = with_clean(f"""
SELECT sink, location, listings, avg_price, avg_rating FROM
  (SELECT location, count(name) AS listings, {rnd('avg(price)')} AS avg_price, {rnd('avg(rating)')} AS avg_rating
   FROM clean WHERE location IS NOT NULL GROUP BY location), (SELECT unnest(['parquet', 'csv', 'json']) AS sink)""")
ORACLE["booking_demand"] = booking_demand()
ORACLE["booking_demand_head"] = booking_demand(20000)

# ---- projections ---------------------------------------------------------------

ORACLE["cost_per_day"] = with_clean(f"SELECT listing_key, {rnd(cost_raw())} AS cost_per_day_summary, "
                                    f"{rnd(cost_default())} AS cost_per_day FROM clean")
ORACLE["analytics_projection"] = with_clean(
    f"SELECT * EXCLUDE (cost_per_day), {rnd('cost_per_day')} AS cost_per_day FROM a", ANALYTICS)


def _fmt(x: str, sym: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) THEN '—' "
            f"WHEN {x} = CAST('inf' AS DOUBLE) THEN '{sym}inf' WHEN {x} = CAST('-inf' AS DOUBLE) THEN '{sym}-inf' "
            f"ELSE concat('{sym}', format('{{:,.2f}}', {x})) END")


ORACLE["format_price"] = with_clean(f"SELECT listing_key, price, {_fmt('price', '€')} AS price_fmt, "
                                    f"{_fmt('rating', 'XYZ ')} AS rating_fmt FROM clean")


# ---- filters -------------------------------------------------------------------

ORACLE["explorer_filter"] = with_clean(
    f"SELECT * EXCLUDE (cost_per_day), {rnd('cost_per_day')} AS cost_per_day FROM a WHERE {_explorer_where()}",
    ANALYTICS)
ORACLE["explorer_stage"] = with_clean(f"""
SELECT c.listing_key, c.name, c.location, c.source, c.price, c.rating FROM clean c JOIN a USING (listing_key)
WHERE {_explorer_where().replace("price B", "a.price B").replace("rating B", "a.rating B").replace("location IN", "a.location IN")
       .replace("source IN", "a.source IN").replace("lower(type)", "lower(a.type)")}""", ANALYTICS)
ORACLE["stage_inputs"] = with_clean("""
SELECT "case", stage, source, count(*) AS n, min(rating) AS least
FROM clean JOIN (VALUES ('first', 'analytics', 0.0, 9.0), ('first', 'recommender', 0.0, 9.0),
                        ('second', 'analytics', 4.0, 9.0), ('second', 'recommender', 0.0, 2.0)) v("case", stage, low, below)
  ON rating >= low AND rating < below
GROUP BY ALL""")
ORACLE["import_report"] = """
SELECT 'booking' AS source, 'read' AS state, count(*) AS n_rows,
       count(*) FILTER (p_partkey % 89 = 0 OR p_partkey % 97 = 0) AS n_malformed,
       count(*) FILTER (p_partkey % 13 = 0) AS n_without_name,
       count(*) FILTER (p_partkey % 7 = 0) AS n_without_price FROM part
UNION ALL SELECT 'gone', 'missing', 0, 0, 0, 0
UNION ALL SELECT 'wrong', 'read', count(*), 0, count(*), count(*) FILTER (p_partkey % 5 = 0) FROM part"""
ORACLE["filter_domain"] = with_clean(f"""
SELECT 'price' AS dimension, CAST(NULL AS VARCHAR) AS value, coalesce(pmin, 0.0) AS lo,
       CASE WHEN pmin IS NULL THEN 1.0 WHEN pmin >= pmax THEN pmin + 1.0 ELSE pmax END AS hi FROM s
UNION ALL
SELECT 'rating', NULL, CASE WHEN rmin IS NULL THEN 0.0 ELSE greatest(0.0, rmin) END,
       CASE WHEN rmin IS NULL THEN 5.0 ELSE least(5.0, least(5.0, greatest(rmax, rmin + 0.1))) END FROM s
UNION ALL SELECT DISTINCT 'location', location, NULL, NULL FROM a WHERE location IS NOT NULL
UNION ALL SELECT DISTINCT 'source', source, NULL, NULL FROM a WHERE source IS NOT NULL
UNION ALL SELECT DISTINCT 'type', {strip('type')}, NULL, NULL FROM a WHERE type IS NOT NULL""",
    ANALYTICS + ",\ns AS (SELECT min(price) AS pmin, max(price) AS pmax, min(rating) AS rmin, "
                "max(rating) AS rmax FROM a)")

# ---- aggregates and top-k ------------------------------------------------------

ORACLE["popular_destinations"] = with_clean(f"""
SELECT location, count(name) AS listings, {rnd('avg(price)')} AS avg_price, {rnd('avg(rating)')} AS avg_rating
FROM clean WHERE location IS NOT NULL GROUP BY location""")
ORACLE["type_summary"] = with_clean(f"""
SELECT type, {rnd('avg(price)')} AS avg_price, {rnd('quantile_cont(price, 0.5)')} AS median_price,
       {rnd('avg(cpd)')} AS avg_cost_per_day, count(name) AS "count"
FROM (SELECT *, {cost_raw()} AS cpd FROM clean WHERE type IS NOT NULL) GROUP BY type""")
ORACLE["price_rating_stats"] = with_clean(f"""
SELECT {rnd('CASE WHEN count(*) > 2 AND stddev_samp(price) > 0 AND stddev_samp(rating) > 0 THEN corr(price, rating) END')}
         AS pearson_correlation_price_rating,
       count(*) AS n_points, {rnd('avg(price)')} AS mean_price, {rnd('avg(rating)')} AS mean_rating
FROM clean WHERE price IS NOT NULL AND rating IS NOT NULL""")
ORACLE["top_price_locations"] = with_clean(f"""
SELECT location, {rnd('avg(price)')} AS price FROM clean WHERE price IS NOT NULL AND location IS NOT NULL
GROUP BY location ORDER BY avg(price) DESC, location ASC LIMIT 15""")
ORACLE["kpis"] = with_clean(f"""
SELECT count(*) AS rows_filtered, {rnd('avg(price)')} AS avg_price,
       {rnd('quantile_cont(price, 0.5)')} AS median_price, {rnd('avg(rating)')} AS avg_rating,
       (SELECT count(DISTINCT source) FROM a) AS n_sources, (SELECT count(DISTINCT location) FROM a) AS n_locations,
       (SELECT count(*) FROM a) AS rows_loaded
FROM a WHERE {_explorer_where()}""", ANALYTICS)
ORACLE["source_share"] = with_clean(f"""
SELECT source, count(*) AS "count", {rnd('count(*) / (SELECT count(*) FROM a)')} AS share FROM a GROUP BY source""",
    ANALYTICS)
ORACLE["top_locations"] = with_clean("""
SELECT location, count(*) AS listings FROM a GROUP BY location ORDER BY listings DESC, location LIMIT 12""",
    ANALYTICS)
ORACLE["top_locations_dashboard"] = with_clean("""
SELECT location, count(name) AS listings FROM clean WHERE location IS NOT NULL GROUP BY location
ORDER BY listings DESC, location LIMIT 18""")
ORACLE["price_p75"] = with_clean(f"SELECT {rnd('quantile_cont(price, 0.75)')} AS price_p75 FROM clean")
ORACLE["best_rated"] = with_clean("""
SELECT name, location, rating, price, source, listing_key FROM clean
ORDER BY rating DESC NULLS LAST, price ASC NULLS LAST, listing_key LIMIT 25""")
ORACLE["preview"] = with_clean("SELECT * FROM clean ORDER BY listing_key LIMIT 1000")


# ---- sampling and caps ---------------------------------------------------------

from wayfarer.plans.sqlparts import hash_u, listing_key  # noqa: E402,F401
from wayfarer.operators.chartdata import LOG_EDGES  # noqa: E402

LIST_COLS = "name, type, location, price, duration, rating, source, review_text, listing_key"
DRAWS = (f"d AS (SELECT *, coalesce(source, 'nan') AS _src, {hash_u('listing_key', 42)} AS _u, "
         f"{hash_u('listing_key', 99)} AS _u2 FROM clean),\n"
         "cnt AS (SELECT _src, count(*) AS n_s FROM d GROUP BY _src)")


def _balanced(cap: int) -> str:
    return with_clean(f"""
SELECT {LIST_COLS} FROM chosen
UNION ALL
SELECT {LIST_COLS} FROM (SELECT *, row_number() OVER (ORDER BY _u2, listing_key) AS rn2 FROM ranked WHERE rn > quota), need
WHERE rn2 <= need.need""", DRAWS + f""",
qt AS (SELECT _src, n_s, row_number() OVER (ORDER BY _src) - 1 AS i, count(*) OVER () AS k FROM cnt),
quota AS (SELECT _src, CAST(floor({cap} / k) AS BIGINT) + CASE WHEN i < {cap} % k THEN 1 ELSE 0 END AS quota FROM qt),
ranked AS (SELECT d.*, q.quota, row_number() OVER (PARTITION BY d._src ORDER BY _u, listing_key) AS rn
           FROM d JOIN quota q USING (_src)),
chosen AS (SELECT * FROM ranked WHERE rn <= quota),
need AS (SELECT {cap} - count(*) AS need FROM chosen)""")


ORACLE["balanced_cap"] = _balanced(Q.CAP)
ORACLE["cap_policy"] = _balanced(30_000)
ORACLE["proportional_cap"] = with_clean(f"""
SELECT {LIST_COLS} FROM (
  SELECT d.*, q.quota, row_number() OVER (PARTITION BY d._src ORDER BY _u, listing_key) AS rn
  FROM d JOIN quota q USING (_src)) WHERE rn <= quota""", DRAWS + f""",
cont AS (SELECT _src, n_s, n_s / (SELECT sum(n_s) FROM cnt) * {float(Q.CAP)} AS c FROM cnt),
fl AS (SELECT *, floor(c) AS f FROM cont),
quota AS (SELECT _src, CAST(f + CASE WHEN row_number() OVER (ORDER BY c - f DESC, _src ASC)
                                  <= {Q.CAP} - (SELECT sum(f) FROM fl) THEN 1 ELSE 0 END AS BIGINT) AS quota FROM fl)""")
ORACLE["uniform_cap"] = with_clean(f"""
SELECT {LIST_COLS} FROM d QUALIFY row_number() OVER (ORDER BY _u, listing_key) <= {Q.CAP}""", DRAWS)
ORACLE["scatter_sample"] = with_clean(f"""
SELECT price, rating, name, location, type, source, listing_key FROM d
WHERE price IS NOT NULL AND rating IS NOT NULL
QUALIFY row_number() OVER (ORDER BY _u, listing_key) <= {Q.SCATTER_POINTS}""", DRAWS)

PREP = """med AS (SELECT coalesce(quantile_cont(rating, 0.5), 0.0) AS m FROM clean),
prep0 AS (SELECT clean.* EXCLUDE (rating, duration),
                 CASE WHEN duration IS NULL OR duration = 0 THEN 1.0 ELSE duration END AS duration,
                 coalesce(rating, med.m) AS rating FROM clean, med),
prep AS (SELECT * FROM (SELECT *, (CASE WHEN isnan(price / duration) OR abs(price / duration) = CAST('inf' AS DOUBLE)
                                      THEN NULL ELSE price / duration END) AS cost_per_day FROM prep0)
         WHERE price IS NOT NULL AND cost_per_day IS NOT NULL)"""
ORACLE["impute_median"] = with_clean(
    f"SELECT listing_key, rating, duration, {rnd('cost_per_day')} AS cost_per_day FROM prep", PREP)

# ---- chart data ----------------------------------------------------------------


def _bins_rule(lo: int, hi: int, root: float, n: str = "n") -> str:
    return f"CAST(least({hi}, greatest({lo}, floor(pow(CAST({n} AS DOUBLE), {root})))) AS INTEGER)"


def _hist(values_cte: str, rule: str) -> tuple[str, str]:
    """(CTEs, final SELECT) of an equal-width histogram over v(x); ``rule``
    is an SQL expression over n giving the bin count."""
    edge = "(CASE WHEN {k} = nb THEN hi ELSE {k} * ((hi - lo) / nb) + lo END)"
    e0, e1 = edge.format(k="i0"), edge.format(k="(i0 + 1)")
    eb, eb1 = edge.format(k="bin"), edge.format(k="(bin + 1)")
    ctes = f"""{values_cte},
st AS (SELECT min(x) AS mn, max(x) AS mx, count(*) AS n FROM v),
p AS (SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi,
             {rule} AS nb, n FROM st),
b0 AS (SELECT x, p.*, CASE WHEN floor((x - lo) * (nb / (hi - lo))) >= nb THEN nb - 1
                          ELSE floor((x - lo) * (nb / (hi - lo))) END AS i0 FROM v, p),
b AS (SELECT CASE WHEN x < {e0} THEN i0 - 1 WHEN x >= {e1} AND i0 <> nb - 1 THEN i0 + 1 ELSE i0 END AS bin
      FROM b0),
c AS (SELECT CAST(bin AS INTEGER) AS bin, count(*) AS cnt FROM b GROUP BY 1),
allb AS (SELECT CAST(unnest(range(0, nb)) AS INTEGER) AS bin, lo, hi, nb FROM p WHERE n > 0)"""
    body = f"""SELECT allb.bin, {rnd(eb)} AS bin_lo, {rnd(eb1)} AS bin_hi, coalesce(cnt, 0) AS "count"
FROM allb LEFT JOIN c USING (bin)"""
    return ctes, body


def _vals(expr: str, src: str) -> str:
    return f"v AS (SELECT CAST({expr} AS DOUBLE) AS x FROM {src} WHERE {expr} IS NOT NULL AND NOT isnan({expr}))"


def _clean_hist(values_cte: str, rule: str, pre: str = "") -> str:
    ctes, body = _hist(values_cte, rule)
    return with_clean(body, (pre + ",\n" if pre else "") + ctes)


ORACLE["rating_histogram"] = _clean_hist(_vals("rating", "clean"), _bins_rule(10, 35, 0.25))
ORACLE["rating_histogram_dashboard"] = _clean_hist(
    _vals("rating", "clean"), _bins_rule(15, 40, 0.25, "(SELECT count(*) FROM clean)"))
ORACLE["cost_per_day_histogram"] = _clean_hist(_vals("cost_per_day", "a"), _bins_rule(20, 50, 0.5), ANALYTICS)
ORACLE["price_histogram"] = _clean_hist(
    _vals("price", f"(SELECT * FROM a WHERE {_explorer_where()})"), _bins_rule(15, 45, 0.5), ANALYTICS)

ORACLE["price_histogram_static"] = _clean_hist(_vals("price", "clean"), _bins_rule(15, 50, 0.5))

_NB = LOG_EDGES - 1
_LOG_EDGE = "pow(10.0, CASE WHEN {k} = " + str(_NB) + " THEN lb ELSE {k} * ((lb - la) / " + str(_NB) + ") + la END)"
ORACLE["price_histogram_log"] = with_clean(f"""
SELECT allb.bin, {rnd(_LOG_EDGE.format(k='bin'))} AS bin_lo, {rnd(_LOG_EDGE.format(k='(bin + 1)'))} AS bin_hi,
       coalesce(cnt, 0) AS "count"
FROM allb LEFT JOIN c USING (bin)""", _vals("price", "clean") + f""",
st AS (SELECT min(x) AS mn, max(x) AS mx FROM v),
p AS (SELECT log10(greatest(mn, 1e-6)) AS la, log10(mx) AS lb FROM st),
b0 AS (SELECT x, p.*, least(greatest(floor((log10(x) - la) / ((lb - la) / {_NB})), 0), {_NB - 1}) AS i0
       FROM v, p WHERE x > 0),
b1 AS (SELECT *, CASE WHEN x < {_LOG_EDGE.format(k='i0')} THEN i0 - 1
                      WHEN i0 < {_NB - 1} AND x >= {_LOG_EDGE.format(k='(i0 + 1)')} THEN i0 + 1 ELSE i0 END AS bin
       FROM b0),
c AS (SELECT CAST(bin AS INTEGER) AS bin, count(*) AS cnt FROM b1
      WHERE x >= {_LOG_EDGE.format(k='0')} AND x <= {_LOG_EDGE.format(k=str(_NB))} AND bin >= 0 GROUP BY 1),
allb AS (SELECT CAST(unnest(range(0, {_NB})) AS INTEGER) AS bin, la, lb FROM p WHERE lb IS NOT NULL)""")

ORACLE["rating_box_by_type"] = with_clean(f"""
SELECT s.type, {rnd('q1')} AS q1, {rnd('median')} AS median, {rnd('q3')} AS q3,
       {rnd('min(CASE WHEN rating >= q1 - 1.5 * (q3 - q1) THEN rating END)')} AS whisker_lo,
       {rnd('max(CASE WHEN rating <= q3 + 1.5 * (q3 - q1) THEN rating END)')} AS whisker_hi,
       {rnd('min(rating)')} AS "min", {rnd('max(rating)')} AS "max", count(*) AS n,
       count(CASE WHEN rating < q1 - 1.5 * (q3 - q1) OR rating > q3 + 1.5 * (q3 - q1) THEN 1 END) AS n_outliers
FROM sub s JOIN q USING (type) GROUP BY s.type, q1, median, q3""", """
sub AS (SELECT type, rating FROM clean WHERE rating IS NOT NULL AND NOT isnan(rating) AND type IS NOT NULL),
q AS (SELECT type, quantile_cont(rating, 0.25) AS q1, quantile_cont(rating, 0.5) AS median,
             quantile_cont(rating, 0.75) AS q3 FROM sub GROUP BY type)""")

# ---- tiers ---------------------------------------------------------------------

_QS = Q.CENTER_QS
_CENTERS = ",\n".join(
    f"quantile_cont(price, {qq}) AS px{i}, quantile_cont(cost_per_day, {qq}) AS py{i}" for i, qq in enumerate(_QS))
_D = [f"((price - px{i}) * (price - px{i}) + (cost_per_day - py{i}) * (cost_per_day - py{i}))" for i in range(3)]


def _rank_sql(i: int) -> str:
    parts = []
    for j in range(3):
        if j == i:
            continue
        tie = "TRUE" if j < i else "FALSE"
        parts.append(f"(CASE WHEN px{j} < px{i} OR (px{j} = px{i} AND {tie}) THEN 1 ELSE 0 END)")
    return " + ".join(parts)


_LABEL = ("CASE " + " ".join(
    f"WHEN cluster = {i} THEN (['budget', 'mid-range', 'premium'])[{_rank_sql(i)} + 1]" for i in range(3))
    + " END")
TIERS = f"""m AS (SELECT * FROM (SELECT *, {cost_default()} AS cost_per_day FROM clean)
      WHERE price IS NOT NULL AND cost_per_day IS NOT NULL),
cen AS (SELECT {_CENTERS} FROM m),
asg0 AS (SELECT m.*, cen.*, CASE WHEN {_D[2]} < least({_D[0]}, {_D[1]}) THEN 2 WHEN {_D[1]} < {_D[0]} THEN 1 ELSE 0 END
                AS cluster FROM m, cen),
asg AS (SELECT *, {_LABEL} AS cluster_label FROM asg0)"""
ORACLE["assign_centers"] = with_clean(
    f"SELECT listing_key, price, {rnd('cost_per_day')} AS cost_per_day, CAST(cluster AS INTEGER) AS cluster, "
    "cluster_label FROM asg", TIERS)
_CLUSTER = f"CASE WHEN {_D[2]} < least({_D[0]}, {_D[1]}) THEN 2 WHEN {_D[1]} < {_D[0]} THEN 1 ELSE 0 END AS cluster"
_MEANS = ", ".join(f"coalesce(avg({v}) FILTER (WHERE cluster = {i}), max(p{a}{i})) AS p{a}{i}"
                   for i in range(3) for a, v in (("x", "price"), ("y", "cost_per_day")))
_STEPS = ", ".join(f"a{t} AS (SELECT m.*, c{t}.*, {_CLUSTER} FROM m, c{t}), c{t + 1} AS (SELECT {_MEANS} FROM a{t})"
                   for t in range(3))
ORACLE["kmeans_fixed_start"] = with_clean(
    "SELECT listing_key, price, CAST(cluster AS INTEGER) AS cluster, cluster_label FROM asg",
    f"""m AS (SELECT * FROM (SELECT *, {cost_default()} AS cost_per_day FROM clean)
      WHERE price IS NOT NULL AND cost_per_day IS NOT NULL),
c0 AS (SELECT {_CENTERS} FROM m), {_STEPS},
asg0 AS (SELECT m.*, c3.*, {_CLUSTER} FROM m, c3),
asg AS (SELECT *, {_LABEL} AS cluster_label FROM asg0)""")
ORACLE["kmeans_check"] = with_clean(f"""
SELECT count(*) AS "rows", FALSE AS misplaced, TRUE AS labels_ordered, CAST(3 AS INTEGER) AS clusters
FROM (SELECT *, {cost_default()} AS cost_per_day FROM clean) WHERE price IS NOT NULL AND cost_per_day IS NOT NULL""")
ORACLE["tier_counts"] = with_clean('SELECT cluster_label, count(*) AS "count" FROM asg GROUP BY cluster_label', TIERS)

# ---- recommendations -----------------------------------------------------------

_NUM = ["price", "duration", "rating", "cost_per_day"]


def _feats_sql(src: str, name: str) -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _NUM)
    zs = ", ".join(f"CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE {c} - m_{c} END AS z_{c}" for c in _NUM)
    return f"""{name}_st AS (SELECT {stats} FROM {src}),
{name}_top AS (SELECT coalesce(location, 'nan') AS loc FROM {src} GROUP BY 1 ORDER BY count(*) DESC, loc ASC LIMIT 15),
{name}_z AS (SELECT {src}.*, {zs},
             CASE WHEN coalesce(location, 'nan') IN (SELECT loc FROM {name}_top) THEN coalesce(location, 'nan')
                  ELSE 'Other' END AS location_bucket,
             lower(coalesce(type, 'nan')) AS type_key
             FROM {src}, {name}_st),
{name} AS (SELECT *, sqrt(z_price * z_price + z_duration * z_duration + z_rating * z_rating
                         + z_cost_per_day * z_cost_per_day + 2.0) AS norm FROM {name}_z)"""


FEATS = PREP + ",\n" + _feats_sql("prep", "f")
ZCOLS = ["z_price", "z_duration", "z_rating", "z_cost_per_day"]
ORACLE["features"] = with_clean(
    "SELECT listing_key, " + ", ".join(f"{rnd(z)} AS {z}" for z in ZCOLS)
    + f", location_bucket, type_key, {rnd('norm')} AS norm FROM f", FEATS)


def _sim(q: str, f: str = "f") -> str:
    dot = " + ".join(f"{f}.{z} * {q}.{z}" for z in ZCOLS)
    return (f"(({dot} + CASE WHEN {f}.location_bucket = {q}.location_bucket THEN 1.0 ELSE 0.0 END "
            f"+ CASE WHEN {f}.type_key = {q}.type_key THEN 1.0 ELSE 0.0 END) / ({f}.norm * {q}.norm))")


RESULT = ("f.name, f.type, f.location, f.price, f.duration, f.rating, f.source, f.review_text, "
          f"{rnd('f.cost_per_day')} AS cost_per_day, f.listing_key")
ORDERED = FEATS + f""",
o AS (SELECT *, row_number() OVER (ORDER BY {hash_u('listing_key', 43)}, listing_key) - 1 AS idx,
             count(*) OVER () AS n FROM f)"""
ORACLE["similar_listings"] = with_clean(f"""
SELECT q.name AS query_name, {RESULT}, {rnd(_sim('q'))} AS similarity, q.listing_key AS query_key
FROM f, (SELECT * FROM o WHERE idx = 0) q WHERE f.listing_key <> q.listing_key
ORDER BY {_sim('q')} DESC, f.listing_key LIMIT 5""", ORDERED)
ORACLE["batch_recommend"] = with_clean(f"""
SELECT query_name, name, type, location, price, duration, rating, source, review_text, cost_per_day, listing_key,
       {rnd('sim')} AS similarity, query_key, seed_index FROM (
  SELECT q.name AS query_name, {RESULT}, {_sim('q')} AS sim, q.listing_key AS query_key,
         CAST(q.idx AS INTEGER) AS seed_index,
         row_number() OVER (PARTITION BY q.idx ORDER BY {_sim('q')} DESC, f.listing_key) AS r
  FROM f, (SELECT * FROM o WHERE idx IN (0, n // 2, n - 1)) q WHERE f.listing_key <> q.listing_key)
WHERE r <= 5""", ORDERED)

ORACLE["batch_recommend_many"] = with_clean(f"""
SELECT seed_index, query_key, listing_key, {rnd('sim')} AS similarity FROM (
  SELECT CAST(q.idx AS INTEGER) AS seed_index, q.listing_key AS query_key, f.listing_key, {_sim('q')} AS sim,
         row_number() OVER (PARTITION BY q.idx ORDER BY {_sim('q')} DESC, f.listing_key) AS r
  FROM f, (SELECT o.* FROM o WHERE idx IN (SELECT i * n // 200 FROM range(200) t(i), (SELECT max(n) AS n FROM o))) q
  WHERE f.listing_key <> q.listing_key)
WHERE r <= 3""", ORDERED)

_P = Q.PREFS
_PREF_LOCS = sorted({str(x).strip().lower() for x in _P["preferred_locations"] if str(x).strip()})
WORK = (f"work AS (SELECT * FROM prep WHERE price <= {float(_P['max_price'])} AND rating >= {float(_P['min_rating'])} "
        f"AND lower(coalesce(location, 'nan')) IN {in_list(_PREF_LOCS)})")
_MED = ", ".join(f"quantile_cont({z}, 0.5) AS {z}" for z in ZCOLS)


def _w(col: str) -> str:
    return (f"w_{col} AS (SELECT {col} AS k, CASE WHEN 2 * count(*) > (SELECT count(*) FROM g) THEN 1.0 ELSE 0.5 END AS w "
            f"FROM g GROUP BY {col} HAVING 2 * count(*) >= (SELECT count(*) FROM g))")


PREFS_CTE = PREP + ",\n" + WORK + ",\n" + _feats_sql("work", "g") + f""",
ideal AS (SELECT {_MED} FROM g),
{_w('location_bucket')},
{_w('type_key')},
inorm AS (SELECT sqrt(z_price * z_price + z_duration * z_duration + z_rating * z_rating
                      + z_cost_per_day * z_cost_per_day
                      + coalesce((SELECT sum(w * w) FROM w_location_bucket), 0.0)
                      + coalesce((SELECT sum(w * w) FROM w_type_key), 0.0)) AS v FROM ideal),
scored AS (
  SELECT g.*, CASE WHEN (SELECT count(*) FROM g) <= 1 THEN NULL WHEN inorm.v = 0 THEN 0.0
                   ELSE ({' + '.join(f'g.{z} * ideal.{z}' for z in ZCOLS)}
                         + coalesce((SELECT w FROM w_location_bucket WHERE k = g.location_bucket), 0.0)
                         + coalesce((SELECT w FROM w_type_key WHERE k = g.type_key), 0.0)) / (inorm.v * g.norm)
              END AS sim
  FROM g, ideal, inorm)"""
ORACLE["recommend_preferences"] = with_clean(f"""
SELECT name, type, location, price, duration, rating, source, review_text, {rnd('cost_per_day')} AS cost_per_day,
       listing_key, {rnd('sim')} AS similarity_to_ideal
FROM scored ORDER BY sim DESC NULLS LAST, listing_key LIMIT 8""", PREFS_CTE)
_PT = sorted({t.lower() for t in ["Standard", "offer", "PROMO"]})
ORACLE["preference_filter"] = with_clean(
    f"SELECT listing_key, price, rating, location, type FROM work WHERE lower(coalesce(type, 'nan')) IN {in_list(_PT)}",
    PREP + ",\n" + WORK)

# ---- sentiment -----------------------------------------------------------------

_LEX = ", ".join(f"('{t}', {v})" for t, v in Q.LEXICON)
# the twin's own lists, written out from the published rules
_NEG = """('aint', 'arent', 'cannot', 'cant', 'couldnt', 'darent', 'didnt', 'doesnt', 'dont', 'hadnt', 'hasnt', 'havent', 'isnt',
'mightnt', 'mustnt', 'neither', 'neednt', 'never', 'none', 'nope', 'nor', 'not', 'nothing', 'nowhere', 'oughtnt', 'shant',
'shouldnt', 'uhuh', 'wasnt', 'werent', 'without', 'wont', 'wouldnt', 'rarely', 'seldom', 'despite')"""
_MORE = """('absolutely', 'amazingly', 'awfully', 'completely', 'considerable', 'considerably', 'decidedly', 'deeply', 'enormous',
'enormously', 'entirely', 'especially', 'exceptional', 'exceptionally', 'extreme', 'extremely', 'fabulously', 'fully', 'greatly',
'hella', 'highly', 'hugely', 'incredible', 'incredibly', 'intensely', 'major', 'majorly', 'more', 'most', 'particularly', 'purely',
'quite', 'really', 'remarkably', 'so', 'substantially', 'thoroughly', 'total', 'totally', 'tremendous', 'tremendously', 'uber',
'unbelievably', 'unusually', 'utter', 'utterly', 'very')"""
_LESS = """('almost', 'barely', 'hardly', 'kinda', 'kindof', 'less', 'little', 'marginal', 'marginally', 'occasional', 'occasionally',
'partly', 'scarce', 'scarcely', 'slight', 'slightly', 'somewhat', 'sorta', 'sortof')"""


def _step(d: int, v: str) -> str:
    """The valence after the token at distance d was taken into account."""
    w, far = f"w{d}", (1.0, 0.95, 0.9)[d - 1]
    degree = f"(CASE WHEN {w} IN {_MORE} THEN 0.293 WHEN {w} IN {_LESS} THEN -0.293 END)"
    sign = f"(CASE WHEN {v} > 0 THEN 1.0 ELSE -1.0 END)"
    loud = f"(CASE WHEN mixed AND p{d} = upper(p{d}) AND p{d} <> lower(p{d}) THEN 0.733 ELSE 0.0 END)"
    near = "w1 IN ('so', 'this')" if d == 2 else "(w1 IN ('so', 'this') OR w2 IN ('so', 'this'))"
    doubt = "w1 = 'doubt'" if d == 2 else "(w1 = 'doubt' OR w2 = 'doubt')"
    odd = f"WHEN {w} = 'never' AND {near} THEN 1.25 WHEN {w} = 'without' AND {doubt} THEN 1.0" if d > 1 else ""
    factor = f"(CASE {odd} WHEN {w} IN {_NEG} THEN -0.74 ELSE 1.0 END)"
    return (f"(CASE WHEN {w} <> '' AND {w} NOT IN (SELECT token FROM lex) "
            f"THEN ({v} + coalesce({sign} * ({degree} + {loud}) * {far}, 0.0)) * {factor} ELSE {v} END)")


def _plain(word: str) -> str:
    return f"lower(translate({word}, '''’', ''))"


SENT = f"""docs AS (SELECT doc_id, text, lang FROM documents),
lex AS (SELECT token, CAST(valence AS DOUBLE) AS valence FROM (VALUES {_LEX}) l(token, valence)),
tok AS (SELECT doc_id, regexp_extract_all(text, '\\p{{L}}+(?:[''’]\\p{{L}}+)*') AS t,
               CAST(least(4, length(text) - length(replace(text, '!', ''))) AS DOUBLE) * 0.292
               + CASE WHEN length(text) - length(replace(text, '?', '')) > 3 THEN 0.96
                      WHEN length(text) - length(replace(text, '?', '')) > 1
                      THEN CAST(length(text) - length(replace(text, '?', '')) AS DOUBLE) * 0.18 ELSE 0.0 END AS e FROM docs
        WHERE NOT (text IS NULL OR trim(text) = '' OR lower(trim(text)) = 'nan')),
ex AS (SELECT doc_id, e, len(t) AS size, unnest(t) AS word, generate_subscripts(t, 1) AS pos FROM tok),
ctx AS (SELECT *, {_plain('word')} AS token,
               coalesce(lag(word, 1) OVER w, '') AS p1, coalesce(lag(word, 2) OVER w, '') AS p2,
               coalesce(lag(word, 3) OVER w, '') AS p3, coalesce(lead(word, 1) OVER w, '') AS n1,
               count(CASE WHEN word = upper(word) AND word <> lower(word) THEN 1 END) OVER d BETWEEN 1 AND size - 1 AS mixed,
               min(CASE WHEN lower(word) = 'but' THEN pos END) OVER d AS but
        FROM ex WINDOW w AS (PARTITION BY doc_id ORDER BY pos), d AS (PARTITION BY doc_id)),
l0 AS (SELECT ctx.*, {_plain('p1')} AS w1, {_plain('p2')} AS w2, {_plain('p3')} AS w3,
              CASE WHEN mixed AND word = upper(word) AND word <> lower(word)
                   THEN valence + CASE WHEN valence > 0 THEN 0.733 ELSE -0.733 END ELSE valence END AS v0
       FROM ctx JOIN lex USING (token)),
l1 AS (SELECT *, {_step(1, 'v0')} AS v1 FROM l0),
l2 AS (SELECT *, {_step(2, 'v1')} AS v2 FROM l1),
l3 AS (SELECT *, {_step(3, 'v2')} AS v3 FROM l2),
l4 AS (SELECT doc_id, CASE WHEN token = 'kind' AND lower(n1) = 'of' THEN 0.0
                           WHEN w1 = 'least' AND w2 NOT IN ('at', 'very') AND w1 NOT IN (SELECT token FROM lex) THEN v3 * -0.74
                           ELSE v3 END * CASE WHEN pos < but THEN 0.5 WHEN pos > but THEN 1.5 ELSE 1.0 END AS v FROM l3),
sums AS (SELECT doc_id, sum(v) AS s, sum(CASE WHEN v > 0 THEN v + 1.0 ELSE 0.0 END) AS p,
                sum(CASE WHEN v < 0 THEN v - 1.0 ELSE 0.0 END) AS n, count(CASE WHEN v <> 0 THEN 1 END) AS hits
         FROM l4 GROUP BY doc_id),
agg AS (SELECT tok.doc_id, len(t) - coalesce(hits, 0) AS nu,
               CASE WHEN s > 0 THEN s + e WHEN s < 0 THEN s - e ELSE coalesce(s, 0.0) END AS s,
               CASE WHEN p > abs(n) THEN p + e ELSE coalesce(p, 0.0) END AS ps,
               CASE WHEN p < abs(n) THEN n - e ELSE coalesce(n, 0.0) END AS ns
        FROM tok LEFT JOIN sums USING (doc_id) WHERE len(t) > 0),
sc AS (SELECT d.doc_id, d.lang,
              coalesce(s / sqrt(s * s + 15.0), 0.0) AS c,
              coalesce(abs(ps / (ps + abs(ns) + nu)), 0.0) AS p,
              coalesce(abs(ns / (ps + abs(ns) + nu)), 0.0) AS ng_,
              coalesce(abs(nu / (ps + abs(ns) + nu)), 1.0) AS u
       FROM docs d LEFT JOIN agg a USING (doc_id))"""
ORACLE["sentiment"] = (f"WITH {SENT}\nSELECT doc_id, {rnd('c')} AS sentiment_compound, {rnd('p')} AS sentiment_pos, "
                       f"{rnd('ng_')} AS sentiment_neg, {rnd('u')} AS sentiment_neu FROM sc")


def _with_phrases() -> str:
    """The scores with phrases and the emoticon "|": matches by n-gram, the longer of overlapping ones, units by their ends."""
    def step(d: int, v: str) -> str:
        w, far = f"w{d}", (1.0, 0.95, 0.9)[d - 1]
        sign = f"(CASE WHEN {v} > 0 THEN 1.0 ELSE -1.0 END)"
        loud = f"(CASE WHEN mixed AND p{d} = upper(p{d}) AND p{d} <> lower(p{d}) THEN 0.733 ELSE 0.0 END)"
        near = "w1 IN ('so', 'this')" if d == 2 else "(w1 IN ('so', 'this') OR w2 IN ('so', 'this'))"
        doubt = "w1 = 'doubt'" if d == 2 else "(w1 = 'doubt' OR w2 = 'doubt')"
        odd = f"WHEN {w} = 'never' AND {near} THEN 1.25 WHEN {w} = 'without' AND {doubt} THEN 1.0" if d > 1 else ""
        factor = f"(CASE {odd} WHEN {w} IN {_NEG} THEN -0.74 ELSE 1.0 END)"
        return f"(CASE WHEN u{d} AND k{d} IS NULL THEN ({v} + coalesce({sign} * (g{d} + {loud}) * {far}, 0.0)) * {factor} ELSE {v} END)"

    words = ", ".join(f"('{t}', {v})" for t, v in Q.LEXICON + [x for x in Q.PHRASES if " " not in x[0]])
    grams = ", ".join([f"('{t}', {t.count(' ') + 1}, {v}, NULL)" for t, v in Q.PHRASES if " " in t]
                      + [f"('{t}', 2, NULL, -0.293)" for t in ("kind of", "sort of", "just enough")])
    before = "\n".join(f"LEFT JOIN unit b{d} ON b{d}.doc_id = u.doc_id AND b{d}.endp = u.pos - {d}" for d in (1, 2, 3))
    cols = ", ".join(f"b{d}.doc_id IS NOT NULL AS u{d}, coalesce(b{d}.plain, '') AS w{d}, coalesce(b{d}.word, '') AS p{d}, b{d}.deg AS g{d}, "
                     f"b{d}.val AS k{d}" for d in (1, 2, 3))
    head, tail = SENT[:SENT.index("\nex AS (") + 1], SENT[SENT.index("sums AS ("):]
    # blanks doubled, so that neighbouring emoticons have one each
    head = head.replace("regexp_extract_all(text, '", "regexp_extract_all(' ' || regexp_replace(text, '([ \\t\\n\\r\\f\\x0B])', '\\1\\1', 'g') || ' ', "
                        "'[ \\t\\n\\r\\f\\x0B]\\|[ \\t\\n\\r\\f\\x0B]|")
    head = head[:head.index("lex AS (")] + f"lex AS (SELECT token, CAST(valence AS DOUBLE) AS valence FROM (VALUES {words}) l(token, valence)),\n" \
        + head[head.index("tok AS ("):]
    return head + f"""ex AS (SELECT doc_id, e, len(t) AS size, trim(unnest(t), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS word,
              generate_subscripts(t, 1) AS pos FROM tok),
ph AS (SELECT gram, m, CAST(v AS DOUBLE) AS v, CAST(g AS DOUBLE) AS g FROM (VALUES {grams}) x(gram, m, v, g)),
ctx AS (SELECT *, CASE WHEN word = '|' THEN word ELSE {_plain('word')} END AS token,
               count(CASE WHEN word = upper(word) AND word <> lower(word) THEN 1 END) OVER d BETWEEN 1 AND size - 1 AS mixed,
               min(CASE WHEN lower(word) = 'but' THEN pos END) OVER d AS but FROM ex WINDOW d AS (PARTITION BY doc_id)),
lead2 AS (SELECT *, lead(token, 1) OVER w AS t1, lead(token, 2) OVER w AS t2 FROM ctx WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
cand AS (SELECT doc_id, pos, m, v, g FROM lead2 JOIN ph ON m = 2 AND gram = token || ' ' || t1
         UNION ALL SELECT doc_id, pos, m, v, g FROM lead2 JOIN ph ON m = 3 AND gram = token || ' ' || t1 || ' ' || t2),
beaten AS (SELECT DISTINCT c.doc_id, c.pos, c.m FROM cand c JOIN cand o ON o.doc_id = c.doc_id AND o.pos < c.pos + c.m AND c.pos < o.pos + o.m
           AND (o.m > c.m OR (o.m = c.m AND o.pos < c.pos))),
kept AS (SELECT * FROM cand ANTI JOIN beaten USING (doc_id, pos, m)),
gone AS (SELECT doc_id, unnest(range(pos + 1, pos + m)) AS pos FROM kept),
unit AS (SELECT c.doc_id, c.pos, c.mixed, c.but, c.word, coalesce(k.m, 1) + c.pos - 1 AS endp, CASE WHEN k.m IS NULL THEN token ELSE '' END AS plain,
                CASE WHEN k.m IS NULL THEN lex.valence ELSE k.v END AS val,
                CASE WHEN k.m IS NOT NULL THEN k.g WHEN token IN {_MORE} THEN 0.293 WHEN token IN {_LESS} THEN -0.293 END AS deg
         FROM ctx c ANTI JOIN gone USING (doc_id, pos) LEFT JOIN kept k ON k.doc_id = c.doc_id AND k.pos = c.pos LEFT JOIN lex USING (token)),
l0 AS (SELECT u.doc_id, u.pos, u.mixed, u.but, {cols},
              u.val + CASE WHEN u.mixed AND u.word = upper(u.word) AND u.word <> lower(u.word) THEN CASE WHEN u.val > 0 THEN 0.733 ELSE -0.733 END ELSE 0.0 END AS v0
       FROM unit u
{before}
       WHERE u.val IS NOT NULL),
l1 AS (SELECT *, {step(1, 'v0')} AS v1 FROM l0),
l2 AS (SELECT *, {step(2, 'v1')} AS v2 FROM l1),
l3 AS (SELECT *, {step(3, 'v2')} AS v3 FROM l2),
l4 AS (SELECT doc_id, CASE WHEN w1 = 'least' AND k1 IS NULL AND w2 NOT IN ('at', 'very') THEN v3 * -0.74 ELSE v3 END
                      * CASE WHEN pos < but THEN 0.5 WHEN pos > but THEN 1.5 ELSE 1.0 END AS v FROM l3),
""" + tail


ORACLE["sentiment_phrases"] = (f"WITH {_with_phrases()}\nSELECT doc_id, {rnd('c')} AS sentiment_compound, {rnd('p')} AS sentiment_pos, "
                               f"{rnd('ng_')} AS sentiment_neg, {rnd('u')} AS sentiment_neu FROM sc")
SENT4 = SENT + """,
sc4 AS (SELECT doc_id, lang, coalesce(round_even(c, 4), 0.0) AS c, round_even(p, 3) AS p, round_even(ng_, 3) AS ng_,
               round_even(u, 3) AS u FROM sc)"""
ORACLE["sentiment_by_language"] = (
    f"WITH {SENT4}\nSELECT lang AS location, count(*) AS reviews, {rnd('avg(c)')} AS avg_sentiment_compound, "
    f"{rnd('avg(p)')} AS avg_sentiment_pos, {rnd('avg(ng_)')} AS avg_sentiment_neg, {rnd('avg(u)')} AS avg_sentiment_neu "
    "FROM sc4 WHERE lang IS NOT NULL GROUP BY lang")
_sc, _sb = _hist("v AS (SELECT c AS x FROM sc4 WHERE c IS NOT NULL AND NOT isnan(c))", "32")
ORACLE["sentiment_histogram"] = f"WITH {SENT4},\n{_sc}\n{_sb}"
_sc, _sb = _hist("v AS (SELECT c AS x FROM sc4 WHERE c IS NOT NULL AND NOT isnan(c))", "30")
ORACLE["sentiment_histogram_dashboard"] = f"WITH {SENT4},\n{_sc}\n{_sb}"
ORACLE["sentiment_passthrough"] = ("SELECT doc_id, 'doc ' || doc_id AS name, lang AS location, source, text AS review_text "
                                   "FROM documents")
_E = Q.EXPLORER
ORACLE["explorer_filter_missing"] = NORM + f"""SELECT * FROM norm
WHERE (price BETWEEN {_E['price_range'][0]} AND {_E['price_range'][1]} OR price IS NULL)
  AND (rating BETWEEN {_E['rating_range'][0]} AND {_E['rating_range'][1]} OR rating IS NULL)
  AND coalesce(source, 'nan') IN {in_list(_E['sources'])}"""
