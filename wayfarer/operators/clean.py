"""The clean stage: normalise -> coerce -> dedup -> filter -> defaults -> impute.

Order matters and follows the listing pipeline: duplicates are removed on the
(name, location, price, source) key *before* invalid rows are filtered, and
missing ratings are drawn from the ratings observed *after* both.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfarer.functions.keys import U_RANGE, hash_u, listing_key
from wayfarer.functions.numeric import to_double
from wayfarer.functions.text import null_if_na_token, strip
from wayfarer.operators.mapping import complete_columns, normalize_headers
from wayfarer.operators.ranking import ranked_values
from wayfarer.session import materialize, small_table, store
from wayfarer.schema import DEFAULT_TYPE, KEY_COLUMN, LISTING_COLUMNS, NUMERIC_COLUMNS, STRING_COLUMNS

DEDUP_KEY = ["name", "location", "price", "source"]
IMPUTE_SEED = 42
IDLE_BUCKETS = 65_536        # join buckets for rows that need no draw


def normalize_strings(df: DataFrame) -> DataFrame:
    """Strip name/location/source/review_text, lower+strip type, blank review -> NULL."""
    return df.withColumns({
        "name": strip("name"),
        "location": strip("location"),
        "type": strip(F.lower(F.col("type").cast("string"))),
        "source": strip("source"),
        "review_text": F.nullif(strip("review_text"), F.lit("")),
    })


def coerce_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Numeric columns -> double; unparseable text and NaN -> NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: to_double(c, types[c]) for c in columns})


def dedup_first(df: DataFrame, key: Sequence[str] = DEDUP_KEY,
                order: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the first by ``order`` (ascending, NULLs last).

    Implemented as ``min(struct(...))`` per key, an aggregate with map-side
    partial combination, so a key held by a large share of the rows collapses
    before the shuffle instead of landing whole in one window task.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    order = [c for c in (order or rest)]
    tail = [c for c in rest if c not in order]
    fields = []
    for i, c in enumerate(order + tail):
        fields += [F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_v{i}")]
    picked = df.groupBy(*key).agg(F.min(F.struct(*fields)).alias("_first"))
    out = picked.select(*key, *[F.col(f"_first._v{i}").alias(c) for i, c in enumerate(order + tail)])
    return out.select(*df.columns)


def valid_rows(df: DataFrame) -> DataFrame:
    """Name present, non-blank and not the text 'nan' (any case); price present."""
    name = F.col("name")
    return df.where(name.isNotNull() & (name != "") & (F.lower(name) != "nan") & F.col("price").isNotNull())


def apply_defaults(df: DataFrame) -> DataFrame:
    """Duration NULL or 0 -> 1 day (negative kept); type blank/NULL -> 'offer'."""
    dur = F.col("duration")
    return df.withColumns({
        "duration": F.when(dur.isNull() | (dur == 0), F.lit(1.0)).otherwise(dur),
        "type": F.coalesce(F.nullif(F.col("type"), F.lit("")), F.lit(DEFAULT_TYPE)),
    })


def impute_rating(df: DataFrame, key: str = KEY_COLUMN, seed: int = IMPUTE_SEED,
                  column: str = "rating", with_flag: bool = False):
    """Fill missing ratings by drawing, with replacement, from the observed ones.

    Draw for a row: ordinal d = hash_u(key, seed) mod n_obs into the sorted
    observed ratings, i.e. every observed rating is equally likely. The sorted
    list is never materialised: each distinct rating gets its ordinal interval
    [lo, hi) from ``ranked_values``, and an equi-join on an ordinal bucket plus
    a range filter finds the interval holding d. With no observed rating the
    draw is uniform on [3, 5).

    Every row goes through one left join (observed rows carry negative buckets,
    spread by key, that match nothing and crowd no task), so the result is a
    single projection over ``df``. With ``with_flag`` also returns whether the
    interval table was broadcast.
    """
    c = F.col(column)
    observed = df.where(c.isNotNull())
    rv = store(ranked_values(observed, column), "rating_ranks")
    ranked = rv.select(F.col(column).alias("_draw"), F.col("below").alias("_lo"),
                       (F.col("below") + F.col("cnt")).alias("_hi"))
    tot = rv.agg(F.sum("cnt").alias("n_obs"), F.count(F.lit(1)).alias("n_vals")).first()
    n_obs, n_vals = int(tot["n_obs"] or 0), int(tot["n_vals"] or 0)
    width = max(-(-n_obs // max(n_vals, 1)), 1)   # ordinal bucket width: ~one interval per bucket
    intervals = ranked.select("_draw", "_lo", "_hi", F.explode(F.sequence(
        F.floor(F.col("_lo") / F.lit(width)), F.floor((F.col("_hi") - 1) / F.lit(width)))).alias("_ob"))
    # about one row per distinct rating: broadcast after the size check, else a
    # shuffle join on the bucket
    broadcastable = small_table(intervals, 1_000_000)
    intervals = broadcastable if broadcastable is not None else intervals
    u = hash_u(key, seed)
    draw_d = F.when(c.isNull(), F.pmod(u, F.lit(n_obs))) if n_obs > 0 else F.lit(None).cast("bigint")
    idle = -1 - F.pmod(F.hash(F.col(key)), F.lit(IDLE_BUCKETS)).cast("bigint")
    d = df.withColumn("_d", draw_d).withColumn("_ob", F.coalesce(F.floor(F.col("_d") / F.lit(width)), idle))
    joined = (d.join(intervals, "_ob", "left")
              .where(F.col("_lo").isNull() | ((F.col("_d") >= F.col("_lo")) & (F.col("_d") < F.col("_hi")))))
    fallback = F.when(c.isNull(), F.lit(3.0) + F.lit(2.0) * (u / F.lit(U_RANGE)))
    out = joined.withColumn(column, F.coalesce(c, F.col("_draw"), fallback)).select(*df.columns)
    return (out, broadcastable is not None) if with_flag else out


def null_na_text(df: DataFrame, columns: Sequence[str] = STRING_COLUMNS) -> DataFrame:
    """Blank / NA-token text -> NULL, as the next stage's CSV read would see it."""
    return df.withColumns({c: null_if_na_token(F.col(c)) for c in columns if c in df.columns})


def clean_listings(df: DataFrame, impute: bool = True, materialize_stage: bool = True) -> DataFrame:
    """The full clean stage; adds ``listing_key`` (md5 of the dedup key).

    The deduplicated, filtered table is written once (shared checkpoint
    folder); the imputation and the NA-text rule are then a projection plus a
    broadcast join over it, so consumers read that single table with column
    pruning and filter pushdown. Only when the rating interval table is too
    large to broadcast is the imputed result written as well.
    """
    work = normalize_headers(df)
    work = complete_columns(work).select(*LISTING_COLUMNS)
    work = normalize_strings(work)
    work = coerce_numeric(work)
    work = dedup_first(work, DEDUP_KEY, ["type", "duration", "rating", "review_text"])
    work = valid_rows(work)
    work = work.withColumn(KEY_COLUMN, listing_key())
    work = apply_defaults(work)
    if materialize_stage:
        # read several times (rating histogram, the fill) and by every
        # downstream operator: written once
        work = materialize(work, "clean_base")
    lazy_ok = True
    if impute:
        work, lazy_ok = impute_rating(work, with_flag=True)
    work = null_na_text(work).select(*LISTING_COLUMNS, KEY_COLUMN)
    if materialize_stage and not lazy_ok:
        # the fill needed a shuffle join: write the result once as well
        work = materialize(work, "clean")
    return work
