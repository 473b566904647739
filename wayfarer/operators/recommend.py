"""Content-based recommendations by cosine similarity, without feature vectors.

Feature space per listing: z-scores (population std; a constant column gives
z = x - mean) of price, duration, rating and cost_per_day, one-hot location
bucket (the 15 most frequent locations, the rest 'Other', missing = 'nan')
and one-hot lower-cased type. Each listing has exactly one hot entry per
block, so for listings i, j

    dot(i, j) = sum_k z_ik z_jk + [bucket_i = bucket_j] + [type_i = type_j]
    |x_i|     = sqrt(sum_k z_ik^2 + 2)

and similarity is a plain column expression. As with a fitted ML model, the
bounded statistics - one row of means / deviations, at most 15 top
locations, the query or ideal point, at most two categories with a non-zero
median weight - are computed first and enter the plan as literals; scoring
is then a projection plus a top-k (TakeOrderedAndProject): no join with the
listing table, no pairs.
"""

from __future__ import annotations

import json
import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.functions.keys import U_BITS, hash_u
from wayfarer.functions.numeric import to_double
from wayfarer.operators.analytics import cost_per_day, defaulted_duration
from wayfarer.operators.filters import preference_filter
from wayfarer.operators.ranking import HASH_BIN_BITS, exact_quantiles, row_at_hash_rank
from wayfarer.schema import KEY_COLUMN
from wayfarer.session import materialize, small_table

NUMERIC = ["price", "duration", "rating", "cost_per_day"]
Z = [f"z_{c}" for c in NUMERIC]
TOP_LOCATIONS = 15
UNIT, HOT = [f"_u_{c}" for c in NUMERIC], "_u_hot"
FEW_SEEDS = 32            # seeds of a batch that are held against every row
BLOCK_CELLS = 4           # cells of a unit vector's part between 0 and 1
ASKED_ROWS = 500_000      # (block, seed) rows that are broadcast
BOUND_SHARE = 64          # of so many rows one is ranked for a bound of a seed's result
ROUNDING = 1e-9           # of a squared distance of unit vectors
ORDER_SEED = 43   # row order of the capped table (a seeded shuffle) = hash order


def prepare_numeric(df: DataFrame) -> DataFrame:
    """Numeric coercion; duration NULL/0 -> 1; missing rating -> median rating
    of all rows (0 if none); cost_per_day; rows lacking price or cost dropped."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df.withColumns({
        "price": to_double("price", types.get("price")),
        "duration": defaulted_duration(to_double("duration", types.get("duration"))),
        "rating": to_double("rating", types.get("rating")),
    })
    row = exact_quantiles(out, "rating", [0.5], names=["m"]).first()
    med = float(row["m"]) if row is not None and row["m"] is not None else 0.0
    out = out.withColumn("rating", F.coalesce(F.col("rating"), F.lit(med)))
    out = out.withColumn("cost_per_day", cost_per_day())
    # a price and a finite cost; on ``cost_per_day`` itself the filter would be too long a method to be compiled
    return out.where(F.abs(F.try_divide(F.col("price"), F.col("duration"))) < F.lit(float("inf")))


def _loc_text() -> Column:
    return F.coalesce(F.col("location").cast("string"), F.lit("nan"))


def feature_model(prep: DataFrame, top_locations: int = TOP_LOCATIONS) -> dict:
    """Means, population deviations and the most frequent locations (bounded)."""
    row = prep.agg(*[F.avg(c).alias(f"m_{c}") for c in NUMERIC],
                   *[F.stddev_pop(c).alias(f"s_{c}") for c in NUMERIC]).first()
    top = (prep.groupBy(_loc_text().alias("_loc")).agg(F.count(F.lit(1)).alias("_n"))
           .orderBy(F.col("_n").desc(), F.col("_loc").asc()).limit(top_locations).collect())
    return {"mean": {c: row[f"m_{c}"] for c in NUMERIC}, "std": {c: row[f"s_{c}"] for c in NUMERIC},
            "top": [r["_loc"] for r in top]}


def features(prep: DataFrame, top_locations: int = TOP_LOCATIONS, model: dict | None = None) -> DataFrame:
    """Adds z_* columns, location_bucket, type_key and norm (a projection)."""
    model = model or feature_model(prep, top_locations)
    zs = {}
    for c in NUMERIC:
        m, sd = model["mean"][c], model["std"][c]
        if m is None:
            zs[f"z_{c}"] = F.lit(None).cast("double")
        elif sd is not None and sd > 0:
            zs[f"z_{c}"] = (F.col(c) - F.lit(m)) / F.lit(sd)
        else:
            zs[f"z_{c}"] = F.col(c) - F.lit(m)
    loc = _loc_text()
    top = model["top"]
    bucket = F.when(loc.isin(top), loc).otherwise(F.lit("Other")) if top else F.lit("Other")
    out = prep.withColumns(zs).withColumns({
        "location_bucket": bucket,
        "type_key": F.lower(F.coalesce(F.col("type").cast("string"), F.lit("nan"))),
    })
    sq = sum((F.col(z) * F.col(z) for z in Z[1:]), F.col(Z[0]) * F.col(Z[0]))
    return out.withColumn("norm", F.sqrt(sq + F.lit(2.0)))


def _dot(q: dict) -> Column:
    acc = F.col(Z[0]) * F.lit(q[Z[0]])
    for z in Z[1:]:
        acc = acc + F.col(z) * F.lit(q[z])
    return acc


QUERY_COLUMNS = Z + ["location_bucket", "type_key", "norm", KEY_COLUMN, "name"]


def _query_values(one_row) -> dict | None:
    """Query features from a one-row DataFrame (or an already collected Row)."""
    r = one_row.select(*QUERY_COLUMNS).first() if isinstance(one_row, DataFrame) else one_row
    return None if r is None else {c: r[c] for c in QUERY_COLUMNS}


def similarity_to(q: dict) -> Column:
    dot = (_dot(q) + F.when(F.col("location_bucket") == F.lit(q["location_bucket"]), 1.0).otherwise(0.0)
           + F.when(F.col("type_key") == F.lit(q["type_key"]), 1.0).otherwise(0.0))
    return dot / (F.col("norm") * F.lit(q["norm"]))


def _result_columns(feats: DataFrame) -> list[str]:
    keep = ["name", "type", "location", "price", "duration", "rating", "source", "review_text",
            "cost_per_day", KEY_COLUMN]
    return [c for c in keep if c in feats.columns]


def similar_listings(feats: DataFrame, query_row, top_k: int = 5) -> DataFrame:
    """Top-k listings most similar to the query listing (a one-row selection
    of ``feats``, or that row already collected), the query itself excluded."""
    q = _query_values(query_row)
    if q is None:
        raise IndexError("query row not found")
    scored = feats.where(F.col(KEY_COLUMN) != F.lit(q[KEY_COLUMN])).withColumn("similarity", similarity_to(q))
    top = scored.orderBy(F.col("similarity").desc(), F.col(KEY_COLUMN).asc()).limit(top_k)
    return top.select(F.lit(q["name"]).cast("string").alias("query_name"), *_result_columns(feats),
                      "similarity", F.lit(q[KEY_COLUMN]).alias("query_key"))


def with_row_order(feats: DataFrame, seed: int = ORDER_SEED) -> DataFrame:
    return feats.withColumn("_order_u", hash_u(KEY_COLUMN, seed))


def row_at(feats: DataFrame, index) -> DataFrame:
    """The listing at 0-based position ``index`` of the table's row order."""
    return row_at_hash_rank(with_row_order(feats), "_order_u", KEY_COLUMN, index)


def rows_at(feats: DataFrame, positions: Sequence[int]) -> list:
    """(position, query columns) of the rows at 0-based positions of the table's
    row order, for many positions in two passes: hash bins are counted, then
    only the bins that hold a wanted row are ranked inside."""
    fo = with_row_order(feats)
    bin_ = F.shiftright("_order_u", U_BITS - HASH_BIN_BITS)
    sizes = fo.groupBy(bin_.alias("b")).agg(F.count(F.lit(1)).alias("c")).orderBy("b").collect()   # 2**16 rows at most
    wanted, start, left = {}, 0, sorted(set(positions))
    for r in sizes:
        while left and left[0] < start + r["c"]:
            wanted.setdefault(r["b"], []).append((left[0] - start + 1, left[0]))
            left = left[1:]
        start += r["c"]
    if not wanted:
        return []
    rn = F.row_number().over(Window.partitionBy("_b").orderBy("_order_u", KEY_COLUMN))
    inside = fo.withColumn("_b", bin_).where(F.col("_b").isin(list(wanted))).withColumn("_rn", rn)
    pick = F.create_map(*[x for b, ps in wanted.items() for x in (
        F.lit(b), F.create_map(*[y for k, p in ps for y in (F.lit(k), F.lit(p))]))])
    at = inside.withColumn("_at", pick[F.col("_b")][F.col("_rn")]).where("_at is not null")
    return [(r["_at"], {c: r[c] for c in QUERY_COLUMNS}) for r in at.select("_at", *QUERY_COLUMNS).collect()]


def _with_blocks(feats: DataFrame) -> DataFrame:
    """Adds the listing's unit vector (its z parts and the value of its hot entries) and the block it lies in: a cell
    of the unit vector, the location bucket and the type."""
    unit = feats.withColumns({u: F.col(z) / F.col("norm") for u, z in zip(UNIT, Z)} | {HOT: F.lit(1.0) / F.col("norm")})
    cells = [F.floor(F.col(u) * F.lit(BLOCK_CELLS)) for u in UNIT]
    return unit.withColumn("_block", F.xxhash64(*cells, "location_bucket", "type_key"))


def _seed_array(found: list) -> Column:
    """The seeds as one array literal of structs (seed_index, query columns, unit vector)."""
    text = ("location_bucket", "type_key", KEY_COLUMN, "name")
    fields = ["seed_index int", *[f"{c} {'string' if c in text else 'double'}" for c in QUERY_COLUMNS],
              *[f"{u} double" for u in [*UNIT, HOT]]]
    rows = []
    for at, q in found:
        known = q["norm"] is not None
        unit = {u: q[z] / q["norm"] if known and q[z] is not None else None for u, z in zip(UNIT, Z)}
        rows.append({"seed_index": at, **q, **unit, HOT: 1.0 / q["norm"] if known else None})
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{', '.join(f.replace(' ', ': ') for f in fields)}>>")


def _similar(q: str = "_q") -> Column:
    """Cosine of a listing and the seed in struct column ``q``."""
    dot = sum((F.col(z) * F.col(f"{q}.{z}") for z in Z[1:]), F.col(Z[0]) * F.col(f"{q}.{Z[0]}"))
    dot = (dot + F.when(F.col("location_bucket") == F.col(f"{q}.location_bucket"), 1.0).otherwise(0.0)
           + F.when(F.col("type_key") == F.col(f"{q}.type_key"), 1.0).otherwise(0.0))
    return dot / (F.col("norm") * F.col(f"{q}.norm"))


def _block_distances(stats: DataFrame, queries: Column) -> DataFrame:
    """(_q, _block, _rows, _near, _far) of every seed and block: bounds of the squared distance between the seed's unit
    vector and those of the block, from the least and greatest value of each part. Cosine is 1 less half of it."""
    def gaps(name: str):
        lo, hi, x = F.col(f"_lo{name}"), F.col(f"_hi{name}"), F.col(f"_q.{name}")
        near = F.greatest(lo - x, x - hi, F.lit(0.0))
        far = F.greatest(x - lo, hi - x)
        return near * near, far * far

    x, lo, hi = F.col(f"_q.{HOT}"), F.col(f"_lo{HOT}"), F.col(f"_hi{HOT}")
    hot_near, hot_far = gaps(HOT)
    near, far = F.lit(0.0), F.lit(0.0)
    for u in UNIT:
        n, f = gaps(u)
        near, far = near + n, far + f
    for c in ("location_bucket", "type_key"):
        same = F.col(c) == F.col(f"_q.{c}")
        near = near + F.when(same, hot_near).otherwise(x * x + lo * lo)
        far = far + F.when(same, hot_far).otherwise(x * x + hi * hi)
    return (stats.withColumn("_q", F.explode(queries))
            .select("_q", "_block", "_rows", near.alias("_near"), far.alias("_far")))


def candidate_blocks(blocked: DataFrame, queries: Column, top_k: int) -> DataFrame:
    """(_block, _q, _rows): the blocks that can hold one of a seed's ``top_k`` most similar listings.

    Some block has more than ``top_k`` rows within its far bound, so its best ``top_k`` rows, scored exactly, give
    each seed a similarity that its result cannot fall below; blocks whose near bound says less are left out. With no
    block of that size, or an undefined distance, blocks are kept.
    """
    ends = [x for u in [*UNIT, HOT] for x in (F.min(u).alias(f"_lo{u}"), F.max(u).alias(f"_hi{u}"))]
    stats = materialize(blocked.groupBy("_block", "location_bucket", "type_key")
                        .agg(F.count(F.lit(1)).alias("_rows"), *ends), "blocks")
    every = _block_distances(stats, queries)
    seed = F.col("_q.seed_index")
    closest = (every.where(F.col("_rows") > top_k).groupBy(seed.alias("_seed"))
               .agg(F.min_by(F.struct("_q", "_block"), "_far").alias("_b")).select("_seed", "_b._q", "_b._block"))
    scored = _seeds_to_rows(blocked, closest).select("_q.seed_index", _similar().alias("_s"))
    first = Window.partitionBy("seed_index").orderBy(F.col("_s").desc())
    least = (scored.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= top_k)
             .groupBy("seed_index").agg(F.min("_s").alias("_least"), F.count("_s").alias("_n"))
             .where(F.col("_n") == top_k))
    limits = materialize(least.select(F.col("seed_index").alias("_seed"),
                                      (F.lit(2.0) * (F.lit(1.0) - F.col("_least")) + F.lit(ROUNDING)).alias("_limit")),
                         "limits")                     # a row for each seed
    kept = every.withColumn("_seed", seed).join(F.broadcast(limits), "_seed", "left")
    return (kept.where(F.coalesce(F.col("_near") <= F.col("_limit"), F.lit(True)))
            .select("_block", "_q", "_rows"))


def _seeds_to_rows(blocked: DataFrame, asked: DataFrame) -> DataFrame:
    """Listings beside the seeds that ask their block, the seed itself left out: (listing columns, _q)."""
    asked = asked.select("_block", "_q").dropDuplicates(["_block", "_q"])
    few = small_table(asked, ASKED_ROWS)
    pairs = blocked.join(few if few is not None else asked, "_block")
    return pairs.where(F.col(KEY_COLUMN) != F.col(f"_q.{KEY_COLUMN}"))


def _likely(pairs: DataFrame, top_k: int, seeds: int) -> DataFrame:
    """The ``pairs`` that can be among the ``top_k`` of their seed (all of them, and some more that tie).

    The ``top_k``-th best similarity among any of the rows is one that the result
    cannot fall below; it is sought in a BOUND_SHARE-th of them, drawn by the
    key's hash, so that of all rows only those that reach it are sorted. A seed
    with fewer than ``top_k`` similarities there keeps all its rows.
    """
    few = pairs.where(F.pmod(F.xxhash64(KEY_COLUMN), F.lit(BOUND_SHARE)) == 0)
    few = few.select(F.col("_q.seed_index").alias("_seed"), F.col("similarity").alias("_s")).where(F.col("_s").isNotNull())
    order = Window.partitionBy("_seed").orderBy(F.col("_s").desc())
    found = (few.withColumn("_n", F.row_number().over(order)).where(F.col("_n") == top_k)
             .select("_seed", "_s").collect() if seeds and top_k > 0 else [])                # a row for each of few seeds
    if not found:
        return pairs
    least = F.create_map(*[x for r in found for x in (F.lit(r["_seed"]), F.lit(r["_s"]))])[F.col("_q.seed_index")]
    return pairs.where(least.isNull() | (F.col("similarity") >= least))


def batch_recommend(feats: DataFrame, seeds: Sequence[int] | None = None, top_k: int = 5,
                    few_seeds: int = FEW_SEEDS) -> DataFrame:
    """Top-k similar listings for each seed position (default: first, middle
    and last row of the table's row order); positions out of range give nothing.

    Up to ``few_seeds`` seeds are one array literal exploded against each row in
    one scan. More are first held against blocks of listings with nearly equal
    unit vectors, and only against the rows of blocks that can reach the seed's
    result (``candidate_blocks``): exact, without rows x seeds similarities.
    The scores of few seeds are bounded first (``_likely``), so that only rows
    that can be among a seed's best ``top_k`` are ranked; of many, the rank limit
    is pushed below the shuffle.
    """
    n = feats.count()
    if seeds is None:
        seeds = sorted({0, n - 1} | ({n // 2} if n > 2 else set()))
    found = rows_at(feats, [int(s) for s in seeds if 0 <= s < n]) if n >= 2 else []
    queries = _seed_array(found)
    if len(found) > few_seeds:
        blocked = _with_blocks(feats)
        pairs = _seeds_to_rows(blocked, candidate_blocks(blocked, queries, top_k))
    else:
        pairs = feats.withColumn("_q", F.explode(queries))
        pairs = pairs.where(F.col(KEY_COLUMN) != F.col(f"_q.{KEY_COLUMN}"))
    pairs = pairs.withColumn("similarity", _similar())
    if len(found) <= few_seeds:
        pairs = _likely(pairs, top_k, len(found))
    first = Window.partitionBy("_q.seed_index").orderBy(F.col("similarity").desc(), F.col(KEY_COLUMN).asc())
    top = pairs.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= top_k)
    return top.select(F.col("_q.name").alias("query_name"), *_result_columns(feats), "similarity",
                      F.col(f"_q.{KEY_COLUMN}").alias("query_key"), F.col("_q.seed_index").alias("seed_index"))


def recommend_preferences(df: DataFrame, max_price: float | None = None, min_rating: float | None = None,
                          preferred_locations: Sequence[str] | None = None, types: Sequence[str] | None = None,
                          top_k: int = 8) -> DataFrame:
    """Filter by hard constraints, refit the feature space on the survivors,
    and rank them by cosine similarity to the per-dimension median listing
    ("ideal"). One-hot medians are 1 for a category held by more than half of
    the survivors, 0.5 at exactly half, else 0. A zero ideal scores 0; with a
    single survivor the score is NULL. The type filter comes before missing
    ratings are filled, so the fill is the median of the chosen types."""
    prep = prepare_numeric(preference_filter(df, types=types))
    work = materialize(preference_filter(prep, max_price, min_rating, preferred_locations), "survivors")
    feats = features(work)
    n = work.count()
    if n == 0:
        return feats.select(*_result_columns(feats), F.lit(None).cast("double").alias("similarity_to_ideal")).limit(0)
    med = exact_quantiles(feats.select(*Z).unpivot([], Z, "_z", "_v"), "_v", [0.5], ["_z"], names=["m"]).collect()
    ideal = {z: 0.0 for z in Z}
    ideal.update({r["_z"]: float(r["m"]) for r in med})

    def weights(col: str) -> tuple[Column, float]:
        # categories held by at least half of the survivors: at most two rows
        rows = (feats.groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
                .where(F.col("_c") * 2 >= F.lit(n)).collect())
        w = F.lit(0.0)
        sq = 0.0
        for r in rows:
            wt = 1.0 if r["_c"] * 2 > n else 0.5
            w = F.when(F.col(col) == F.lit(r[col]), F.lit(wt)).otherwise(w)
            sq += wt * wt
        return w, sq

    wb, sqb = weights("location_bucket")
    wt, sqt = weights("type_key")
    ideal_norm = math.sqrt(sum(ideal[z] * ideal[z] for z in Z) + sqb + sqt)
    dot = _dot(ideal) + wb + wt
    if n <= 1:
        sim = F.lit(None).cast("double")
    elif ideal_norm == 0:
        sim = F.lit(0.0)
    else:
        sim = dot / (F.lit(ideal_norm) * F.col("norm"))
    scored = feats.withColumn("similarity_to_ideal", sim)
    top = scored.orderBy(F.col("similarity_to_ideal").desc_nulls_last(), F.col(KEY_COLUMN).asc()).limit(top_k)
    return top.select(*_result_columns(feats), "similarity_to_ideal")
