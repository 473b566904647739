"""Distributed ranking primitives: exact quantiles, hash top-k, row numbering.

None of these puts a whole group into one task:

* ``ranked_values`` computes, for every distinct (group, value), how many rows
  of the group hold a smaller value. Values are first collapsed to
  (value, count) with a map-side-combined aggregate, range-partitioned on
  (group, value) (balanced even for a hot group), written once, and ranked
  with running sums inside each range partition plus a prefix over the
  per-partition block totals.
* ``exact_quantiles`` finds the rank positions of linear interpolation of all
  groups together by radix selection: a map-side-combined count over bins that
  keep the order of the values, a running sum over the bin counts, and then only
  the rows of the bins that hold a wanted rank. Nothing is sorted or written but
  those bins (a few rows per group).
* ``hash_top_k`` keeps the k rows with the smallest (u, tie) per group, where
  u is a uniform 60-bit hash. Rows are counted per (group, u-bin) (2**16
  bins), the boundary bin is found by a prefix sum over the bin counts, only
  the boundary bin's rows are ranked with a window, and the k-th (u, tie) of
  each group is the filter of one selecting scan.
* ``consecutive_index`` numbers rows 1..n in a total order: range-partitioned
  sort, in-partition positions from ``monotonically_increasing_id``, the
  layout frozen by writing it to the shared checkpoint folder, then
  per-partition offsets from a table with one row per partition.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.functions.keys import U_BITS
from wayfarer.session import materialize, small_table, store

HASH_BIN_BITS = 16


def ranked_values(df: DataFrame, value: str, group_cols: Sequence[str] = (),
                  partitions: int | None = None) -> DataFrame:
    """(group..., value, cnt, below, n) for each distinct non-null value.

    ``below`` = rows of the group with a strictly smaller value, ``n`` = rows
    of the group with a non-null value.

    Distinct (group, value) pairs are range-partitioned on (group, value) -
    the sampled range bounds split even a group holding a third of all values
    across many balanced partitions - and the layout (with each row's
    partition id) is written once, so it is stable under task retries. A
    running sum inside each (partition, group) block, plus the prefix of the
    block totals per group (at most one row per partition and group), gives
    every value's rank. No window sees more than one range partition.
    """
    g = list(group_cols)
    spark = df.sparkSession
    n_part = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = (df.select(*g, F.col(value).alias("_v"))
         .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
         .groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_cnt")))
    keys = [F.col(c) for c in g] + [F.col("_v")]
    laid = w.repartitionByRange(n_part, *keys).withColumn("_pid", F.spark_partition_id())
    laid = store(laid, "ranked")
    before = Window.unboundedPreceding
    laid = laid.withColumn("_local", F.coalesce(F.sum("_cnt").over(
        Window.partitionBy("_pid", *g).orderBy("_v").rowsBetween(before, -1)), F.lit(0)))
    blocks = laid.groupBy("_pid", *g).agg(F.sum("_cnt").alias("_bc"))
    blocks = blocks.select(
        "_pid", *g,
        F.coalesce(F.sum("_bc").over(Window.partitionBy(*g).orderBy("_pid").rowsBetween(before, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_bc").over(Window.partitionBy(*g)).alias("_n"))
    small = small_table(blocks, 1_000_000)
    out = laid.join(small if small is not None else blocks, ["_pid", *g])
    return out.select(*g, F.col("_v").alias(value), F.col("_cnt").alias("cnt"),
                      (F.col("_off") + F.col("_local")).alias("below"), F.col("_n").alias("n"))


#: Bins of an octave in the first round of a selection, and of a bin's own range in later ones.
OCTAVE_BINS, RANGE_BINS = 256, 65_536


def _order_bin(v: Column) -> Column:
    """An integer that never falls as the double ``v`` rises: its octave in OCTAVE_BINS parts.

    Every step is monotone in floating point, so values of a lower bin are
    smaller than those of a higher one; how evenly bins fill affects speed only.
    """
    beyond = 600_000   # past every finite double's bin
    part = lambda x: F.when(x == float("inf"), F.lit(beyond)).otherwise(
        F.floor(F.log2(x) * OCTAVE_BINS).cast("bigint") + beyond // 2)
    return F.when(v > 0, part(v)).when(v < 0, -part(-v)).otherwise(0).cast("bigint")


def _wanted_bins(d: DataFrame, qs: Sequence[float], g: list[str], path: list[str]) -> DataFrame:
    """The bins of ``d`` that hold a wanted rank, with the rows ``below`` them in their group and the group's ``n``."""
    bins = d.groupBy(*g, *path, "_b").agg(F.count(F.lit(1)).alias("cnt"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx"),
                                          *([F.max("_off").alias("_off"), F.max("n").alias("n")] if path else []))
    w = Window.partitionBy(*g, *path)
    below = F.coalesce(F.sum("cnt").over(w.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = bins.withColumn("below", below + F.col("_off") if path else below)
    if not path:
        bins = bins.withColumn("n", F.sum("cnt").over(w))
    hit = F.lit(False)
    for q in qs:
        pos = (F.col("n") - 1) * F.lit(float(q))
        for rank in (F.floor(pos), F.ceil(pos)):
            hit = hit | ((F.col("below") <= rank) & (rank < F.col("below") + F.col("cnt")))
    return bins.where(hit).drop("_off")


def selected_ranks(df: DataFrame, value: str, qs: Sequence[float], group_cols: Sequence[str] = ()) -> DataFrame:
    """The rows of ``ranked_values`` that the quantiles ``qs`` can need: (group..., value, cnt, below, n).

    Each round counts the rows per bin and keeps the bins with a wanted rank; a
    bin of more than EDGE_LIMIT rows is cut again in RANGE_BINS parts of its own
    range, until the rows of the wanted bins can be told apart by value. Where
    every wanted bin holds one value (ratings), the first count is the answer.
    """
    g, path, found = list(group_cols), [], []
    d = df.select(*g, F.col(value).alias("_v"))
    x = F.col("_v").cast("double")
    d = d.where(F.col("_v").isNotNull() & ~F.isnan(x)).withColumn("_b", _order_bin(x + 0.0))
    while True:
        wanted = materialize(_wanted_bins(d, qs, g, path), "wanted-bins")
        mixed = F.col("_mn") < F.col("_mx")
        s = wanted.agg(F.count(F.lit(1)).alias("rows"), F.max(F.when(mixed, F.col("cnt"))).alias("most")).first()
        found.append(wanted.where(~mixed).select(*g, F.col("_mn").alias(value), "cnt", "below", "n"))
        if s["most"] is None:
            return reduce(DataFrame.unionByName, found)
        few = wanted.where(mixed).select(*g, *path, "_b", "_mn", "_mx", F.col("below").alias("_off"), "n")
        inside = d.select(*g, *path, "_b", "_v").join(F.broadcast(few) if s["rows"] <= 1_000_000 else few, [*g, *path, "_b"])
        if s["most"] <= EDGE_LIMIT:
            break
        spot = F.floor((x - F.col("_mn").cast("double")) / (F.col("_mx").cast("double") - F.col("_mn").cast("double")) * RANGE_BINS)
        path = [*path, f"_p{len(path)}"]
        d = inside.withColumnRenamed("_b", path[-1]).withColumn("_b", spot.cast("bigint")).drop("_mn", "_mx")
    w = Window.partitionBy(*g, *path, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    values = inside.groupBy(*g, *path, "_b", "_v").agg(F.count(F.lit(1)).alias("cnt"), F.max("_off").alias("_off"), F.max("n").alias("n"))
    told = values.select(*g, F.col("_v").alias(value), "cnt", (F.col("_off") + F.coalesce(F.sum("cnt").over(w), F.lit(0))).alias("below"), "n")
    return reduce(DataFrame.unionByName, found, told)


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], group_cols: Sequence[str] = (),
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles per group (pandas / numpy default).

    q-th quantile = v[lo] + (v[hi] - v[lo]) * (pos - lo) with pos = (n-1)q,
    lo/hi its floor/ceil, v[] the sorted values. Groups without values are
    absent; the caller left-joins if needed.
    """
    names = list(names or [f"q{int(round(q * 100))}" for q in qs])
    return quantiles_of_ranks(selected_ranks(df, value, qs, group_cols), value, qs, group_cols, names)


def quantiles_of_ranks(r: DataFrame, value: str, qs: Sequence[float], group_cols: Sequence[str],
                       names: Sequence[str]) -> DataFrame:
    """Quantiles per group read off a table of ranked values."""
    g = list(group_cols)
    n1 = F.col("n") - 1
    hit_cols, aggs = [], []
    for i, q in enumerate(qs):
        pos = n1 * F.lit(float(q))
        lo, hi = F.floor(pos), F.ceil(pos)
        below, upto = F.col("below"), F.col("below") + F.col("cnt")
        hit_lo = (below <= lo) & (lo < upto)
        hit_hi = (below <= hi) & (hi < upto)
        hit_cols += [hit_lo, hit_hi]
        aggs += [F.max(F.when(hit_lo, F.col(value))).alias(f"_lo{i}"),
                 F.max(F.when(hit_hi, F.col(value))).alias(f"_hi{i}"),
                 F.max(pos - lo).alias(f"_f{i}")]
    any_hit = hit_cols[0]
    for h in hit_cols[1:]:
        any_hit = any_hit | h
    picked = r.where(any_hit).groupBy(*g).agg(*aggs)
    outs = []
    for i, nm in enumerate(names):
        lo_v, hi_v, frac = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_f{i}")
        outs.append(F.when(frac == 0, lo_v).otherwise(lo_v + (hi_v - lo_v) * frac).alias(nm))
    return picked.select(*g, *outs)


EDGE_LIMIT = 2_000_000        # rows ranked directly inside one boundary bin
TARGET_BIN_ROWS = 1024        # rows per bin aimed at when the group size is known


def _bin_bounds(d: DataFrame, g: list[str]) -> DataFrame:
    """Per group: row count, boundary bin, rows still needed inside it and its size."""
    counts = d.groupBy(*g, "_hb").agg(F.count(F.lit(1)).alias("_c"), F.max("_k").alias("_k"))
    cum = F.coalesce(F.sum("_c").over(
        Window.partitionBy(*g).orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("_cb", cum)
    boundary = (F.col("_cb") < F.col("_k")) & (F.col("_k") <= F.col("_cb") + F.col("_c"))
    return counts.groupBy(*g).agg(
        F.sum("_c").alias("_ng"),
        F.max(F.when(boundary, F.col("_hb"))).alias("_bstar"),
        F.max(F.when(boundary, F.col("_k") - F.col("_cb"))).alias("_need"),
        F.max(F.when(boundary, F.col("_c"))).alias("_ec"))


def _thresholds(d: DataFrame, u: str, tie: str, g: list[str], shift: int, bits: int,
                max_groups: int) -> DataFrame:
    """Per group: ``_ng`` rows, ``_k`` wanted and the k-th smallest (u, tie) as ``_tu``, ``_tt``.

    ``d`` carries the per-group ``_k``. Bins are ``bits`` hash bits below
    ``shift``; the boundary bin is refined on the next bits while one holds
    more than EDGE_LIMIT rows, then its rows alone are ranked by a window.
    """
    d = d.withColumn("_hb", F.shiftright(F.col(u), shift).bitwiseAND(F.lit((1 << bits) - 1)))
    bounds = store(_bin_bounds(d, g), "bounds")
    small = small_table(bounds, max_groups)
    edge = d.join(small if small is not None else bounds, g).where(F.col("_hb") == F.col("_bstar"))
    edge = edge.select(*g, u, tie, F.col("_need").alias("_k"))
    most = bounds.agg(F.max("_ec")).first()[0]
    if most is not None and most > EDGE_LIMIT and shift > 0:
        nxt = min(HASH_BIN_BITS, shift)
        at = _thresholds(edge, u, tie, g, shift - nxt, nxt, max_groups).select(*g, "_tu", "_tt")
    else:
        rn = F.row_number().over(Window.partitionBy(*g).orderBy(F.col(u), F.col(tie)))
        at = (edge.withColumn("_rn", rn).where(F.col("_rn") == F.col("_k"))
              .select(*g, F.col(u).alias("_tu"), F.col(tie).alias("_tt")))
    return bounds.select(*g, "_ng").join(at, g, "left")


def _threshold(d: DataFrame, u: str, tie: str, bits: int) -> tuple:
    """(_ng, _tu, _tt) of ``d`` as one group: each round looks at one row of bounds."""
    shift, size = U_BITS - bits, None
    while True:
        hb = F.shiftright(F.col(u), shift).bitwiseAND(F.lit((1 << bits) - 1))
        b = _bin_bounds(d.withColumn("_hb", hb), []).first()
        size = size if size is not None else b["_ng"]
        if b["_bstar"] is None:
            return size, None, None
        d = d.where(hb == F.lit(b["_bstar"])).withColumn("_k", F.lit(b["_need"]))
        if b["_ec"] <= EDGE_LIMIT or shift == 0:
            rn = F.row_number().over(Window.orderBy(F.col(u), F.col(tie)))
            r = d.withColumn("_rn", rn).where(F.col("_rn") == F.lit(b["_need"])).select(u, tie).first()
            return size, r[0], r[1]
        bits = min(HASH_BIN_BITS, shift)
        shift -= bits


def _select(d: DataFrame, u: str, tie: str, g: list[str], bits: int, max_groups: int) -> DataFrame:
    """Mark ``_sel`` on every row of ``d`` (which carries the per-group ``_k``): the rows up to their group's
    threshold. The thresholds are one row per group; the rows are then read once more, in one scan."""
    if g:
        t = _thresholds(d, u, tie, g, U_BITS - bits, bits, max_groups)
        small = small_table(t, max_groups)
        d = d.join(small if small is not None else t, g, "left")
    else:
        vals = _threshold(d, u, tie, bits)
        tie_type = d.schema[tie].dataType
        d = d.select("*", F.lit(vals[0]).cast("bigint").alias("_ng"), F.lit(vals[1]).cast("bigint").alias("_tu"),
                     F.lit(vals[2]).cast(tie_type).alias("_tt"))
    upto = (F.col(u) < F.col("_tu")) | ((F.col(u) == F.col("_tu")) & (F.col(tie) <= F.col("_tt")))
    return d.withColumn("_sel", F.coalesce((F.col("_ng") <= F.col("_k")) | ((F.col("_k") > 0) & upto), F.lit(False)))


def _bits_for(max_group_rows: int | None) -> int:
    if max_group_rows is None:
        return HASH_BIN_BITS
    want = math.ceil(math.log2(max(max_group_rows, 1) / TARGET_BIN_ROWS)) if max_group_rows > TARGET_BIN_ROWS else 0
    return int(min(HASH_BIN_BITS, max(4, want)))


def hash_top_k(df: DataFrame, u: str, tie: str, k, group_cols: Sequence[str] = (),
               flag: str | None = None, max_groups: int = 100_000,
               max_group_rows: int | None = None) -> DataFrame:
    """Rows with the k smallest (u, tie) per group.

    ``u`` must be a uniform 60-bit hash column; ``k`` an int or the name of a
    column that is constant within each group. With ``flag`` every row is
    returned and ``flag`` marks the kept ones.

    One aggregation pass counts rows per (group, hash bin) - at most 2**16
    bins, fewer when ``max_group_rows`` says the groups are small; a second
    pass ranks the rows of the boundary bins (refined on further hash bits
    while one holds more than EDGE_LIMIT rows) and gives each group the exact
    (u, tie) of its k-th row; the result is one scan with that bound as a
    filter. No window ever sees more than 2**16 bin counts or EDGE_LIMIT rows
    of one group.
    """
    g = list(group_cols)
    bits = _bits_for(max_group_rows)
    d = df.withColumn("_k", (F.col(k) if isinstance(k, str) else F.lit(int(k))).cast("bigint"))
    both = _select(d, u, tie, g, bits, max_groups).drop("_k", "_ng", "_tu", "_tt")
    if flag:
        return both.withColumnRenamed("_sel", flag)
    return both.where("_sel").drop("_sel")


#: Standard deviations around the expected place of a threshold within which rows are ranked.
MARGIN = 8


def hash_thresholds(d: DataFrame, u: str, tie: str, wanted: dict, group: str | None = None) -> dict | None:
    """{group: (u, tie) of its k-th smallest row} for ``wanted`` {group: (rows n, k)} with 0 < k < n.

    ``u`` is a uniform hash, so a group's k-th smallest is near k / n of its
    range: one pass counts the rows before and inside a narrow band around that
    place, which proves that the k-th is in it, and the second ranks the band's
    rows (some 16 sqrt(k)). Returns None where the counts do not prove it (a
    hash that is not uniform, as of repeated keys); ``hash_top_k`` serves then.
    """
    if not wanted:
        return {}
    spark = d.sparkSession
    bands = []
    for name, (n, k) in wanted.items():
        p = k / n
        half = MARGIN * math.sqrt(p * (1 - p) / n) + 2 * MARGIN / n
        bands.append((name, int(max(0.0, p - half) * (1 << U_BITS)), int(min(1.0, p + half) * (1 << U_BITS)), int(k)))
    if group is None:
        _, lo, hi, k = bands[0]
        near = d.select(F.lit(None).cast("string").alias("_g"), F.col(u).alias("_u"), F.col(tie).alias("_t"), F.lit(lo).alias("_lo"),
                        F.lit(hi).alias("_hi"), F.lit(k).cast("bigint").alias("_k"))
    else:
        table = spark.createDataFrame(bands, "_g string, _lo bigint, _hi bigint, _k bigint")
        near = d.select(F.col(group).alias("_g"), F.col(u).alias("_u"), F.col(tie).alias("_t")).join(F.broadcast(table), "_g")
    near = near.where(F.col("_u") < F.col("_hi"))
    before = F.col("_u") < F.col("_lo")
    seen = {r["_g"]: (r["b"], r["i"]) for r in near.groupBy("_g").agg(F.count_if(before).alias("b"), F.count_if(~before).alias("i")).collect()}
    if any(name not in seen or not seen[name][0] < k <= sum(seen[name]) for name, _, _, k in bands) or max(
            i for _, i in seen.values()) > EDGE_LIMIT:
        return None
    inside = near.where(~before).select("_g", "_u", "_t", "_k")
    past = F.col("_k") - F.lit(seen[None][0]) if group is None else None
    if group is not None:
        left = spark.createDataFrame([(name, k - seen[name][0]) for name, _, _, k in bands], "_g string, _left bigint")
        inside, past = inside.join(F.broadcast(left), "_g"), F.col("_left")
    rank = F.row_number().over(Window.partitionBy("_g").orderBy("_u", "_t"))
    rows = inside.withColumn("_past", past).withColumn("_rn", rank).where(F.col("_rn") == F.col("_past")).collect()
    return {r["_g"]: (r["_u"], r["_t"]) for r in rows}


def row_at_hash_rank(df: DataFrame, u: str, tie: str, rank: int) -> DataFrame:
    """The single row at 0-based position ``rank`` in (u, tie) order (empty if
    out of range), by radix selection on the hash: a counting pass over 16
    hash bits finds the bin holding the rank; while that bin holds more than
    EDGE_LIMIT rows the next 16 bits are counted inside it; finally only the
    rows of the last bin are ranked."""
    rank = int(rank)
    if rank < 0:
        return df.limit(0)
    if rank == 0:
        return df.orderBy(F.col(u), F.col(tie)).limit(1)
    shift, need, cond = U_BITS, rank + 1, F.lit(True)
    while shift > 0:
        bits = min(HASH_BIN_BITS, shift)
        shift -= bits
        hb = F.shiftright(F.col(u), shift).bitwiseAND(F.lit((1 << bits) - 1))
        b = _bin_bounds(df.where(cond).withColumn("_hb", hb).withColumn("_k", F.lit(need).cast("bigint")),
                        []).first()
        if b is None or b["_bstar"] is None:
            return df.limit(0)
        cond = cond & (hb == F.lit(b["_bstar"]))
        need = b["_need"]
        if b["_ec"] <= EDGE_LIMIT:
            break
    rn = F.row_number().over(Window.orderBy(F.col(u), F.col(tie)))
    return df.where(cond).withColumn("_rn", rn).where(F.col("_rn") == F.lit(need)).drop("_rn")


def consecutive_index(df: DataFrame, order_cols: Sequence, index_col: str = "row_index",
                      partitions: int | None = None) -> DataFrame:
    """Number rows 1..n following ``order_cols`` (a total order), distributed.

    The sorted layout (with partition id and in-partition position as
    columns) is written once to the shared checkpoint folder, so the numbering
    is stable under task retries; offsets come from a table with one row per
    partition.
    """
    spark = df.sparkSession
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    n_part = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    mid = F.monotonically_increasing_id()
    laid = (df.repartitionByRange(n_part, *cols).sortWithinPartitions(*cols)
            .withColumn("_mid", mid))
    laid = laid.select("*", F.shiftright("_mid", 33).alias("_pid"),
                       F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos")).drop("_mid")
    laid = store(laid, "ordered")
    sizes = laid.groupBy("_pid").agg(F.count(F.lit(1)).alias("_size"))
    sizes = sizes.withColumn("_off", F.coalesce(F.sum("_size").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # one row per partition: a proven size bound for the broadcast
    out = laid.join(F.broadcast(sizes.select("_pid", "_off")), "_pid")
    return out.withColumn(index_col, F.col("_off") + F.col("_pos") + 1).drop("_pid", "_pos", "_off")
