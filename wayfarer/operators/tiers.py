"""Price tiers: K-means over (price, cost_per_day), tier names by centre price.

``kmeans_tiers`` runs all restarts of K-means together: rows of one point become
one weighted point, seeds are drawn by squared distance with an exponential race
on a hash (so a rerun draws the same), and each Lloyd step is one aggregate with
a row per restart and centre. The restart with the lowest within-cluster cost is
kept.
``assign_centers`` is the deterministic half: given centres, every row goes
to the nearest one (ties to the lower index) in a single projection.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.operators.analytics import cost_per_day
from wayfarer.operators.ranking import exact_quantiles
from wayfarer.schema import TIER_LABELS, UNCLASSIFIED
from wayfarer.session import materialize


def model_rows(df: DataFrame) -> DataFrame:
    """Rows usable for clustering: numeric price, cost_per_day with the
    duration defaulted (NULL / 0 -> 1), both present."""
    out = df.withColumn("cost_per_day", cost_per_day())
    return out.where(F.col("price").isNotNull() & F.col("cost_per_day").isNotNull())


def _label_column(cluster: Column, centers_price: Sequence[Column]) -> Column:
    """Tier label from centre prices given as (possibly scalar-subquery) columns."""
    k = len(centers_price)
    ranks = []
    for i in range(k):
        r = F.lit(0)
        for j in range(k):
            if j == i:
                continue
            less = (centers_price[j] < centers_price[i]) | ((centers_price[j] == centers_price[i]) & F.lit(j < i))
            r = r + F.when(less, 1).otherwise(0)
        ranks.append(r)
    names = F.array(*[F.lit(n) for n in TIER_LABELS])
    expr = F.lit(UNCLASSIFIED)
    for i in range(k - 1, -1, -1):
        lab = F.when(ranks[i] < len(TIER_LABELS), F.element_at(names, (ranks[i] + 1).cast("int"))) \
            .otherwise(F.lit(UNCLASSIFIED))
        expr = F.when(cluster == i, lab).otherwise(expr)
    return expr


def assign_centers(df: DataFrame, centers: Sequence[tuple], features=("price", "cost_per_day")) -> DataFrame:
    """Nearest centre by squared Euclidean distance; adds cluster, cluster_label.

    ``centers`` holds (x, y) pairs of floats or scalar Columns, so centres
    computed by a subquery stay inside the plan.
    """
    fx, fy = (F.col(c) for c in features)
    cs = [(c[0] if isinstance(c[0], Column) else F.lit(float(c[0])),
           c[1] if isinstance(c[1], Column) else F.lit(float(c[1]))) for c in centers]
    dists = [(fx - cx) * (fx - cx) + (fy - cy) * (fy - cy) for cx, cy in cs]
    best = F.lit(0)
    best_d = dists[0]
    for i in range(1, len(dists)):
        best = F.when(dists[i] < best_d, F.lit(i)).otherwise(best)
        best_d = F.least(best_d, dists[i])
    out = df.withColumn("cluster", best.cast("int"))
    return out.withColumn("cluster_label", _label_column(F.col("cluster"), [c[0] for c in cs]))


def quantile_centers(df: DataFrame, qs: Sequence[float] = (0.2, 0.5, 0.8),
                     features=("price", "cost_per_day")) -> list[tuple[float, float]]:
    """Data-derived centres: the exact q-quantiles of each feature (one pass
    of ``exact_quantiles`` over both features, k small rows to the driver)."""
    names = [f"c{i}" for i in range(len(qs))]
    long = df.select(*features).unpivot([], list(features), "_f", "_v")
    rows = {r["_f"]: r for r in exact_quantiles(long, "_v", qs, ["_f"], names=names).collect()}
    return [(float(rows[features[0]][n]), float(rows[features[1]][n])) for n in names]


def _squared(centers: Sequence[tuple]) -> list[str]:
    return [f"((x - {x!r}D) * (x - {x!r}D) + (y - {y!r}D) * (y - {y!r}D))" for x, y in centers]


def _least(terms: Sequence[str]) -> str:
    return terms[0] if len(terms) == 1 else f"least({', '.join(terms)})"


def _seeded(points: DataFrame, k: int, restarts: int, seed: int) -> list[list[tuple[float, float]]]:
    """For every restart up to k different points, each drawn with weight n times its squared distance to those before:
    the first arrival of exponential clocks with those rates. One aggregate a draw, for all restarts."""
    centers: list[list[tuple[float, float]]] = [[] for _ in range(restarts)]
    for step in range(k):
        firsts = []
        for r, cs in enumerate(centers):
            clock = f"-ln((shiftrightunsigned(xxhash64(x, y, {seed + r}L, {step}), 11) + 0.5D) / 9007199254740992D)"
            rate = f"(n * {_least(_squared(cs))})" if cs else "n"
            firsts.append(F.expr(f"min(CASE WHEN {rate} > 0 THEN struct({clock} / {rate} AS at, x, y) END)").alias(f"r{r}"))
        row = points.agg(*firsts).first()
        for r, cs in enumerate(centers):
            if row[r] is not None:
                cs.append((row[r]["x"], row[r]["y"]))
    return centers


def _moved(points: DataFrame, centers: dict[int, list[tuple]]) -> dict[int, tuple[list[tuple], float]]:
    """One Lloyd step of several restarts: new centres (one without points stays) and the cost of the old ones."""
    nearest = []
    for r, cs in centers.items():
        d = _squared(cs)
        own = f"array_position(array({', '.join(d)}), {_least(d)}) - 1" if len(d) > 3 else "CASE " + " ".join(
            f"WHEN {' AND '.join(f'{d[i]} <= {d[j]}' for j in range(len(d)) if j != i) or 'true'} THEN {i}L" for i in range(len(d))) + " END"
        nearest.append(f"struct({r} AS r, {own} AS c, {_least(d)} AS d)")
    sums = (points.select("x", "y", "n", F.expr(f"inline(array({', '.join(nearest)}))"))
            .groupBy("r", "c").agg(F.sum(F.col("n") * F.col("x")).alias("x"), F.sum(F.col("n") * F.col("y")).alias("y"),
                                   F.sum("n").alias("n"), F.sum(F.col("n") * F.col("d")).alias("cost"))).collect()
    out = {r: (list(cs), 0.0) for r, cs in centers.items()}
    for s in sums:
        cs, cost = out[s["r"]]
        cs[s["c"]] = (s["x"] / s["n"], s["y"] / s["n"])
        out[s["r"]] = cs, cost + s["cost"]
    return out


def _shift(a: Sequence[tuple], b: Sequence[tuple]) -> float:
    return sum((x - u) ** 2 + (y - v) ** 2 for (x, y), (u, v) in zip(a, b))


def kmeans_centers(df: DataFrame, k: int = 3, restarts: int = 10, seed: int = 42, max_iter: int = 300,
                   tol: float = 1e-4, features=("price", "cost_per_day")) -> tuple[list[tuple[float, float]], float]:
    """Centres of the cheapest of ``restarts`` K-means fits over the finite points of ``df``, and their cost.

    A restart rests when its centres move less than ``tol`` times the spread of
    the points; the cheapest one then goes on until they move less than ``tol``.
    With fewer different points than k there are fewer centres.
    """
    x, y = (F.col(c).cast("double") for c in features)
    finite = F.abs(x) + F.abs(y) < float("inf")
    points = materialize(df.where(finite).groupBy(x.alias("x"), y.alias("y")).agg(F.count(F.lit(1)).alias("n")), "points")
    w = lambda c: F.sum(F.col("n") * c) / F.sum("n")
    m = points.agg((w(F.col("x") * F.col("x")) - w(F.col("x")) * w(F.col("x"))
                    + w(F.col("y") * F.col("y")) - w(F.col("y")) * w(F.col("y"))).alias("spread")).first()["spread"]
    if m is None:
        return [], 0.0
    fits = {r: (cs, float("inf")) for r, cs in enumerate(_seeded(points, k, restarts, seed))}
    active, near = set(fits), tol * max(m, 0.0) / 2
    for _ in range(max_iter):
        if not active:
            break
        for r, (cs, cost) in _moved(points, {r: fits[r][0] for r in sorted(active)}).items():
            if _shift(cs, fits[r][0]) <= near:
                active.discard(r)
            fits[r] = cs, cost
    best = min(fits, key=lambda r: (fits[r][1], r))
    centers, cost = fits[best]
    for _ in range(max_iter):
        moved, cost = _moved(points, {best: centers})[best]
        shift, centers = _shift(moved, centers), moved
        if shift <= tol * tol:
            break
    return centers, cost


def kmeans_tiers(df: DataFrame, k: int = 3, restarts: int = 10, seed: int = 42,
                 max_iter: int = 300) -> DataFrame:
    """Fit K-means ``restarts`` times, keep the lowest training cost, label
    clusters by centre price. Fewer than k usable rows: the rows come back
    without clusters. Every row goes to its nearest centre in a projection."""
    rows = model_rows(df)
    centers = kmeans_centers(rows, k, restarts, seed, max_iter)[0] if rows.limit(k).count() >= k else []
    if not centers:
        return rows.withColumn("cluster", F.lit(None).cast("int")).withColumn("cluster_label", F.lit(None).cast("string"))
    return assign_centers(rows, centers)


def lloyd_tiers(df: DataFrame, centers: Sequence[tuple], steps: int) -> DataFrame:
    """``steps`` rounds of Lloyd's iteration from given centres: rows go to the
    nearest centre, centres to the mean of their rows (one without rows stays).
    Each round is one aggregate with a row per centre."""
    rows = model_rows(df)
    for _ in range(steps):
        means = (assign_centers(rows, centers).groupBy("cluster")
                 .agg(F.avg("price").alias("x"), F.avg("cost_per_day").alias("y")).collect())
        by = {r["cluster"]: (r["x"], r["y"]) for r in means}
        centers = [by.get(i, c) for i, c in enumerate(centers)]
    return assign_centers(rows, centers)
