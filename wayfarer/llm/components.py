"""Connected components over a link table, with links kept on the cluster.

Alternating stars: every round lets each node pass its smallest neighbour to
its larger neighbours, then to its smaller ones, until each component is one
star around its smallest node. Minima are aggregated before the shuffle, so a
node with very many links costs its task one row per map task; the join that
hands the minimum back is an ordinary shuffle join, which adaptive execution
splits where one node holds much of it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import stored


def _digest(links: DataFrame) -> tuple:
    r = links.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node long, component long) for every node of ``links``; component is the smallest node reachable.

    Nulls and loops are ignored; repeated links count once; an empty table
    gives an empty result.
    """
    cur = stored(links.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
                 .where("u is not null and v is not null and u <> v").distinct(), "links")
    seen = _digest(cur)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # now every link points from a node to a smaller one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        cur = stored(small, "links")
        now = _digest(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    stars = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of places a[i] and b[i]; ``label`` gives every place the smallest of its tree, before and after."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := label[label], label):
            label[:] = up
