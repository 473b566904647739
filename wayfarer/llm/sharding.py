"""Longest-processing-time sharding of groups that must stay together.

Rows with equal text are one group (a null text counts as empty). Group sizes
are summed before the shuffle. Groups that are large against a shard are
scheduled one by one; there can only be as many as shards times ``GRAIN``, by
their size. All smaller groups are first dealt by hash into bundles of about
that same size, and each bundle is scheduled as one unit, so the heap sees a
bounded number of units however many groups there are: sorted by size, each
goes to the least-loaded shard. Every row then finds its shard from its group.

Numbers within a shard are gapless: rows are dealt by hash of their id into
small buckets, the counts of the buckets (a bounded table) give each its start,
and a window numbers the rows of a bucket.

Repeated rows count and are placed once each. An empty table gives an empty
result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.llm.common import stored

#: A unit of the schedule is about this fraction of a shard: 1 / GRAIN.
GRAIN = 256
#: Rows of a shard that one task numbers.
BUCKET_ROWS = 20_000


def longest_first(units: list[tuple], shards: int) -> dict:
    """{unit: shard} for (unit, size) pairs; larger first, ties by unit; the least-loaded shard takes each."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for unit, size in sorted(units, key=lambda u: (-u[1], u[0])):
        load, shard = heap[0]
        out[unit] = shard
        heapq.heapreplace(heap, (load + size, shard))
    return out


def sharded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16, grain: int = GRAIN) -> DataFrame:
    """(doc_id, size, text_crc32, group, shard, slot) for every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    raw = F.encode(text, "UTF-8")
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                              F.crc32(raw).alias("text_crc32"), F.md5(raw).alias("group")), "op6-rows")
    groups = stored(rows.groupBy("group").agg(F.sum("size").alias("size")), "op6-groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    unit = max(1, total // (shards * grain))
    bundles = shards * grain
    bundle = F.pmod(F.xxhash64("group"), F.lit(bundles)).cast("string")
    # at most shards * grain groups reach the unit, and there are as many bundles
    units = groups.withColumn("unit", F.when(F.col("size") >= unit, F.col("group")).otherwise(bundle))
    table = units.groupBy("unit").agg(F.sum("size").alias("size")).collect()
    plan = longest_first([(r["unit"], r["size"]) for r in table], shards)
    spark = docs.sparkSession
    homes = spark.createDataFrame(list(plan.items()), "unit string, shard int")
    placed_groups = units.join(F.broadcast(homes), "unit").select("group", "shard")
    placed = rows.join(placed_groups, "group")
    buckets = max(1, -(-rows.count() // (shards * BUCKET_ROWS)) * 2)
    at = stored(placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "group"), F.lit(buckets)).cast("int")), "op6-placed")
    starts = at.groupBy("shard", "bucket").agg(F.count("*").alias("c"))
    starts = starts.withColumn("start", F.sum("c").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("c")).drop("c")
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "group")
    return (at.withColumn("k", F.row_number().over(inside) - 1).join(starts, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", "group", "shard", (F.col("start") + F.col("k")).cast("long").alias("slot")))
