"""Mixing sources to target weights by weighted fair queueing.

Every document gets a place in its source by a hash of its id, and as
virtual finish time the source's words up to its end divided by the source's
target. A source whose target is larger than itself is queued several times
over, pass after pass. The queue of all sources is range-sorted by finish time
and cut where its words reach the budget.

Targets share the budget by weight; none may exceed ``passes`` times its
source, and what is cut off is shared among the others by weight until all fit.

Both sums over an order (words within the sources, words of the queue) run as a
range sort, written once, with the sorted partitions' totals added up; a source
that holds a third of all rows is spread over as many partitions as its rows
need. Nulls: a null text has no words and is never taken; a null source is a
source of its own, last in order; a null id hashes like an empty one. Repeated
ids come in the order of their texts' hashes, so a rerun mixes the same however
the rows are partitioned; rows alike in id and text are interchangeable, and
each is a document of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.llm.common import FEW_ROWS, WORD_PATTERN, running_total, stored, with_row_id
from wayfarer.session import keep, scratch_scope


def targets(sources: DataFrame, weights: tuple = (1, 2, 3), passes: int = 3) -> DataFrame:
    """(source, source_size, place, target) of (source, source_size), the whole of all sizes shared out.

    With sources in the order of size over weight, the ones that meet their
    limit come first: of the k-th the share by weight of what the earlier left
    tells whether it does.
    """
    total = F.sum("source_size").over(Window.partitionBy())
    order = Window.partitionBy().orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = (sources.withColumn("place", F.row_number().over(order) - 1)
         .withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
         .withColumn("limit", F.col("source_size") * passes).withColumn("total", total))
    by = Window.partitionBy().orderBy(F.col("limit") / F.col("weight"), "place")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("taken", F.coalesce(F.sum("limit").over(before), F.lit(0)))
         .withColumn("left_weight", F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("rate", (F.col("total") - F.col("taken")) / F.col("left_weight"))
         .withColumn("met", F.col("limit") <= F.col("rate") * F.col("weight")))
    level = F.min(F.when(~F.col("met"), F.struct("limit_rank", "rate"))).over(Window.partitionBy())["rate"]
    s = s.withColumn("limit_rank", F.row_number().over(by)).withColumn("level", level)
    return s.select("source", "source_size", "place",
                    F.when(F.col("level").isNull(), F.col("limit").cast("double"))
                    .otherwise(F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight"))).alias("target"))


def _sized(docs: DataFrame, row_id, doc_id, text, source):
    """The columns that ``mixed_rows`` needs: row_id, doc_id, source, size (words), shuffle (60 bits of the id's md5), tie (of the text)."""
    words = F.regexp_count(text, F.lit(WORD_PATTERN))
    shuffle = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")
    return docs.select(row_id.alias("row_id"), doc_id.alias("doc_id"), source.alias("source"),
                       F.coalesce(words, F.lit(0)).cast("long").alias("size"), shuffle.alias("shuffle"), F.xxhash64(text).alias("tie"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple = (1, 2, 3), passes: int = 3, budget: int | None = None) -> DataFrame:
    """(row_id, doc_id, source, size, source_size, target, times, taken): ``times`` a document stands in the mix.

    ``budget``: words of the mix; all words of the sources if None. Target
    weights share the size of all sources, so a smaller budget cuts every
    source alike.
    """
    rows = _sized(docs, F.monotonically_increasing_id(), F.col(id_col), F.col(text_col).cast("string"),
                  F.col(source_col).cast("string"))
    return mixed_rows(stored(rows, "op7-rows"), weights, passes, budget)


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple = (1, 2, 3), passes: int = 3, budget: int | None = None, scanned: bool = False) -> DataFrame:
    """The mix itself: rows of ``docs``, all columns, as often as they stand in it.

    Documents without words take no room and stay, once each. ``scanned``:
    ``docs`` is read straight from files.
    """
    kept = with_row_id(docs, "op7-docs", scanned)
    row = F.col("row")
    rows = _sized(kept, F.col("row_id"), row[id_col], row[text_col].cast("string"), row[source_col].cast("string"))
    with scratch_scope(docs.sparkSession) as scope:
        plan = mixed_rows(stored(rows, "op7-rows"), weights, passes, budget)
        times = plan.select("row_id", F.when(F.col("size") == 0, 1).otherwise(F.col("times")).alias("times"))
        times = keep(stored(times.where("times > 0"), "op7-times"), scope)
    if times.count() <= FEW_ROWS:
        times = F.broadcast(times)
    return (kept.join(times, "row_id")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("turn")).select("row.*"))


def mixed_rows(rows: DataFrame, weights: tuple = (1, 2, 3), passes: int = 3, budget: int | None = None) -> DataFrame:
    """``mixed`` for a stored table (row_id, doc_id, source, size, shuffle, tie)."""
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stored(targets(by_source, weights, passes), "op7-targets")
    # the sources are few rows against the documents; the engine broadcasts them below its own limit
    known = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).select(
        "row_id", "doc_id", rows["source"], "size", "shuffle", "tie", "source_size", "place", "target")
    queued = running_total(known, ["place", "shuffle", "tie", "row_id"], "size", "op7-sources")
    first = (plan.withColumn("first", F.sum("source_size").over(Window.partitionBy().orderBy("place")) - F.col("source_size"))
             .select("place", "first"))
    inside = queued.join(first, "place").withColumn("end", F.col("before") - F.col("first") + F.col("size")).drop("before")
    finish = (F.col("end") + F.col("pass") * F.col("source_size")) / F.col("target")
    # a document stands in the queue once for each pass that its source's target can reach
    reach = F.least(F.lit(passes - 1), F.floor(F.col("target") / F.col("source_size")).cast("int"))
    turns = (inside.where("size > 0 and target > 0")
             .select("row_id", "size", "end", "source_size", "target", "place",
                     F.explode(F.sequence(F.lit(0), reach)).alias("pass"))
             .select("row_id", "size", finish.alias("finish"), "place"))
    queue = running_total(turns, ["finish", "place", "row_id"], "size", "op7-queue")
    if budget is None:
        budget = plan.agg(F.sum("source_size")).first()[0] or 0
    times = (queue.where(F.col("before") + F.col("size") <= budget).groupBy("row_id")
             .agg(F.count("*").alias("times")))
    return (known.join(times, "row_id", "left")
            .select("row_id", "doc_id", "source", "size", "source_size", "target",
                    F.coalesce("times", F.lit(0)).alias("times"),
                    (F.coalesce("times", F.lit(0)) * F.col("size")).cast("long").alias("taken")))
