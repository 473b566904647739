"""Steps that both graph operators share: distinct vectors, shards, stored graphs, query slices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import stored
from wayfarer.llm.hnsw import Graph

#: Graphs are kept small enough for two tasks beside each other in an executor of 3 GB: at most this many vectors, and this
#: many bytes of them in double precision.
SHARD_ROWS, SHARD_BYTES = 131_072, 64 << 20
#: At least so many shards, so that small inputs are built in parallel too.
MIN_SHARDS = 8
#: Vectors that one task looks up in one shard.
SLICE_ROWS = 16_384
MIN_SLICES = 4
#: Vectors of a stored graph stand in rows of about so many bytes of them, in row groups of so many bytes: Spark copies
#: whole rows and reads whole row groups, several at a time.
ROW_BYTES, GROUP_BYTES = 64 << 10, 4 << 20
#: Partitions of what is asked, at least if there are four times as many as pairs of a shard and a slice.
ASK_PARTS = 1_024
#: Numbers of a matrix that are scaled at a time.
SCALED = 1 << 18

GRAPH_SCHEMA = ("shard int, n int, dim int, first int, nodes binary, weights binary, vectors binary, neighbours binary, "
                "entry int, layer_sizes array<int>, layer_widths array<int>, members binary, upper binary")


def usable(column: str):
    """True for a non-empty vector of finite, non-null components that is not all zero."""
    c = F.col(column)
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & finite & F.exists(c, lambda v: v != 0), F.lit(False))


def distinct_vectors(rows: DataFrame, name: str, *more) -> DataFrame:
    """(node, vector, members, ...): one row for each distinct vector, with the number of rows that hold it.

    However many rows share a vector, the graph sees it once; the count is
    aggregated before the shuffle.
    """
    return stored(rows.groupBy("vector").agg(F.count("*").alias("members"), *more)
                  .select(F.monotonically_increasing_id().alias("node"), "*"), name)


def plan_shards(vectors: DataFrame, slice_rows: int = SLICE_ROWS) -> tuple[int, int]:
    """(shards, slices) by the number and width of the distinct vectors."""
    r = vectors.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("d")).first()
    n, dim = r["n"], r["d"] or 1
    fit = max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * dim)))
    # a slice is no larger than a shard; a few at least keep small inputs parallel
    slices = max(-(-n // min(slice_rows, fit)), min(MIN_SLICES, -(-n // SLICE_ROWS)))
    return max(MIN_SHARDS, -(-n // fit)), max(1, slices)


def matrix(column) -> np.ndarray:
    """A column of equally long number lists as a matrix: of single precision if the column is, else of double."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    kind = np.float32 if pa.types.is_float32(column.type.value_type) else np.float64
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=kind).reshape(len(column), -1)


def build_graphs(vectors: DataFrame, shards: int, prepare, name: str, width: int = 16, ef: int = 64) -> DataFrame:
    """One graph for each (dimension, shard) group, written to the shared folder in many rows of bounded size.

    ``vectors``: node, members, vector. ``prepare`` turns the matrix of original
    vectors into the unit vectors that the graph is built on.
    """
    def build(table: pa.Table) -> pa.Table:
        nodes = np.asarray(table["node"], dtype="<i8")
        by = np.argsort(nodes, kind="stable")
        x = matrix(table["vector"])[by]
        g = Graph(prepare(x), width=width, ef=ef)
        return graph_rows(table["shard"][0].as_py(), nodes[by], np.asarray(table["members"], dtype="<i8")[by], x, g)

    cut = vectors.select("node", "members", F.col("vector"), F.size("vector").alias("dim"),
                         F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"))
    return stored(cut.groupBy("dim", "shard").applyInArrow(build, GRAPH_SCHEMA), name, **{"parquet.block.size": GROUP_BYTES})


_ARROW = pa.schema([("shard", pa.int32()), ("n", pa.int32()), ("dim", pa.int32()), ("first", pa.int32()),
                    ("nodes", pa.binary()), ("weights", pa.binary()), ("vectors", pa.binary()), ("neighbours", pa.binary()),
                    ("entry", pa.int32()), ("layer_sizes", pa.list_(pa.int32())), ("layer_widths", pa.list_(pa.int32())),
                    ("members", pa.binary()), ("upper", pa.binary())])


def graph_rows(shard: int, nodes: np.ndarray, weights: np.ndarray, x: np.ndarray, g: Graph) -> pa.Table:
    """A graph as rows of some nodes each, with their vectors and neighbours of layer 0; the first row has the layers
    above, which are a fifteenth of the nodes."""
    n, dim = x.shape
    p = g.packed()
    base = np.frombuffer(p["neighbours"], dtype="<i4", count=n * p["layer_widths"][0]).reshape(n, -1)
    size = max(1, ROW_BYTES // (x.itemsize * dim))
    batches = []
    for i in range(0, n, size):
        at = slice(i, i + size)
        row = {"shard": shard, "n": n, "dim": dim, "first": i, "nodes": nodes[at].astype("<i8").tobytes(),
               "weights": weights[at].astype("<i8").tobytes(), "vectors": x[at].astype(f"<f{x.itemsize}").tobytes(),
               "neighbours": base[at].tobytes()}
        if not i:
            row |= {"entry": int(p["entry"]), "layer_sizes": p["layer_sizes"], "layer_widths": p["layer_widths"],
                    "members": p["members"][4 * n:], "upper": p["neighbours"][base.nbytes:]}
        batches.append(pa.RecordBatch.from_pylist([row], schema=_ARROW))
    return pa.Table.from_batches(batches)


class Shard:
    """A stored graph, read back in a task."""

    def __init__(self, table: pa.Table, prepare):
        first = np.asarray(table["first"])
        rows = np.argsort(first, kind="stable")
        head = table.slice(rows[0], 1).to_pylist()[0]
        n, dim = head["n"], head["dim"]
        self.nodes, self.weights = np.empty(n, dtype="<i8"), np.empty(n, dtype="<i8")
        self.x, base = None, np.empty((n, head["layer_widths"][0]), dtype="<i4")
        for k in rows.tolist():
            nodes, weights, vectors, near = (np.frombuffer(table[c][k].as_buffer(), dtype=t) for c, t in (
                ("nodes", "<i8"), ("weights", "<i8"), ("vectors", "u1"), ("neighbours", "<i4")))
            at = slice(int(first[k]), int(first[k]) + len(nodes))
            kind = f"<f{len(vectors) // (len(nodes) * dim)}"
            self.x = np.empty((n, dim), dtype=kind) if self.x is None else self.x
            self.nodes[at], self.weights[at] = nodes, weights
            self.x[at], base[at] = vectors.view(kind).reshape(-1, dim), near.reshape(-1, base.shape[1])
        self.unit = np.ascontiguousarray(prepare(self.x), dtype=np.float32)
        members = np.concatenate([np.arange(n, dtype="<i4"), np.frombuffer(head["members"], dtype="<i4")])
        near = np.concatenate([base.ravel(), np.frombuffer(head["upper"], dtype="<i4")])
        self.graph = Graph.unpacked(self.unit, head["entry"], head["layer_sizes"], head["layer_widths"], members, near)


def ask_every_shard(graphs: DataFrame, queries: DataFrame, shards: int, slices: int, work, schema: str) -> DataFrame:
    """``work(graph table, query table) -> table`` for every shard and every slice of the queries.

    ``queries`` has node and vector. A task holds one graph and one slice, both
    of bounded size; vectors are only ever looked up in shards of their dimension.
    """
    sliced = queries.select("*", F.size("vector").alias("dim"),
                            F.pmod(F.hash("node"), F.lit(slices)).alias("slice"),
                            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    copies = graphs.select("*", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    # most partitions hold one graph or none: Spark sorts them in memory, and a task with several ends late
    parts = min(4 * shards * slices, max(ASK_PARTS, int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    keys = ("dim", "shard", "slice")

    def ask(g: pa.Table, q: pa.Table) -> pa.Table:
        if not g.num_rows or not q.num_rows:
            return empty
        return work(g, q)

    empty = work(None, None)
    return (copies.repartition(parts, *keys).groupBy(*keys)
            .cogroup(sliced.repartition(parts, *keys).groupBy(*keys)).applyInArrow(ask, schema))


def lengths(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest component of every row, and the row's length once divided by it, so that no square overflows."""
    largest, length, step = np.empty(len(x)), np.empty(len(x)), max(1, SCALED // max(1, x.shape[1]))
    for i in range(0, len(x), step):
        part = x[i:i + step].astype(np.float64)
        largest[i:i + step] = np.abs(part).max(axis=1)
        part /= largest[i:i + step, None]
        length[i:i + step] = np.sqrt(np.einsum("ij,ij->i", part, part))
    return largest, length


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one; each is scaled by its largest component first, so that no square overflows."""
    if not x.size:
        return x
    largest, length = lengths(x)
    return x.astype(np.float64) / largest[:, None] / length[:, None]


def unit_singles(x: np.ndarray) -> np.ndarray:
    """``unit_rows`` in single precision, in bands."""
    out, step = np.empty(x.shape, dtype=np.float32), max(1, SCALED // max(1, x.shape[1]))
    for i in range(0, len(x), step):
        out[i:i + step] = unit_rows(x[i:i + step])
    return out
