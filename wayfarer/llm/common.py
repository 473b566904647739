"""Helpers shared by the operators of this package.

Every operator reads only the columns it names, so further columns of the
input, whatever they are called, never reach it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.session import store

#: A word: a run of bytes other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    What is read afterwards does not depend on any executor staying alive, and
    values that a recomputation could change (row numbers, partition numbers)
    are fixed from here on. ``options`` are the Parquet writer's.
    """
    return store(df, name, **options)


#: Row numbers (with a small count each) that are broadcast at most.
FEW_ROWS = 1_000_000


#: Rows that a file may hold at most, for their numbers to follow those of the file before.
FILE_ROWS = 1 << 40


def with_row_id(df: DataFrame, name: str, scanned: bool) -> DataFrame:
    """Columns (row_id, row): every input row as one struct under a fixed, unique number.

    ``scanned`` says that ``df`` is read straight from files: a row's number is
    then made of its file's number, written once, and its own place in the file.
    Both hold however later scans cut the files into splits, which follows the
    cores alive. Any other frame is written first.
    """
    if not scanned:
        return stored(df.select(F.monotonically_increasing_id().alias("row_id"), F.struct("*").alias("row")), name)
    meta = df.metadataColumn("_metadata")
    placed = df.select(F.struct("*").alias("row"), meta["file_path"].alias("file"), meta["row_index"].alias("place"))
    files = stored(placed.select("file").distinct()
                   .select("file", (F.row_number().over(Window.orderBy("file")) - 1).cast("long").alias("number")),
                   f"{name}-files")
    # one short row a file, of which the driver holds the list already
    return (placed.join(F.broadcast(files), "file")
            .select((F.col("number") * F.lit(FILE_ROWS) + F.col("place")).alias("row_id"), "row"))


def fold_of(column: str, folds: int):
    """crc32 of the id's decimal text modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % folds


#: Texts that a Python worker gets at a time.
BATCH_ROWS = 512


def map_texts(df: DataFrame, work, schema) -> DataFrame:
    """``df.mapInArrow`` with few rows in a batch, as a row may hold a very long text.

    The setting is the session's, so later queries of the session get small batches too.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark = df.sparkSession
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(work, schema)


class Blobs:
    """Items of a binary column as arrays, without copying them."""

    def __init__(self, column: pa.Array | pa.ChunkedArray, kind: str):
        column = column.cast(pa.large_binary())
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
        _, offsets, data = column.buffers()
        self.at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
        self.data, self.kind = data if data is not None else b"", np.dtype(kind)

    def __len__(self) -> int:
        return len(self.at) - 1

    def __getitem__(self, i: int) -> np.ndarray:
        start, size = int(self.at[i]), int(self.at[i + 1] - self.at[i])
        return np.frombuffer(self.data, dtype=self.kind, count=size // self.kind.itemsize, offset=start)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list:
    """The UTF-8 bytes of a text column (None where null)."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z only) words of a text; null has none.

    ``bytes.split`` cuts at exactly the six blanks of WORD_PATTERN, and
    ``bytes.lower`` changes ASCII letters only.
    """
    return text.lower().split() if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and odd multipliers) on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def running_total(df: DataFrame, order: list[str], value: str, name: str, per_task: int = 100_000) -> DataFrame:
    """Add ``before`` (long): the sum of ``value`` over all rows that come earlier in ``order``.

    One range sort over the cluster, written once; the totals of the sorted
    partitions (one short row each) are added up in order and give every
    partition its start, and a window inside each partition does the rest. No
    task holds more than a partition or one row of each, and ``order`` should end in a unique column so that partitions
    can be cut anywhere.
    """
    spark = df.sparkSession
    rows = df.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task), 1)
    cut = stored(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), name)
    sums = cut.groupBy("_part").agg(F.sum(value).alias("_sum"))
    starts = sums.select("_part", (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_start"))
    w = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = F.sum(F.col(value)).over(w) - F.col(value)
    return (cut.withColumn("_inside", inside).join(starts, "_part")
            .withColumn("before", (F.col("_start") + F.col("_inside")).cast("long"))
            .drop("_part", "_start", "_inside"))
