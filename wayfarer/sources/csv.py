"""CSV scans and sinks.

Feeds are read with every column as text (no ``inferSchema`` second pass);
typing happens in the mapping projection. Folders and patterns are first
expanded to the files in them; the files that are not valid UTF-8 are found in
one job over all of them (line by line on the executors, only names reach the
driver) and read as Latin-1, the others as UTF-8, so no row is read twice. The
same job says which files begin with the same line, so that a header is looked
at once, however many files have it.
"""

from __future__ import annotations

import re
from decimal import Decimal
from typing import Mapping, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wayfarer.functions.numeric import to_double
from wayfarer.operators.mapping import complete_columns, empty_listings, union_frames
from wayfarer.schema import KEY_COLUMN, LISTING_COLUMNS, LISTING_SCHEMA, NUMERIC_COLUMNS

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
FILE_COLUMN = "_source_file"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, asked of the path's own file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def expand(spark: SparkSession, paths: Sequence[str] | str) -> list[str]:
    """The files behind paths, folders and patterns (any Hadoop file system), as full paths; content is not read."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in [paths] if isinstance(paths, str) else paths:
        target = jvm.org.apache.hadoop.fs.Path(p)
        fs = target.getFileSystem(conf)
        try:
            found = [fs.getFileStatus(target)] if fs.exists(target) else list(fs.globStatus(target) or [])
        except Exception as e:  # noqa: BLE001 - a pattern that the file system cannot read has no files
            raise FileNotFoundError(f"{p}: {e}") from e
        for status in found:
            inner = [status] if status.isFile() else [f for f in fs.listStatus(status.getPath()) if f.isFile()]
            out += [f.getPath().toString() for f in inner if not re.match(r"[._]", f.getPath().getName())]
    return sorted(set(out))


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """File paths directly inside ``folder`` (any Hadoop file system), content not read."""
    return expand(spark, folder)


def _same(path: str) -> str:
    """One spelling of a path: one slash after the scheme."""
    return re.sub(r"^([a-z0-9+.-]+):/+", r"\1:/", path)


def _literal(path: str) -> str:
    """A path in which no character stands for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def catalogue(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, bool, int]]:
    """(path, whether it is not valid UTF-8, a hash of its first line) of the given files that hold a line, in one job.

    Equal hashes mean equal first lines, byte by byte. A first line that may
    not be a whole header (blank, or a quoted field goes on after it) gets a
    hash of its own file. The counts of a file are of fixed width: the first
    line is the least (place in the file's first block, hash of the line).
    """
    if not paths:
        return []
    value, name = F.col("value"), F.col("f")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    whole = (F.length(F.trim(value)) > 0) & (quotes % 2 == 0)
    line = F.when(whole, F.xxhash64(value.cast("binary"))).otherwise(F.xxhash64(name, F.lit("own")))
    place = F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).cast("decimal(10,0)")          # row number in its partition
    unsigned = line.cast("decimal(19,0)") + F.lit(Decimal(1 << 63))
    first = F.when(F.col("start") == 0, (place * F.lit(Decimal(1 << 64)) + unsigned).cast("decimal(38,0)"))
    lines = (spark.read.text([_literal(p) for p in paths])
             .select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("at")))
    found = (lines.select("f", first.alias("first"), (~F.is_valid_utf8(value)).alias("bad"))
             .groupBy("f").agg(F.max("bad").alias("bad"), F.min("first").alias("first")).collect())
    spelt = {_same(p): p for p in paths}
    return sorted((spelt[_same(unquote(r.f))], bool(r.bad), int(r.first) % (1 << 64)) for r in found)


def invalid_utf8_files(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """Those of the given files that hold a line that is not valid UTF-8, found in one job."""
    if not paths:
        return set()
    lines = spark.read.text([_literal(p) for p in paths]).select(F.col("value"), F.col("_metadata.file_path").alias("f"))
    bad = {_same(unquote(r.f)) for r in lines.where(~F.is_valid_utf8(F.col("value"))).select("f").distinct().collect()}
    return {p for p in paths if _same(p) in bad}


def scan_csv(spark: SparkSession, files: Sequence[str], encoding: str | None = None, with_file_name: bool = False,
             multi_line: bool = True, corrupt_column: str | None = None) -> DataFrame:
    """All-text scan of files that share a header. Without ``multi_line`` (no field holds a line break) a large
    file is split over many tasks; with it a file is one task. ``corrupt_column`` adds a column with the whole record
    where its fields are more or fewer than the header's (every field is parsed then)."""
    r = spark.read.options(**CSV_OPTIONS).option("multiLine", str(multi_line).lower())
    if encoding:
        r = r.option("encoding", encoding)
    df = r.csv([_literal(f) for f in files])
    if corrupt_column and df.columns:
        schema = StructType([*df.schema.fields, StructField(corrupt_column, StringType())])
        df = (r.option("columnNameOfCorruptRecord", corrupt_column).option("columnPruning", "false")
              .schema(schema).csv([_literal(f) for f in files]))
    # the scan gives names percent-encoded; a plus stands for itself there
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return df.withColumn(FILE_COLUMN, name) if with_file_name else df


def read_csv_text(spark: SparkSession, paths: Sequence[str] | str, detect_encoding: bool = True,
                  with_file_name: bool = False, multi_line: bool = True, corrupt_column: str | None = None) -> DataFrame:
    """All-text CSV scan with a header; Latin-1 for files that are not UTF-8.
    ``with_file_name`` adds the file name of every row as ``_source_file``."""
    files = expand(spark, paths)
    if not files:
        raise FileNotFoundError(f"no file at {paths}")
    bad = invalid_utf8_files(spark, files) if detect_encoding else set()
    parts = [([f for f in files if f not in bad], None), ([f for f in files if f in bad], "ISO-8859-1")]
    frames = [scan_csv(spark, fs, enc, with_file_name, multi_line, corrupt_column) for fs, enc in parts if fs]
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1], allowMissingColumns=True)


def read_by_header(spark: SparkSession, files: Sequence[str], with_file_name: bool = False,
                   multi_line: bool = True, on_error=None) -> list[tuple[list[str], DataFrame]]:
    """(header, frame) for each header and encoding among the files.

    Encodings and equal first lines are found in one job (``catalogue``); each
    first line costs one look at the head of one of its files. Files without a
    readable header are left out and told to ``on_error(file, error)``.
    """
    alike: dict[tuple, list[str]] = {}
    for f, bad, line in catalogue(spark, files):
        alike.setdefault((line, "ISO-8859-1" if bad else None), []).append(f)
    groups: dict[tuple, list[str]] = {}
    for (_, enc), same in alike.items():
        try:
            header = tuple(scan_csv(spark, same[:1], enc, multi_line=multi_line).columns)
        except AnalysisException as e:
            for f in same if on_error else ():
                on_error(f, e)
            continue
        if header:
            groups.setdefault((header, enc), []).extend(same)
    return [(list(h), scan_csv(spark, fs, enc, with_file_name, multi_line)) for (h, enc), fs in groups.items()]


def read_listing_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Load ``raw_*.csv``-style listing files by column name, in any order:
    missing columns are NULL, others are left out, Latin-1 files are read as
    such, files without a header contribute no rows."""
    frames = []
    for header, df in read_by_header(spark, expand(spark, pattern)):
        known: Mapping[str, str] = {c.strip().lower(): c for c in reversed(header)}
        cols = []
        for f in LISTING_SCHEMA.fields:
            c = F.col(f"`{known[f.name]}`") if f.name in known else F.lit(None).cast("string")
            cols.append((to_double(c) if f.name in NUMERIC_COLUMNS and f.name in known else c.cast(f.dataType)).alias(f.name))
        frames.append(df.select(*cols))
    return union_frames(frames, spark) if frames else empty_listings(spark)


def write_listings(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                   partition_by: Sequence[str] = ()) -> None:
    """Fixed-column sink: missing listing columns added, order fixed, extra
    columns (key, scores) kept after them. CSV output carries a header even
    when empty."""
    out = complete_columns(df, LISTING_COLUMNS)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def write_stage(df: DataFrame, path: str, mode: str = "overwrite", row_group_bytes: int = 32 << 20) -> None:
    """Listing table laid out for the explorer's filters: files hold ranges of (source, price, rating), with a bloom
    filter on location, so that a scan skips row groups by the statistics of those columns.

    Price and rating are interleaved (``explore_key``), so either filter alone skips too. The ranges are cut by Spark's
    sampled bounds: a source with a large share of all rows spreads over many files, small sources share one.
    """
    order = ["source", "_x", KEY_COLUMN] if KEY_COLUMN in df.columns else ["source", "_x"]
    laid = df.withColumn("_x", explore_key()).repartitionByRange(*order).sortWithinPartitions(*order).drop("_x")
    (laid.write.mode(mode).option("parquet.block.size", str(row_group_bytes))
     .option("parquet.bloom.filter.enabled#location", "true").parquet(path))


def explore_key(price: str = "price", rating: str = "rating", bits: int = 8) -> Column:
    """Cells of price (by its logarithm, 16 a doubling) and rating (51 a point, 0 to 5) with their bits interleaved; a
    missing value has cell 0. A rule of the row alone, so that later writes fit the same layout."""
    top = (1 << bits) - 1
    cell = lambda c: F.coalesce(F.least(F.greatest(F.floor(c), F.lit(0)), F.lit(top)), F.lit(0)).cast("long")
    p, r = cell(F.log2(F.greatest(F.col(price), F.lit(0.0)) + 1.0) * 16), cell(F.col(rating) * (top // 5))
    key = F.lit(0).cast("long")
    for b in range(bits):
        for part, place in ((p, 2 * b + 1), (r, 2 * b)):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(part, b).bitwiseAND(F.lit(1)), place))
    return key


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Result sink for any table (CSV with header, JSON lines, or Parquet)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)
