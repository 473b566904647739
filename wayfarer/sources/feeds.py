"""Feed imports: spec-driven sources, header-alias folder import, external job.

A failing source (missing file, unreadable header) is skipped and reported;
the other sources still load. All mapping happens inside one lazy plan per
source; the union is one plan over all of them.
"""

from __future__ import annotations

import logging
from typing import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfarer.operators.mapping import map_to_listing_schema, union_frames
from wayfarer.schema import DEFAULT_TYPE, HEADER_ALIASES, SourceSpec
from wayfarer.sources.csv import FILE_COLUMN, list_files, path_exists, read_by_header, read_csv_text

log = logging.getLogger(__name__)

CORRUPT = "_malformed"
REPORT_COUNTS = ["n_rows", "n_malformed", "n_without_name", "n_without_price"]
#: No file at the path, or one whose header Spark cannot read; other errors (permissions, connections) are raised.
UNREADABLE = (FileNotFoundError, AnalysisException)


def import_frames(pairs: Iterable[tuple[DataFrame, SourceSpec]]) -> DataFrame:
    """Map already-loaded frames with their specs and union them."""
    mapped = []
    spark = None
    for df, spec in pairs:
        spark = df.sparkSession
        mapped.append(map_to_listing_schema(df, spec.mapping, spec.name, spec.default_type))
    return union_frames(mapped, spark)


def import_sources(spark: SparkSession, specs: Sequence[SourceSpec]) -> DataFrame:
    """Read each spec's CSV (all-text columns), map it, union the results."""
    frames = []
    for spec in specs:
        try:
            raw = read_csv_text(spark, spec.path)
            frames.append(map_to_listing_schema(raw, spec.mapping, spec.name, spec.default_type))
        except UNREADABLE as exc:    # one bad feed must not stop the others
            log.warning("import failed for %s: %s", spec.name, exc)
    return union_frames(frames, spark)


def import_report(spark: SparkSession, specs: Sequence[SourceSpec]) -> DataFrame:
    """One row per source: what an import of it reads and what it would lose.

    Columns: source, state ('read', 'missing', 'no header'), error (text, else
    NULL), n_rows, n_malformed (records with more or fewer fields than the
    header, whose cells an import fills with NULL or leaves out),
    n_without_name, n_without_price (rows that the clean stage will drop). Every
    source is read once; only its counts are shuffled.
    """
    frames, lost = [], []
    for spec in specs:
        try:
            raw = read_csv_text(spark, spec.path, corrupt_column=CORRUPT)
        except UNREADABLE as exc:
            lost.append((spec.name, "missing", str(exc).splitlines()[0]))
            continue
        if set(raw.columns) <= {CORRUPT}:
            lost.append((spec.name, "no header", None))
            continue
        mapped = map_to_listing_schema(raw, spec.mapping, spec.name, spec.default_type, keep=[CORRUPT])
        frames.append((spec.name, mapped.select("name", "price", CORRUPT)))
    out = spark.createDataFrame(lost, "source string, state string, error string").select(
        "*", *[F.lit(0).cast("long").alias(c) for c in REPORT_COUNTS])
    for name, df in frames:
        seen = F.col(CORRUPT).isNotNull(), F.coalesce(F.col("name"), F.lit("")) == "", F.col("price").isNull()
        counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(n) for c, n in zip(seen, REPORT_COUNTS[1:])])
        out = out.unionByName(counted.select(F.lit(name).alias("source"), F.lit("read").alias("state"),
                                             F.lit(None).cast("string").alias("error"), *REPORT_COUNTS))
    return out


def alias_mapping(columns: Sequence[str], aliases: Mapping[str, Sequence[str]] = HEADER_ALIASES) -> dict:
    """Target -> first existing header among the aliases (case-insensitive)."""
    lower = {}
    for c in columns:
        lower.setdefault(str(c).lower(), c)
    mapping = {}
    for target, cands in aliases.items():
        for cand in cands:
            if cand in lower:
                mapping[target] = lower[cand]
                break
    return mapping


def header_alias_import(df: DataFrame, label: str, default_type: str = DEFAULT_TYPE) -> DataFrame:
    """Map a frame whose headers follow common naming conventions."""
    return map_to_listing_schema(df, alias_mapping(df.columns), label, default_type)


def load_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``*.csv`` in a folder, mapped by header aliases, labelled
    ``external:<file stem>``. Files sharing a header are read in one scan and
    labelled per row from the file name in the scan's metadata column."""
    files = [f for f in list_files(spark, folder) if f.lower().endswith(".csv")]
    frames = []
    for header, raw in read_by_header(spark, files, with_file_name=True,
                                      on_error=lambda f, e: log.warning("skipping %s: %s", f, e)):
        frames.append(map_to_listing_schema(raw, alias_mapping(header), "", DEFAULT_TYPE,
                                            source_col=file_label(F.col(FILE_COLUMN))))
    return union_frames(frames, spark)


def file_label(file_name: Column, prefix: str = "external:") -> Column:
    """``<prefix><file name without its last extension>``."""
    return F.concat(F.lit(prefix), F.regexp_replace(file_name, r"\.[^.]*$", ""))


def external_import(spark: SparkSession, specs: Sequence[SourceSpec] = (), folder: str | None = None,
                    frames: Iterable[DataFrame] = ()) -> DataFrame:
    """Spec sources plus folder files (plus given frames), whole-row distinct."""
    parts = [import_sources(spark, specs)] if specs else []
    if folder and path_exists(spark, folder):
        parts.append(load_folder(spark, folder))
    parts.extend(frames)
    return union_frames(parts, spark).dropDuplicates()
