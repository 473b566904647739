"""Incremental folder import with Structured Streaming.

Feed files dropped into a folder are picked up by a file-source stream,
mapped to the listing schema with the header aliases and labelled
``external:<file stem>`` from the file name in the source's metadata column.
Each run with ``availableNow`` processes exactly the files not yet seen (the
checkpoint records them) and stops, so re-running after new files arrive
reads only those files instead of re-reading the whole folder.

Whole-row de-duplication across runs is left to the batch step that reads
the sink (a streaming distinct without an event-time watermark would keep
unbounded state).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wayfarer.operators.mapping import map_to_listing_schema
from wayfarer.schema import DEFAULT_TYPE
from wayfarer.sources.csv import CSV_OPTIONS
from wayfarer.sources.feeds import alias_mapping, file_label


def feed_stream(spark: SparkSession, folder: str, header: Sequence[str],
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming listings from CSV files sharing ``header`` in ``folder``."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    reader = spark.readStream.options(**CSV_OPTIONS).schema(schema).option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    raw = reader.csv(folder)
    return map_to_listing_schema(raw, alias_mapping(list(header)), "", DEFAULT_TYPE, source_col=file_label(F.col("_metadata.file_name")))


def ingest_folder(spark: SparkSession, folder: str, header: Sequence[str], sink_path: str,
                  checkpoint_location: str, wait: bool = True) -> StreamingQuery:
    """Append new files' listings to a Parquet sink, then stop (availableNow)."""
    q = (feed_stream(spark, folder, header).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint_location)
         .outputMode("append").trigger(availableNow=True).start(sink_path))
    if wait:
        q.awaitTermination()
    return q
