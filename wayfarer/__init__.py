"""wayfarer — travel-listing analytics as composable Spark DataFrame operators.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects and is
expressed with built-in column functions, aggregations, joins and windows,
so Catalyst plans it and Tungsten runs it; no Python UDF sits in a hot path.
"""

from wayfarer.schema import LISTING_COLUMNS, LISTING_SCHEMA, SourceSpec

__all__ = ["LISTING_COLUMNS", "LISTING_SCHEMA", "SourceSpec"]
