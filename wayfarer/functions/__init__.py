"""Column-level functions (pure expressions, whole-stage-codegen friendly)."""

from wayfarer.functions.text import strip, null_if_na_token, clean_review
from wayfarer.functions.numeric import to_double, nan_to_null
from wayfarer.functions.parse import parse_price, parse_duration
from wayfarer.functions.keys import listing_key, hash_u
from wayfarer.functions.currency import format_price

__all__ = [
    "strip", "null_if_na_token", "clean_review", "to_double", "nan_to_null",
    "parse_price", "parse_duration", "listing_key", "hash_u", "format_price",
]
