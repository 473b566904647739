"""Price display formatting (labels only; amounts are never converted)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO 4217 code -> display prefix.
CURRENCY_SYMBOLS = {
    "USD": "$",
    "EUR": "€",
    "GBP": "£",
    "JPY": "¥",
    "CHF": "CHF ",
    "CAD": "C$",
    "AUD": "A$",
    "NZD": "NZ$",
    "DZD": "د.ج ",
    "MAD": "DH ",
    "TND": "TND ",
    "XOF": "CFA ",
}
MISSING_MARK = "—"


def currency_symbol(code: str | None = "USD") -> str:
    code = (code or "").strip().upper() or "USD"
    return CURRENCY_SYMBOLS.get(code, f"{code} ")


def format_price(c, code: str | None = "USD") -> Column:
    """symbol + thousands separators + 2 decimals; missing -> an em dash."""
    col = F.col(c) if isinstance(c, str) else c
    sym = F.lit(currency_symbol(code))
    inf = F.lit(float("inf"))
    return (F.when(col.isNull() | F.isnan(col), F.lit(MISSING_MARK))
            .when(col == inf, F.concat(sym, F.lit("inf")))
            .when(col == -inf, F.concat(sym, F.lit("-inf")))
            .otherwise(F.concat(sym, F.format_number(col, 2))))
