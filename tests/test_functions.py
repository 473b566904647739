"""Column functions against plain-Python statements of the same rules."""

import math
import re

import pandas as pd
from pyspark.sql import functions as F

from wayfarer.functions import format_price, parse_duration, parse_price, strip, to_double
from wayfarer.functions.text import clean_review, null_if_na_token
from wayfarer.schema import NA_TOKENS


def py_price(raw):
    if raw is None:
        return None
    text = str(raw).replace(",", " ").replace(" ", " ")
    m = re.findall(r"[0-9]+(?:[.,][0-9]+)?", text)
    return float(m[0].replace(",", ".")) if m else None


def py_duration(raw):
    if raw is None:
        return None
    text = str(raw).lower().strip()
    m = re.findall(r"[0-9]+(?:[.,][0-9]+)?", text)
    if not m:
        return None
    v = float(m[0].replace(",", "."))
    if "week" in text:
        return round(v * 7, 2)
    if "hour" in text or "hr" in text or text[-1:] == "h":
        return round(v / 24.0, 2)
    return round(v, 2)


PRICES = ["$1,250 / night", "12,50", "-5", "1e-05", "1.250,00", "abc", None, "€ 99.90", "1 250", "", "  7  "]
DURATIONS = ["7 days", "2 weeks", "48h", "36 hours", "1 month", "3 nights", "", None, "2,5 days", "12 hr", "5"]


def test_parse_price_text(spark):
    df = spark.createDataFrame([(p,) for p in PRICES], "raw string")
    got = [r.p for r in df.select(parse_price("raw").alias("p")).collect()]
    assert got == [py_price(p) for p in PRICES]
    assert got[0] == 1.0          # thousands separator splits the number
    assert got[2] == 5.0          # sign dropped


def test_parse_price_numeric(spark):
    vals = [120.0, -5.0, 1e-05, 2.5e-05, 1e16, 0.0, 123.456, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(v,) for v in vals], "raw double")
    got = [r.p for r in df.select(parse_price("raw", df.schema["raw"].dataType).alias("p")).collect()]
    want = [py_price(v) if v is not None and not (isinstance(v, float) and (math.isnan(v) or math.isinf(v)))
            else None for v in vals]
    assert got == want


def test_parse_duration_text(spark):
    df = spark.createDataFrame([(d,) for d in DURATIONS], "raw string")
    got = [r.d for r in df.select(parse_duration("raw").alias("d")).collect()]
    assert got == [py_duration(d) for d in DURATIONS]
    assert got[4] == 0.04         # '1 month' ends in h


def test_to_double_matches_pandas(spark):
    texts = ["1,250", " 120 ", "inf", "-Infinity", "0x10", "1d", "5f", "1_000", "3.5e2", ".5", "nan", "abc", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.v for r in df.select(to_double("t").alias("v")).collect()]
    want = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce").tolist()
    for g, w in zip(got, want):
        if w is None or (isinstance(w, float) and math.isnan(w)):
            assert g is None
        else:
            assert g == w


def test_strip_matches_python(spark):
    samples = ["  a  ", "\ta b\n", " x ", " y　", "plain", "", None]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r.v for r in df.select(strip("s").alias("v")).collect()]
    assert got == [s.strip() if s is not None else None for s in samples]


def test_na_tokens_and_review(spark):
    rows = [(t,) for t in NA_TOKENS] + [("Paris",), ("none",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r.v for r in df.select(null_if_na_token(F.col("s")).alias("v")).collect()]
    assert got[: len(NA_TOKENS)] == [None] * len(NA_TOKENS)
    assert got[-2:] == ["Paris", "none"]
    rv = spark.createDataFrame([("  ",), ("NaN",), (" great ",), (None,)], "s string")
    assert [r.v for r in rv.select(clean_review("s").alias("v")).collect()] == [None, None, "great", None]


def test_format_price(spark):
    vals = [1234567.891, -1234.5, 2.675, None, float("nan"), float("inf"), 0.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r.f for r in df.select(format_price("v", "EUR").alias("f")).collect()]
    assert got == ["€1,234,567.89", "€-1,234.50", "€2.67", "—", "—", "€inf", "€0.00"]
    other = df.select(format_price("v", "xyz").alias("f")).first().f
    assert other == "XYZ 1,234,567.89"
