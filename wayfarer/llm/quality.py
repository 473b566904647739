"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

A token is a run of ASCII letters and digits and of non-ASCII bytes, or a run
of other printing characters, in lower case. Features are hashed tokens, hashed
pairs of neighbours, and one feature for a token that repeats the one before;
values are square roots of counts, over the square root of their sum. The
updates of follow-the-regularised-leader (proximal, per-coordinate rates) run
over a bounded sample of labelled rows in one task; a score is the sparse dot
product of a text's features with the weights, through the logistic function.

A null text scores as an empty one: by the bias alone. Labelled rows with a null
label, or without a document, are not learnt from. With no labelled row at all
every score is 0.5. Repeated rows count as often as they occur.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.llm.common import map_texts, text_bytes

#: Hashed features; the model has one more weight, the bias.
BITS = 18
#: Labelled rows that the fit reads at most, about; it passes over them ``EPOCHS`` times.
SAMPLE, EPOCHS = 8_192, 4
#: alpha, beta, l1, l2 of the updates.
RATE, SMOOTH, L1, L2 = 0.3, 1.0, 0.02, 0.5

_TOKEN = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff\x00-\x20]+")


def features(text: bytes | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted feature numbers, values) of a text."""
    words = _TOKEN.findall(text.lower()) if text else []
    if not words:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.float32)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + (h[1:] ^ np.uint64(77))
    pairs[h[1:] == h[:-1]] = 1
    g = np.concatenate([h, pairs])
    g = (g ^ (g >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    at, n = np.unique(((g ^ (g >> np.uint64(32))) & np.uint64((1 << bits) - 1)).astype(np.int32), return_counts=True)
    return at, np.sqrt(n / n.sum()).astype(np.float32)


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights that the leader has for the sums ``z`` and ``n`` of gradients and their squares."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((SMOOTH + np.sqrt(n)) / RATE + L2))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int, epochs: int) -> np.ndarray:
    """Weights (features and bias) after passing over the rows in a shuffled order each time."""
    bias = 1 << bits
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)
    rows = [(np.append(at, bias), np.append(v, np.float32(1))) for at, v in rows]
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            at, v = rows[k]
            zi, ni = z[at], n[at]
            w = weights_of(zi, ni)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ v, -35, 35)))
            g = (p - labels[k]) * v
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / RATE
            z[at] = zi + g - step * w
            n[at] = ni + g * g
    return weights_of(z, n).astype(np.float32)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", sample: int = SAMPLE, epochs: int = EPOCHS, bits: int = BITS) -> np.ndarray:
    """Weights from the labelled rows whose hashed id falls below the bound's share of them."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    total = known.count()
    if not total:
        return np.zeros((1 << bits) + 1, dtype=np.float32)
    if total > sample:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * sample / total))

    def extract(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                rows = [features(t, bits) for t in text_bytes(part.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("hash"), part.column("label"), pa.array([a.tobytes() for a, _ in rows], pa.binary()),
                     pa.array([v.tobytes() for _, v in rows], pa.binary())], names=["hash", "label", "at", "value"])

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("hash", "ascending"), ("at", "ascending"), ("label", "ascending")])
        rows = [(np.frombuffer(a, dtype=np.int32), np.frombuffer(v, dtype=np.float32))
                for a, v in zip(table["at"].to_pylist(), table["value"].to_pylist())]
        w = ftrl(rows, np.asarray(table["label"], dtype=np.float64), bits, epochs)
        return pa.table({"weights": pa.array([w.tobytes()], pa.binary())})

    # the sampled labels are bounded by the parameter, so the texts meet them where they are read; of rows with one id
    # the text with the smallest hash is learnt from, once for each of its labels
    sampled = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(known.distinct()), "id")
    first = F.row_number().over(Window.partitionBy("id", "label").orderBy(F.xxhash64("text"), "text"))
    sampled = sampled.withColumn("first", first).where(F.col("first") == 1)
    found = (map_texts(sampled.select(F.xxhash64("id").alias("hash"), "label", "text"), extract,
                       "hash long, label int, at binary, value binary")
             .groupBy(F.lit(0).alias("all")).applyInArrow(fit, "weights binary").collect())
    return np.frombuffer(found[0]["weights"], dtype=np.float32).copy() if found else np.zeros((1 << bits) + 1, dtype=np.float32)


def _scores(texts: list, weights: np.ndarray, bits: int) -> np.ndarray:
    bias = weights[-1]
    out = np.empty(len(texts))
    for i, t in enumerate(texts):
        at, v = features(t, bits)
        out[i] = weights[at] @ v + bias
    return 1.0 / (1.0 + np.exp(-np.clip(out, -35, 35)))


def score_quality(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
                  bits: int = BITS) -> DataFrame:
    """(id, score) for every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2^bits + 1 numbers

    def score(batches):
        for b in batches:
            s = _scores(text_bytes(b.column("text")), shared.value, bits)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(s, pa.float64())], names=["id", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    return map_texts(rows, score, f"id {kind}, score double")


def keep_quality(docs: DataFrame, weights: np.ndarray, text_col: str = "text", least: float = 0.3, bits: int = BITS) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def keep(batches):
        for b in batches:
            s = _scores(text_bytes(b.column(text_col)), shared.value, bits)
            yield b.filter(pa.array(s >= least))

    return map_texts(docs, keep, docs.schema)
