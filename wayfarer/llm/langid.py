"""Language identification with a string kernel, Nyström landmarks and kernel ridge regression.

The blended-spectrum presence kernel of two texts counts the character n-grams
of length 1 to 3 that both contain, over the geometric mean of how many each
contains; n-grams are those of the lower-cased text, hashed into ``DIM``
places. Some sampled texts of each language are landmarks; a text's kernels
with them, times the inverse square root of the landmarks' own kernel matrix,
are its coordinates, and ridge regression on these learns one target per
language, that language against the rest. As the kernel is an inner product of
presence vectors, landmarks and regression fold into one matrix, and a batch of
texts is scored by one product of its presence matrix with it.

Null texts and texts without any letter are ``und`` with score 0. Rows with a
null language are not learnt from; with none left to learn from every text is
``und``. Every language is learnt, however many there are: they share a fixed
number of sampled rows and of landmarks. Rows alike in id, text and language are
learnt from once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import map_texts

#: Places of the hashed n-grams, and the longest n-gram.
DIM, LONGEST = 1 << 15, 3
#: Rows of each language that the fit reads at most, about, and how many of them are landmarks; and what all languages share.
SAMPLE, LANDMARKS = 1_024, 64
ALL_ROWS, ALL_LANDMARKS = 32_768, 2_048
#: Weight of the ridge.
RIDGE = 0.1
#: A text is in no learnt language if its best score is below ``LEAST`` and less than ``KNOWN`` of its n-grams stand in
#: any landmark. A score of 0.5 is what a text without a known n-gram gets.
LEAST, KNOWN = 0.55, 0.6

_LETTER = regex.compile(r"\p{L}")
UNDETERMINED = "und"


@dataclass
class LanguageModel:
    """``matrix``: presence places x languages."""

    languages: list[str]
    matrix: np.ndarray


def presence(text: str, out: np.ndarray) -> None:
    """Mark the n-grams of a text in a row of DIM places."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    shift = np.uint32(32 - (DIM.bit_length() - 1))
    h = np.zeros(len(c), dtype=np.uint32)
    for n in range(1, LONGEST + 1):
        if len(c) < n:
            break
        h = h[:len(c) - n + 1] * np.uint32(0x01000193) + c[n - 1:] + np.uint32(n)
        out[(h * np.uint32(0x9E3779B1)) >> shift] = 1


def presence_rows(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), DIM), dtype=np.float32)
    for row, t in zip(out, texts):
        presence(t, row)
    return out


def _normed(p: np.ndarray) -> np.ndarray:
    return p / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))


def ridge_matrix(bits: np.ndarray, language: np.ndarray, count: int, landmarks: int, ridge: float) -> np.ndarray:
    """The folded matrix (places, languages) from packed presence rows and their language numbers."""
    rows = lambda i: _normed(np.unpackbits(bits[i], axis=1, bitorder="little").astype(np.float32))
    rank = np.empty(len(language), np.int64)  # a row's place among its language's rows
    by = np.argsort(language, kind="stable")
    rank[by] = np.arange(len(by)) - np.searchsorted(language[by], language[by])
    chosen = np.lexsort((language, rank))
    chosen = np.sort(chosen[rank[chosen] < landmarks][:max(ALL_LANDMARKS, 1)])
    marks = rows(chosen)
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = value > 1e-6 * value.max()
    half = vector[:, good] / np.sqrt(value[good])
    zz, zy = ridge * np.eye(half.shape[1]), np.zeros((half.shape[1], count))
    for i in range(0, len(bits), 256):
        z = (rows(slice(i, i + 256)) @ marks.T).astype(np.float64) @ half
        zz += z.T @ z
        zy += z.T @ np.where(language[i:i + 256, None] == np.arange(count), 1.0, -1.0)
    w = np.linalg.solve(zz, zy)
    return (marks.T.astype(np.float64) @ (half @ w)).astype(np.float32)


def fit_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
    """Learn from the rows of each language whose hashed id and text fall below the bound's share of them."""
    rows = (docs.select(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("hash"),
                        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
            .where("text is not null and lang is not null"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros((DIM, 0), dtype=np.float32))
    number = F.create_map(*[x for k, v in enumerate(languages) for x in (F.lit(v), F.lit(k))])
    sample = max(1, min(sample, ALL_ROWS // len(languages)))
    share = F.array(*[F.lit(max(1, int((1 << 30) * min(1.0, sample / sizes[v])))) for v in languages])
    few = (rows.withColumn("k", number[F.col("lang")])
           .where(F.pmod("hash", F.lit(1 << 30)) < F.element_at(share, F.col("k") + 1)).select("hash", "k", "text").distinct())

    def extract(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                p = np.packbits(presence_rows(part.column("text").to_pylist()).astype(np.uint8), axis=1, bitorder="little")
                yield pa.RecordBatch.from_arrays(
                    [part.column("hash"), part.column("k"), pa.array([r.tobytes() for r in p], pa.binary())],
                    names=["hash", "k", "bits"])

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("hash", "ascending"), ("k", "ascending")])
        bits = np.frombuffer(b"".join(table["bits"].to_pylist()), dtype=np.uint8).reshape(table.num_rows, -1)
        m = ridge_matrix(bits, np.asarray(table["k"]), len(languages), landmarks, ridge)
        return pa.table({"matrix": pa.array([m.tobytes()], pa.binary())})

    found = (map_texts(few, extract, "hash long, k int, bits binary")
             .groupBy(F.lit(0).alias("all")).applyInArrow(fit, "matrix binary").collect())
    if not found:
        return LanguageModel([], np.zeros((DIM, 0), dtype=np.float32))
    return LanguageModel(languages, np.frombuffer(found[0]["matrix"], dtype=np.float32).reshape(DIM, -1).copy())


def _predict(texts: list, model: LanguageModel) -> tuple[list[str], np.ndarray]:
    names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    told = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)] if model.languages else []
    for s in range(0, len(told), 256):
        part = told[s:s + 256]
        p = presence_rows([texts[i] for i in part])
        out = (p @ model.matrix) / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))
        best = out.argmax(axis=1)
        for i, k in zip(part, best):
            names[i] = model.languages[k]
        scores[part] = np.clip((out[np.arange(len(part)), best] + 1) / 2, 0, 1)
    return names, scores


def identify_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # places x languages, both bounded

    def tell(batches):
        for b in batches:
            names, scores = _predict(b.column("text").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["id", "lang_pred", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    return map_texts(rows, tell, f"id {kind}, lang_pred string, score double")


def _told(texts: list, model: LanguageModel, known: np.ndarray, languages: list[str] | None) -> list[bool]:
    """Which texts are in a learnt language; with none learnt, and none asked for, which have a letter."""
    if not model.languages and languages is None:
        return [t is not None and _LETTER.search(t) is not None for t in texts]
    names, scores = _predict(texts, model)
    out = [n != UNDETERMINED and (languages is None or n in languages) for n in names]
    for i in np.flatnonzero(scores < LEAST):
        if out[i]:
            p = presence_rows([texts[i]])[0] > 0
            out[i] = bool((p & known).sum() >= KNOWN * p.sum())
    return out


def keep_language(docs: DataFrame, model: LanguageModel, text_col: str = "text", languages: list[str] | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, that are in a learnt language (and one of ``languages`` if given).

    A text with letters is dropped only where the classifier finds no language (``LEAST``, ``KNOWN``); a model that has
    learnt nothing drops none with letters.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        known = (shared.value.matrix != 0).any(axis=1)
        for b in batches:
            yield b.filter(pa.array(_told(b.column(text_col).to_pylist(), shared.value, known, languages), pa.bool_()))

    return map_texts(docs, keep, docs.schema)
