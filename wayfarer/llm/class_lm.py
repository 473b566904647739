"""Class-based bigram language model with exchange clustering.

1. Word counts over all learning texts (counted inside each task first), and the
counts of neighbours (word number, word number, n) over all of them, kept as a
table. 2. The most frequent words, the core, are clustered by exchange: one task
moves word after word to the class that raises the likelihood of the class
bigrams most, until nothing moves. 3. Every other word of the dictionary is
exchanged on the cluster, round after round: its neighbours are added up by
class, sparse, and it moves to the class whose transitions give them the highest
likelihood; all words of a round move against the same table, which is counted
anew from the neighbours before the next, so that they see each other's classes.
4. The class transitions are counted from the same table.

Everything grows with the V distinct words: classes as the cube root of V, the
core as ``CORE`` words a class, the dictionary as ``DICTIONARY`` times V to the
power 0.6. Words beyond the dictionary and words that occur once form one class,
which stands for words never seen as well; the end of a text is another.

A token's probability is transition times emission. Transitions are smoothed
towards the class frequencies; an emission is a word's share of its class, and
the class of all other words keeps half a count for each and for one that was
never seen, so that the probabilities after any context add up to one.

Words are those of WORD_PATTERN with A-Z lowered; every text ends with one end
token, which counts as a token. Scoring holds only the dictionary in each task;
counts of all other words come from the full count table by a join, so no word
is dropped.

A null text is empty: it is the end token alone. With nothing to learn from,
counts are 0 and the formulas hold with them. Repeated rows count as often as
they occur.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import map_texts, stored, text_bytes, words_of

#: Words of the core for each class; classes at least; words held in each task over the distinct words to the power GROWTH.
CORE, CLASSES, DICTIONARY, GROWTH = 8, 16, 16, 0.6
#: Sweeps of the core's exchange at most, rounds of the exchange on the cluster at most, words of one of its groups.
SWEEPS, ROUNDS, GROUP_WORDS = 12, 3, 1_024
#: Weight of the class frequencies in a transition.
PRIOR = 50.0
#: Distinct words that a task counts before it hands them on; tokens whose neighbours it counts at a time.
COUNTER_WORDS, TOKENS = 1_000_000, 2_000_000

END = b""


class _Index(dict):
    """Word numbers; -1 for words that are not in it."""

    def __missing__(self, word):
        return -1


@dataclass
class ClassModel:
    """``words`` of the dictionary by falling count and their ``classes``; all other words are in ``rest``."""

    words: list[bytes]
    counts: np.ndarray
    classes: np.ndarray
    transitions: np.ndarray      # log10 P(class | class before)
    emissions: np.ndarray        # log10 P(word | class) of ``words``
    tokens: int
    distinct: int
    rest_total: float            # denominator of the emissions of all other words

    @property
    def rest(self) -> int:
        return self.transitions.shape[0] - 2

    @property
    def end(self) -> int:
        return self.transitions.shape[0] - 1


def count_words(rows: DataFrame) -> DataFrame:
    """(word binary, n): tokens of all texts of rows (text), the end token as an empty word."""
    def count(batches):
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                              names=["word", "n"])
        for b in batches:
            for t in text_bytes(b.column("text")):
                seen.update(words_of(t))
            seen[END] += b.num_rows
            if len(seen) > COUNTER_WORDS:
                yield out()
                seen.clear()
        if seen:
            yield out()

    return map_texts(rows.select("text"), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> tuple[list[bytes], np.ndarray]:
    """Words that occur more than once, by falling count (ties by word), at most ``most``.

    Levels of counts are taken whole while they fit; of the next one the first by count and word fill up.
    """
    words = counts.where((F.length("word") > 0) & (F.col("n") > 1))
    level = F.floor(F.log2(F.col("n")) * 32)
    sizes = sorted(((r["level"], r["c"]) for r in words.groupBy(level.alias("level")).agg(F.count("*").alias("c")).collect()),
                   reverse=True)
    total, low, cut = 0, math.inf, None
    for k, c in sizes:
        if total + c > most:
            cut = k
            break
        total, low = total + c, k
    taken = words.where(level >= low) if total else words.limit(0)
    if cut is not None:
        taken = taken.unionByName(words.where(level == cut).orderBy(F.col("n").desc(), "word").limit(most - total))
    table = taken.select("word", "n").toArrow()
    w, n = table["word"].to_pylist(), np.asarray(table["n"], dtype=np.int64)
    by = sorted(range(len(w)), key=lambda i: (-n[i], w[i]))
    return [bytes(w[i]) for i in by], n[by]


def exchange_classes(bigrams: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of the first V words of a (V + 2, V + 2) table of neighbour counts.

    The last two rows are fixed classes of their own (all other words, end of
    text). The likelihood of the class bigrams is the sum of n log n over class
    pairs, less that over the classes as left and as right neighbour.
    """
    v = len(bigrams) - 2
    k = classes + 2
    label = np.concatenate([np.arange(v) % max(1, min(classes, v)), [classes, classes + 1]])
    onehot = np.zeros((v + 2, k))
    onehot[np.arange(v + 2), label] = 1
    counts = bigrams.astype(np.float64)
    left, right = counts.sum(axis=1), counts.sum(axis=0)
    table = onehot.T @ counts @ onehot

    def h(x):
        return x * np.log(np.maximum(x, 1.0))   # counts are whole numbers

    for _ in range(sweeps):
        moved = 0
        for w in range(v):
            own = label[w]
            out_w = np.bincount(label, weights=counts[w], minlength=k)      # w followed by a class
            in_w = np.bincount(label, weights=counts[:, w], minlength=k)    # a class followed by w
            twice = counts[w, w]
            out_w[own] -= twice
            in_w[own] -= twice
            table[own, :] -= out_w
            table[:, own] -= in_w
            table[own, own] -= twice
            out_n, in_n = table.sum(axis=1), table.sum(axis=0)
            h_t = h(table)
            rows = h(table + out_w[None, :]) - h_t          # row c gains what follows w
            cols = h(table + in_w[:, None]) - h_t           # column c gains what precedes w
            d = np.arange(k)
            corner = table[d, d]
            gain = (rows.sum(axis=1) - rows[d, d] + cols.sum(axis=0) - cols[d, d]
                    + h(corner + out_w + in_w + twice) - h(corner)
                    - (h(out_n + left[w]) - h(out_n)) - (h(in_n + right[w]) - h(in_n)))
            gain[classes:] = -np.inf
            best = int(gain.argmax())
            if gain[best] <= gain[own] + 1e-9:
                best = own
            table[best, :] += out_w
            table[:, best] += in_w
            table[best, best] += twice
            if best != own:
                label[w], moved = best, moved + 1
        if not moved:
            break
    return label[:v].astype(np.int32)


def count_neighbours(rows: DataFrame, words: list[bytes]) -> DataFrame:
    """(a int, b int, n long): how often token b follows token a in rows (text).

    Tokens are numbered as in ``words``, then any other word, then the end of a
    text; texts begin after an end. A task hands on the pairs of some tokens at
    a time; they are added up before and after the shuffle.
    """
    shared = rows.sparkSession.sparkContext.broadcast(words)

    def count(batches):
        index = _Index((w, i) for i, w in enumerate(shared.value))
        end = len(index) + 1

        def pairs(parts):
            t = np.concatenate(parts).astype(np.int64)
            t[t < 0] = end - 1
            # several texts are joined here: each starts after an end token and ends with one
            code, n = np.unique(t[:-1] * (end + 1) + t[1:], return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(code // (end + 1), pa.int32()), pa.array(code % (end + 1), pa.int32()),
                                               pa.array(n, pa.int64())], names=["a", "b", "n"])

        kept, length = [np.array([end], dtype=np.int32)], 0
        for batch in batches:
            for t in text_bytes(batch.column("text")):
                w = words_of(t)
                ids = np.empty(len(w) + 1, dtype=np.int32)
                ids[:-1] = np.fromiter(map(index.__getitem__, w), dtype=np.int32, count=len(w))
                ids[-1] = end
                kept.append(ids)
                length += len(ids)
                if length > TOKENS:
                    yield pairs(kept)
                    kept, length = [np.array([end], dtype=np.int32)], 0
        if length:
            yield pairs(kept)

    counted = map_texts(rows.select("text"), count, "a int, b int, n long")
    return counted.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _by_class(pairs: DataFrame, label_of: np.ndarray) -> DataFrame:
    """``pairs`` with the classes (la, lb) of their tokens; the labels hold a row for each word of the dictionary."""
    out = pairs
    for c in ("a", "b"):
        labels = pa.table({c: pa.array(np.arange(len(label_of)), pa.int32()), f"l{c}": pa.array(label_of, pa.int32())})
        out = out.join(F.broadcast(pairs.sparkSession.createDataFrame(labels)), c)
    return out


def _class_table(pairs: DataFrame, label_of: np.ndarray, size: int) -> np.ndarray:
    """Counts (size, size) of neighbours by their classes."""
    table = _by_class(pairs, label_of).groupBy("la", "lb").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((size, size), dtype=np.float64)
    out[np.asarray(table["la"]), np.asarray(table["lb"])] = np.asarray(table["n"])
    return out


def _best_classes(pairs: DataFrame, label_of: np.ndarray, table: np.ndarray, classes: int, first: int, last: int) -> np.ndarray:
    """The class that each word from ``first`` up to ``last`` fits best, by its neighbours' classes.

    Neighbours are added up by (word, side and class) with partial sums, so a
    group of words never holds more than a row for each of those.
    """
    size = classes + 2
    log_next = np.log((table + 0.5) / (table + 0.5).sum(axis=1, keepdims=True))[:classes].T
    log_before = np.log((table.T + 0.5) / (table.T + 0.5).sum(axis=1, keepdims=True))[:classes].T
    shared = pairs.sparkSession.sparkContext.broadcast(np.concatenate([log_next, log_before]))

    def fit(group: pa.Table) -> pa.Table:
        word, at = np.unique(np.asarray(group["word"]), return_inverse=True)
        near = np.zeros((len(word), 2 * size))
        near[at, np.asarray(group["cell"])] = np.asarray(group["n"])
        return pa.table({"word": pa.array(word, pa.int32()), "label": pa.array((near @ shared.value).argmax(axis=1), pa.int32())})

    sides = F.array(F.struct(F.col("a").alias("word"), F.col("lb").alias("cell")),
                    F.struct(F.col("b").alias("word"), (F.col("la") + size).alias("cell")))
    near = (_by_class(pairs, label_of).select(F.explode(sides).alias("s"), "n").select("s.word", "s.cell", "n")
            .where((F.col("word") >= first) & (F.col("word") < last))
            .groupBy("word", "cell").agg(F.sum("n").alias("n")))
    groups = F.pmod("word", F.lit(-(-(last - first) // GROUP_WORDS)))
    found = near.groupBy(groups.alias("g")).applyInArrow(fit, "word int, label int").toArrow()
    out = label_of[first:last].copy()
    out[np.asarray(found["word"]) - first] = np.asarray(found["label"])
    return out


def fit_class_model(rows: DataFrame, core: int | None = None, dictionary: int | None = None, classes: int | None = None,
                    sweeps: int = SWEEPS, rounds: int = ROUNDS) -> tuple[ClassModel, DataFrame]:
    """The model and the full table of word counts, from rows (text). Sizes not given grow with the distinct words."""
    rows = rows.select(F.col("text").cast("string").alias("text"))
    counts = stored(count_words(rows), "op3-counts")
    r = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct"),
                   F.sum(F.when(F.length("word") == 0, F.col("n"))).alias("ends")).first()
    tokens, distinct, ends = int(r["tokens"] or 0), int(r["distinct"]), int(r["ends"] or 0)
    classes = classes or max(CLASSES, round(distinct ** (1 / 3)))
    words, n = most_frequent(counts, dictionary or math.ceil(DICTIONARY * distinct ** GROWTH))
    core = min(core or CORE * classes, len(words))
    rest, end, size = classes, classes + 1, classes + 2
    pairs = stored(count_neighbours(rows, words), "op3-neighbours")

    # neighbours among the core words: a table of the core squared, which one task clusters
    def inside(c: str):
        return F.when(F.col(c) < core, F.col(c)).when(F.col(c) <= len(words), F.lit(core)).otherwise(F.lit(core + 1)).alias(c)

    def cluster(cells: pa.Table) -> pa.Table:
        table = np.zeros((core + 2, core + 2), dtype=np.int64)
        table[np.asarray(cells["a"]), np.asarray(cells["b"])] = np.asarray(cells["n"])
        return pa.table({"labels": pa.array([exchange_classes(table, classes, sweeps).tobytes()], pa.binary())})

    among = pairs.select(inside("a"), inside("b"), "n").groupBy("a", "b").agg(F.sum("n").alias("n"))
    clustered = among.groupBy(F.lit(0).alias("all")).applyInArrow(cluster, "labels binary").first()
    label = np.frombuffer(clustered["labels"], dtype=np.int32) if clustered else np.zeros(0, dtype=np.int32)
    label_of = np.concatenate([label, np.full(len(words) - core + 1, rest), [end]]).astype(np.int32)
    table = _class_table(pairs, label_of, size)
    for _ in range(rounds if len(words) > core else 0):
        best = _best_classes(pairs, label_of, table, classes, core, len(words))
        moved = int((best != label_of[core:len(words)]).sum())
        label_of[core:len(words)] = best
        table = _class_table(pairs, label_of, size)
        if not moved:
            break
    share = (table.sum(axis=0) + 0.5) / (table.sum(axis=0) + 0.5).sum()
    transitions = np.log10((table + PRIOR * share[None, :]) / (table.sum(axis=1, keepdims=True) + PRIOR))
    label = label_of[:len(words)]
    mass = np.bincount(label, weights=n, minlength=size)
    rest_total = float(tokens - ends - n.sum() + 0.5 * (distinct - (1 if ends else 0) - len(words) + 1))
    emissions = np.log10(n / np.maximum(mass[label], 1)) if len(words) else np.zeros(0)
    return ClassModel(words, n, label, transitions, emissions, tokens, distinct, rest_total), counts


def score_class_model(rows: DataFrame, model: ClassModel, counts: DataFrame) -> DataFrame:
    """(row_id, id, n_tokens, n_known, train_tokens, base_score, score, perplexity) of rows (row_id, id, text).

    ``base_score`` is the text's log10 probability by single words with half a
    count added, ``score`` that of the class model.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(model)  # the dictionary is bounded, the classes squared are too
    tokens, distinct, rest_total = model.tokens, model.distinct, model.rest_total

    def score(batches):
        m = shared.value
        index = _Index((w, i) for i, w in enumerate(m.words))
        classes = np.concatenate([m.classes, [m.rest]]).astype(np.int64)   # number -1: any other word
        emit = np.concatenate([m.emissions, [0.0]])
        seen = np.concatenate([np.log10(m.counts + 0.5), [0.0]])
        for b in batches:
            out = {k: [] for k in ("n", "known", "trans", "emit", "base", "words", "times")}
            for t in text_bytes(b.column("text")):
                w = words_of(t)
                ids = np.fromiter(map(index.__getitem__, w), dtype=np.int64, count=len(w))
                c = np.empty(len(w) + 2, dtype=np.int64)
                c[0] = c[-1] = m.end
                c[1:-1] = classes[ids]
                other = np.flatnonzero(ids < 0)
                rare = Counter(w[i] for i in other.tolist())
                out["n"].append(len(w) + 1)
                out["known"].append(len(w) - len(other))
                out["trans"].append(float(m.transitions[c[:-1], c[1:]].sum()))
                out["emit"].append(float(emit[ids].sum()))
                out["base"].append(float(seen[ids].sum()))
                out["words"].append(list(rare))
                out["times"].append(list(rare.values()))
            yield pa.RecordBatch.from_arrays(
                [b.column("row_id"), b.column("id"), pa.array(out["n"], pa.int64()), pa.array(out["known"], pa.int64()),
                 pa.array(out["trans"], pa.float64()), pa.array(out["emit"], pa.float64()), pa.array(out["base"], pa.float64()),
                 pa.array(out["words"], pa.list_(pa.binary())), pa.array(out["times"], pa.list_(pa.int32()))],
                names=["row_id", "id", "n", "known", "trans", "emit", "base", "words", "times"])

    rows = rows.select("row_id", "id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    part = stored(map_texts(rows, score, f"row_id long, id {kind}, n long, known long, trans double, emit double, "
                                         "base double, words array<binary>, times array<int>"), "op3-scores")
    rare = part.select("row_id", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row_id", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    ends = counts.where(F.length("word") == 0).agg(F.sum("n")).first()[0] or 0
    c = F.coalesce(F.col("n"), F.lit(0))
    other = (rare.join(counts, "word", "left")
             .groupBy("row_id").agg(F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more"),
                                    F.sum("times").alias("rest"),
                                    F.sum(F.col("times") * F.log10(c + 0.5)).alias("logs")))
    zero = lambda x: F.coalesce(F.col(x), F.lit(0))
    end_seen = F.lit(math.log10(ends + 0.5))
    below = F.lit(math.log10(tokens + 0.5 * (distinct + 1)))
    rest_below = F.lit(math.log10(max(rest_total, 0.5)))
    out = part.join(other, "row_id", "left")
    score_ = F.col("trans") + F.col("emit") + zero("logs") - zero("rest") * rest_below
    return out.select(
        "row_id", "id", F.col("n").alias("n_tokens"),
        (F.col("known") + zero("more") + (1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("logs") + end_seen - F.col("n") * below).alias("base_score"),
        score_.alias("score"), F.pow(F.lit(10.0), -score_ / F.col("n")).alias("perplexity"))
