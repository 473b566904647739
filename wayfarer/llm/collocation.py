"""Phrases whose words stand together more often than their parts foretell.

Counting. Word counts come first; pairs are counted only where both words are
frequent, longer phrases only where every pair in them is, so that what goes to
the shuffle shrinks to little more than the frequent phrases. Tasks test that
against a bit filter of bounded size (``FILTER_BYTES``): a false positive costs
a row and is dropped by the exact count. Tasks add up a few megabytes of text
before they hand rows on.

Streams. The frequent phrases of all lengths are kept in two orders, by their
words from the front (prefix order) and from the back (suffix order), each
range-sorted and cut anywhere. In prefix order the first parts of a phrase stand
right before it, in suffix order its last parts: one pass over a stream, holding
only the parts of the phrase at hand, gives the left or right counts and each
phrase's most frequent extension. A range that starts inside a family of phrases
gets the (at most ``longest`` - 1) parts of its first phrase in front. The suffix
pass's result runs into the prefix stream in the same order and both are merged
in lockstep.

Null texts are empty, a null language is ``und``, a repeated row counts each
time, an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.llm.common import map_texts, mix64, stored, text_bytes

#: Bytes of text that a task counts together.
CHUNK_BYTES = 4 << 20
#: Bytes that the filter of frequent phrases has at most; above that it lets more infrequent ones through.
FILTER_BYTES = 64 << 20
PIECE = 1 << 16
#: Rows of a sorted range.
RANGE_ROWS = 100_000

_BREAK = b"\xff"  # in no UTF-8 text
_TABLE = bytes(0xFF if b in b".,;:!?\n\x0b\x0c\r" else b | 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
GRAMS = "lang string, gram string, n long"


def _chunks(batches):
    """(language, texts) with about CHUNK_BYTES of text."""
    held, size = defaultdict(list), 0
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), text_bytes(batch["text"])):
            if text:
                held[lang].append(text)
                size += len(text)
            if size >= CHUNK_BYTES:
                yield from held.items()
                held, size = defaultdict(list), 0
    yield from held.items()


def _coded(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], int]:
    """Word numbers of all texts with a break between pieces, the words, and the break's number."""
    words = _BREAK.join(texts).translate(_TABLE).replace(_BREAK, b" \xff ").split()
    coded = pa.array(words + [_BREAK], pa.binary()).dictionary_encode()
    ids, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
    return ids, words, int(ids[-1])


def _rows(lang: str, grams: list[bytes], counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.binary()).cast(pa.string()),
                                       pa.array(counts, pa.int64())], ["lang", "gram", "n"])


def _words(batches):
    for lang, texts in _chunks(batches):
        ids, words, stop = _coded(texts)
        counts = np.bincount(ids, minlength=len(words))
        yield _rows(lang, words[:stop] + words[stop + 1:], np.delete(counts, stop))


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], dtype=np.uint64)


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix64(first * np.uint64(0x9E3779B97F4A7C15) + second)


def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Two bits of the filter for each hash."""
    return [(h & np.uint64(bits - 1)).astype(np.int64) for h in (hashes, mix64(hashes))]


def _held(filter_bytes: bytes, hashes: np.ndarray) -> np.ndarray:
    bits = np.frombuffer(filter_bytes, np.uint8)
    ok = np.ones(len(hashes), bool)
    for at in _places(hashes, 8 * len(bits)):
        ok &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return ok


def _filter(frequent: DataFrame) -> bytes:
    """Bits of all frequent words or pairs: 16 each, as long as that stays within FILTER_BYTES."""
    size = 16
    need = 2 * frequent.count()
    while size < min(need, FILTER_BYTES):
        size *= 2

    def partly(batches):
        bits = np.zeros(size, np.uint8)
        for batch in batches:
            for lang, gram in zip(batch["lang"].to_pylist(), text_bytes(batch["gram"])):
                h = _hashes(lang, gram.split(b" "))
                for at in _places(h if len(h) == 1 else _joined(h[:1], h[1:]), 8 * size):
                    bits[at >> 3] |= np.uint8(1) << (at & 7).astype(np.uint8)
        pieces = [p for p in range(0, size, PIECE) if bits[p:p + PIECE].any()]
        yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.int64()),
                                          pa.array([bits[p:p + PIECE].tobytes() for p in pieces], pa.binary())], ["at", "bits"])

    def united(table):
        bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in table["bits"].to_pylist()])
        return pa.table({"at": table["at"][:1], "bits": pa.array([bits.tobytes()], pa.binary())})

    pieces = frequent.select("lang", "gram").mapInArrow(partly, "at long, bits binary")
    whole = bytearray(size)
    for at, bits in pieces.groupBy("at").applyInArrow(united, "at long, bits binary").collect():
        whole[at:at + len(bits)] = bits
    return bytes(whole)


def _distinct(ids: np.ndarray, starts: np.ndarray, ranks: np.ndarray, last: np.ndarray, size: int):
    """Numbers of the phrases (rank of the words before, last word), one start of each, and their counts."""
    _, first, rank, counts = np.unique(ranks * size + ids[last], return_index=True, return_inverse=True, return_counts=True)
    return rank, starts[first], counts


def _grams(known, least_words: int, most_words: int):
    """Counts phrases of ``least_words`` to ``most_words`` words; ``known`` is a filter of the
    words (for pairs) or pairs (for longer ones) that every word or pair of a phrase must pass."""
    def work(batches):
        bits = known.value
        for lang, texts in _chunks(batches):
            ids, words, stop = _coded(texts)
            h = _hashes(lang, words)
            if least_words == 2:
                word_ok = _held(bits, h)
                word_ok[stop] = False
                ok = word_ok[ids]
                starts = np.flatnonzero(ok[:-1] & ok[1:])
            else:
                inside = np.flatnonzero((ids[:-1] != stop) & (ids[1:] != stop))
                ok = np.zeros(len(ids), bool)
                ok[inside] = _held(bits, _joined(h[ids[inside]], h[ids[inside + 1]]))
                starts = np.flatnonzero(ok)
            ranks = ids[starts] if least_words == 2 else ids[starts] * len(words) + ids[starts + 1]
            for n in range(least_words, most_words + 1):
                if n > 2:  # the pair of the last two words, besides those before
                    more = ok[np.minimum(starts + n - 2, len(ok) - 1)]
                    starts, ranks = starts[more], ranks[more]
                if not len(starts):
                    break
                if n == 3:
                    ranks = np.unique(ranks, return_inverse=True)[1]
                ranks, where, counts = _distinct(ids, starts, ranks, starts + n - 1, len(words))
                yield _rows(lang, [b" ".join([words[i] for i in ids[s:s + n]]) for s in where], counts)
    return work


def frequent_phrases(texts: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """(lang, gram, n) of the words and phrases found ``least`` times or more, and (lang, total) of all words."""
    sc = texts.sparkSession.sparkContext

    def summed(work, name):
        rows = map_texts(texts, work, GRAMS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        return stored(rows if work is _words else rows.where(F.col("n") >= least), name)

    words = summed(_words, "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    parts = [words.where(F.col("n") >= least)]
    for low, high in ((2, 2), (3, longest)):
        if high >= low:
            known = sc.broadcast(_filter(parts[-1]))
            parts.append(summed(_grams(known, low, high), "phrases"))
            known.unpersist()
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, totals


def _key(words):
    return F.concat(F.array_join(words, " "), F.lit(" "))


STREAM = "lang string, key string, n long, rests array<long>, ext long"
PASSED = "lang string, key string, n long, parts array<long>, rests array<long>, ext long, ghost boolean"


def _pass(table: pa.Table) -> pa.Table:
    """One pass over a sorted range: rows of one key merged, counts of its leading parts, its best extension."""
    table = table.sort_by([("lang", "ascending"), ("key", "ascending")])
    rows = zip(table["lang"].to_pylist(), table["key"].to_pylist(), table["n"].to_pylist(), table["rests"].to_pylist(),
               table["ext"].to_pylist(), table["ghost"].to_pylist())
    out, open_ = [], []
    for lang, key, n, rests, ext, ghost in rows:
        if open_ and open_[-1]["lang"] == lang and open_[-1]["key"] == key:
            top = open_[-1]  # the other stream's row of the same phrase
            top["n"] = n if top["n"] is None else top["n"]
            top["rests"] = rests if top["rests"] is None else top["rests"]
            top["ext"] = max(top["ext"], ext or 0)
            continue
        while open_ and not (open_[-1]["lang"] == lang and key.startswith(open_[-1]["key"])):
            open_.pop()
        top = {"lang": lang, "key": key, "n": n, "rests": rests, "ext": ext or 0, "ghost": ghost, "above": list(open_)}
        open_.append(top)
        out.append(top)
    for row in out:
        row["parts"] = [p["n"] for p in row["above"]]
        if row["above"]:
            row["above"][-1]["ext"] = max(row["above"][-1]["ext"], row["n"])
    return pa.Table.from_pylist([{k: r[k] for k in ("lang", "key", "n", "parts", "rests", "ext", "ghost")} for r in out],
                                pa.schema([("lang", pa.string()), ("key", pa.string()), ("n", pa.int64()), ("parts", pa.list_(pa.int64())),
                                           ("rests", pa.list_(pa.int64())), ("ext", pa.int64()), ("ghost", pa.bool_())]))


def _streamed(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (STREAM) range-sorted by key and passed over; ghosts are parts that a range borrowed from an earlier one."""
    spark = rows.sparkSession
    rows = stored(rows, name)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_ROWS))
    cut = stored(rows.repartitionByRange(ranges, "lang", "key").withColumn("part", F.spark_partition_id()), f"{name}-sorted")
    heads = (cut.groupBy("part").agg(F.min(F.struct("lang", "key")).alias("head"))
             .select("part", "head.lang", F.split(F.rtrim("head.key"), " ").alias("words"))
             .select("part", "lang", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("k")).where("k > 0")
             .select("part", "lang", _key(F.slice("words", 1, F.col("k"))).alias("key")))
    # at most (longest - 1) short rows a range
    ghosts = (rows.where(F.col("n").isNotNull()).select("lang", "key", "n")
              .join(F.broadcast(heads), ["lang", "key"])
              .select("lang", "key", "n", F.lit(None).cast("array<long>").alias("rests"), F.lit(None).cast("long").alias("ext"), "part",
                      F.lit(True).alias("ghost")))
    return stored(cut.withColumn("ghost", F.lit(False)).unionByName(ghosts).groupBy("part").applyInArrow(_pass, PASSED), f"{name}-passed")


def phrase_counts(frequent: DataFrame) -> DataFrame:
    """lang, words, n, firsts, lasts, ext of every phrase of ``frequent`` (lang, gram, n).

    ``firsts[k]`` counts its first k + 1 words, ``lasts[k]`` its last k + 1;
    ``ext`` is the count of its most frequent extension by one word (0: none).
    """
    none = F.lit(None).cast("long").alias("ext")
    no_rests = F.lit(None).cast("array<long>").alias("rests")
    words = F.split("gram", " ")
    back = _streamed(frequent.select("lang", _key(F.reverse(words)).alias("key"), "n", no_rests, none), "suffix-stream")
    there = F.split(F.rtrim("key"), " ")
    met = back.select("lang", _key(F.reverse(there)).alias("key"), F.lit(None).cast("long").alias("n"),
                      F.when(~F.col("ghost"), F.col("parts")).alias("rests"), "ext")
    front = _streamed(frequent.select("lang", _key(words).alias("key"), "n", no_rests, none).unionByName(met), "prefix-stream")
    borrowed = (front.where("ghost").groupBy("lang", "key").agg(F.max("ext").alias("more")))
    return (front.where("not ghost").join(F.broadcast(borrowed), ["lang", "key"], "left")
            .select("lang", there.alias("words"), "n", F.col("parts").alias("firsts"), F.col("rests").alias("lasts"),
                    F.greatest("ext", F.coalesce("more", F.lit(0))).alias("ext")))


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 100, longest: int = 5,
                 percent: int = 100, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of every language.

    A phrase has 2 to ``longest`` words and occurs ``least`` times; one is left out
    when an extension of it has ``percent`` percent of its occurrences or more.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    frequent, totals = frequent_phrases(texts, least, longest)
    m = F.size("words")
    cand = phrase_counts(frequent).where((m >= 2) & (F.col("ext") * 100 < F.col("n") * percent)).join(totals, "lang")
    wide = "decimal(17,0)"

    def cut(k):
        left, right = F.get("firsts", F.lit(k - 1)), F.get("lasts", m - (k + 1))
        score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * F.col("n").cast(wide) * F.col("total").cast(wide),
                                left.cast(wide) * right.cast(wide))
        return F.when(m > k, F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))

    best = F.array_min(F.array(*[cut(k) for k in range(1, longest)]))
    rows = cand.select("lang", F.array_join("words", " ").alias("phrase"), F.col("n").alias("a"), F.col("total").alias("n"), best.alias("cut"))
    rows = rows.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    # the best of every share of a language first, then the best among those
    order = [F.desc("score"), F.desc("a"), "phrase"]
    rows = (rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(256)))
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top))
    return (rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
