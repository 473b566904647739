"""Packing tokenised documents into fixed windows by exact complements.

Texts are tokenised, ended with one id and, where longer than the window, cut
into pieces; pieces are numbered within their length as they are written. The
packing itself is planned on the table of counts by length, which has at most
as many rows as the window has tokens, whatever the corpus. For each length,
longest first, the plan looks up which single, pair or triple of lengths still
available fills the gap exactly, and consumes as many such combinations as the
counts allow; what then remains is packed best-fit, longest first. Every piece
finds its place from its length and number.

Null and empty texts are a document of the end id alone. Repeated rows are
documents of their own. Empty tables give empty results.
"""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.llm.common import map_texts, stored, text_bytes

#: Token ids kept by word in a task; the table starts again when it is full.
CACHE_WORDS = 1 << 19

#: Marks that end a word as one pre-token (no apostrophe, which may start one, and nothing of a special token).
MARKS = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"

#: The greatest first byte of a character up to U+00FF; the letters among those are in the plain range.
LATIN = 0xC3


# -- tokens ---------------------------------------------------------------------

class WordTokens(dict):
    """ids of a text, put together from those of its blank-separated chunks.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its chunks one after another. A chunk of printable Latin
    characters is cut into the tokenizer's own pre-tokens (letter runs, digits,
    the rest, contractions) and each goes to its model; any other chunk goes
    through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        import regex
        from tokenizers import Tokenizer

        if not os.path.isabs(path):
            import public_tokenizers
            path = public_tokenizers.path(path)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.plain = regex.compile(r"[\x21-\x7e¡-¬®-ÿ]+")
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        # bytes as the characters that stand for them in a byte-level vocabulary
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.parts: dict[str, bytes] = {}

    def __missing__(self, chunk: bytes) -> bytes:
        word = chunk.rstrip(MARKS)
        text = word.decode("utf-8")
        if text.isalpha() and max(word) <= LATIN:
            # letters, then marks: two pre-tokens of a known place
            out = self._part(text.lower()) + (self._part(chunk[len(word):].decode("ascii")) if len(word) < len(chunk) else b"")
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[chunk] = out
            return out
        text = chunk.decode("utf-8")
        if self.plain.fullmatch(text) and "<|" not in text:
            out = b"".join(map(self._part, self.split.findall(text.lower())))
        else:
            out = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[chunk] = out
        return out

    def _part(self, part: str) -> bytes:
        out = self.parts.get(part)
        if out is None:
            shown = part if part.isascii() else part.encode("utf-8").decode("latin-1").translate(self.letters)
            out = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            if len(self.parts) >= CACHE_WORDS:
                self.parts.clear()
            self.parts[part] = out
        return out

    def ids(self, text: bytes | None) -> bytes:
        """Little-endian unsigned 32-bit ids of a UTF-8 text."""
        return b"".join(map(self.__getitem__, text.split())) if text else b""


def token_pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, part, number): pieces of at most ``window`` tokens.

    ``number`` counts the pieces of one length within one written partition
    ``part``; the table is written once, so both stay as they are.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    end = np.array([end_id], dtype="<u4").tobytes()

    def make(batches):
        words, part, counts = WordTokens(tokenizer), TaskContext.get().partitionId(), [0] * (window + 1)

        def table(b):
            at, piece, start, length, crc, number, raw = [], [], [], [], [], [], []
            for i, t in enumerate(text_bytes(b.column("text"))):
                ids = words.ids(t) + end
                for k, s in enumerate(range(0, len(ids), 4 * window)):
                    cut = ids[s:s + 4 * window]
                    n = len(cut) // 4
                    at.append(i)
                    piece.append(k)
                    start.append(s // 4)
                    length.append(n)
                    crc.append(zlib.crc32(cut))
                    number.append(counts[n])
                    counts[n] += 1
                    raw.append(cut)
            flat = np.frombuffer(b"".join(raw), dtype="<u4").astype(np.int32)
            offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(flat)),
                 pa.array([part] * len(at), pa.int32()), pa.array(number, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids", "part", "number"])

        yield from map(table, batches)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return stored(map_texts(rows, make, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
                                        "ids array<int>, part int, number long"), "op9-pieces")


# -- the plan -------------------------------------------------------------------

def plan_windows(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places for all pieces: (length, first number, number after the last, first sequence, per sequence, offset).

    Pieces first..last of a length go ``per`` to a sequence, one after another
    from ``offset`` on. Works on counts alone.
    """
    have = np.zeros(window + 1, dtype=np.int64)
    for length, c in counts.items():
        have[length] += c
    used = np.zeros(window + 1, dtype=np.int64)
    places, sequences = [], 0

    def take(runs: list[tuple[int, int]], times: int) -> None:
        """``times`` new sequences, each of the runs (length, how many) in turn."""
        nonlocal sequences
        offset = 0
        for length, per in runs:
            places.append((length, int(used[length]), int(used[length] + per * times), sequences, per, offset))
            used[length] += per * times
            have[length] -= per * times
            offset += length * per
        sequences += times

    def possible(lengths) -> int:
        need: dict[int, int] = {}
        for x in lengths:
            need[x] = need.get(x, 0) + 1
        return min(int(have[x]) // k for x, k in need.items())

    def consume(lengths) -> bool:
        times = possible(lengths)
        if times > 0:
            take([(x, 1) for x in lengths], times)
        return times > 0

    def pair_for(total: int, most: int):
        """The pair of available lengths with that sum whose larger is longest, at most ``most``."""
        high = min(total - 1, most)
        low = (total + 1) // 2
        if high < low:
            return None
        x = np.arange(high, low - 1, -1)
        ok = (have[x] > 0) & (have[total - x] > (x == total - x))
        hit = int(ok.argmax())
        return (int(x[hit]), int(total - x[hit])) if ok[hit] else None

    if have[window]:
        take([(window, 1)], int(have[window]))
    for length in range(window - 1, 0, -1):
        gap = window - length
        if have[length] and gap <= window:
            consume((length, gap))
        blocked: set = set()
        while have[length]:
            pair = pair_for(gap, gap)
            if pair is None or not consume((length, *pair)):
                break
        while have[length]:
            found = None
            for a in np.flatnonzero(have[:gap])[::-1].tolist():
                if 3 * a < gap:
                    break
                if a in blocked:
                    continue
                pair = pair_for(gap - a, a)
                if pair is not None and possible((length, a, *pair)) > 0:
                    found = (length, a, *pair)
                    break
                blocked.add(a)
            if found is None:
                break
            consume(found)
    # best fit of the rest; windows of one shape are handled together
    gaps: list[int] = []
    open_by_gap: dict[int, list[list]] = {}

    def keep(runs, times, gap):
        if times:
            if gap not in open_by_gap:
                open_by_gap[gap] = []
                insort(gaps, gap)
            open_by_gap[gap].append([runs, times])

    for length in range(window, 0, -1):
        left = int(have[length])
        while left:
            k = bisect_left(gaps, length)
            if k == len(gaps):
                runs, times, gap = [], 1 << 62, window
            else:
                gap = gaps[k]
                runs, times = open_by_gap[gap].pop()
                if not open_by_gap[gap]:
                    del open_by_gap[gap]
                    gaps.pop(k)
            per = gap // length
            full = min(times, left // per)
            keep([*runs, (length, per)], full, gap - per * length)
            left -= full * per
            rest = times - full
            if rest and left and left < per:
                keep([*runs, (length, left)], 1, gap - left * length)
                rest, left = rest - 1, 0
            if gap < window:
                keep(runs, rest, gap)
    for groups in open_by_gap.values():
        for runs, times in groups:
            take(runs, times)
    return places


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "word_bpe_49k.json",
           window: int = 2048, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset): every piece with its place."""
    pieces = token_pieces(docs, id_col, text_col, tokenizer, window, end_id)
    by_part = pieces.groupBy("part", "length").agg(F.count("*").alias("c"))
    by_part = stored(by_part.withColumn("before", F.sum("c").over(Window.partitionBy("length").orderBy("part")) - F.col("c")),
                     "op9-counts")
    counts = {r["length"]: r["c"] for r in by_part.groupBy("length").agg(F.sum("c").alias("c")).collect()}
    places = sorted(plan_windows(counts, window))
    flat = np.array([(x[0] << 44) + x[1] for x in places], dtype=np.int64)
    table = np.array(places, dtype=np.int64).reshape(-1, 6)
    plan = pieces.sparkSession.sparkContext.broadcast((flat, table))  # as many rows as the plan has shapes of window

    def place(batches):
        keys, rows = plan.value
        for b in batches:
            length, rank = np.asarray(b.column("length")), np.asarray(b.column("rank"))
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            _, first, _, sequence, per, offset = rows[at].T if len(at) else np.zeros((6, 0), dtype=np.int64)
            k = rank - first
            more = [pa.array(sequence + k // per, pa.int64()), pa.array(offset + k % per * length, pa.int64())]
            kept = [c for c in b.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *more], names=[*kept, "sequence_id", "offset"])

    ranked = (pieces.join(by_part.select("part", "length", "before"), ["part", "length"])
              .select("part", "number", "length", (F.col("before") + F.col("number")).alias("rank")))
    placed = ranked.mapInArrow(place, "part int, number long, length long, sequence_id long, offset long")
    return (pieces.join(placed, ["part", "number", "length"])
            .select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"))
