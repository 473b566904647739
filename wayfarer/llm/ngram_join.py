"""Documents whose sets of word n-grams overlap: size-banded tiles, bitmap signatures, exact intersection.

1. Each text becomes a sorted array of 64-bit shingle hashes and a bitmap of at
least as many bits as it has shingles. Equal sets are one node from here on.
2. Sizes are cut into bands so narrow that only a few neighbouring bands can
hold a partner at the threshold; a band is split into tiles of bounded bytes.
Every pair of compatible tiles is one group of a shuffle that carries bitmaps
only. A bit in which two bitmaps differ is an element that the sets do not
share, so the count of such bits bounds the overlap from above, and no pair
above the threshold is lost.
3. Only documents that some bitmap lets through send their arrays to their
tile pair. There, candidates are intersected exactly, nearest first, leaving
out pairs that are already connected; a task hands on links of a forest, so a
group of thousands of copies costs a link for each copy, not for each pair.
4. Forests are united into components.

The cost of step 2 grows with the square of a band's documents, at a few
nanoseconds a pair; steps 1, 3 and 4 grow with the input.

Null, empty and blank texts have no shingle and link with nothing; a text with
fewer words than a shingle is one shingle. Repeated rows and equal texts share
one set and so one component. A null id keeps its row; components are named
after the smallest id that is not null.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import FEW_ROWS, Blobs, map_texts, mix64, stored, text_bytes, with_row_id, words_of
from wayfarer.llm.components import connected_components
from wayfarer.session import keep, scratch_scope

#: Bands per factor of the threshold: more bands compare fewer pairs of unfit sizes.
BANDS = 4
#: Bytes of shingle arrays, and documents, of a tile.
TILE_BYTES, TILE_ROWS = 16 << 20, 8_192
#: Neighbouring bands are joined up to so many documents.
THIN_ROWS = 2_048


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles (of the whole text if it has fewer words)."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(k, len(h))
    s = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        s = mix64(s + h[j:len(h) - k + 1 + j])
    return np.unique(s)


def bitmap(hashes: np.ndarray) -> bytes:
    """Bits of the hashes, in a power of two of at least 64 and at least as many bits as hashes."""
    width = max(64, 1 << (len(hashes) - 1).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def shingle_table(rows: DataFrame, k: int) -> DataFrame:
    """(row_id, id, n, key, bits, hashes) of rows (row_id, id, text)."""
    def make(batches):
        for b in batches:
            ns, keys, bits, arrays = [], [], [], []
            for t in text_bytes(b.column("text")):
                s = shingle_hashes(words_of(t), k)
                ns.append(len(s))
                raw = s.astype("<u8").tobytes()
                keys.append(xxhash.xxh3_128_digest(raw) if len(s) else None)
                bits.append(bitmap(s) if len(s) else None)
                arrays.append(raw)
            yield pa.RecordBatch.from_arrays(
                [b.column("row_id"), b.column("id"), pa.array(ns, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bits, pa.binary()), pa.array(arrays, pa.binary())],
                names=["row_id", "id", "n", "key", "bits", "hashes"])

    kind = rows.schema["id"].dataType.simpleString()
    return map_texts(rows.select("row_id", "id", "text"), make,
                     f"row_id long, id {kind}, n long, key binary, bits binary, hashes binary")


def _edges(percent: int, longest: int) -> list[int]:
    """Integer lower ends of the size bands, up to beyond the longest."""
    step, out, b = -math.log(percent / 100) / BANDS, [1], 1
    while out[-1] <= longest:
        edge = math.ceil(math.exp(b * step))
        if edge > out[-1]:
            out.append(edge)
        b += 1
    return out


def _tiles(nodes: DataFrame, percent: int) -> DataFrame:
    """``nodes`` (node, n, bits) with ``tile_pair`` and ``side``: a row for each tile pair that a document is in.

    The plan reads one row per band; bands are as many as the logarithm of the longest text.
    """
    longest = nodes.agg(F.max("n")).first()[0] or 1
    edges = _edges(percent, longest)
    cuts = F.array(*[F.lit(e).cast("long") for e in edges])
    banded = nodes.withColumn("band", F.size(F.filter(cuts, lambda e: e <= F.col("n"))) - 1)
    counts = {r["band"]: (r["c"], r["s"]) for r in
              banded.groupBy("band").agg(F.count("*").alias("c"), F.sum("n").alias("s")).collect()}
    if not counts:
        return nodes.select("node", "n", "bits", F.lit(0).cast("long").alias("tile_pair"), F.lit(0).alias("side"))
    # thin neighbouring bands make one range: (lowest size, highest size, documents, shingles, bands)
    ranges: list[list] = []
    for b in sorted(counts):
        c, size = counts[b]
        if ranges and ranges[-1][2] + c <= THIN_ROWS and 8 * (ranges[-1][3] + size) <= TILE_BYTES:
            last = ranges[-1]
            last[1], last[2], last[3] = edges[b + 1] - 1, last[2] + c, last[3] + size
            last[4].append(b)
        else:
            ranges.append([edges[b], edges[b + 1] - 1, c, size, [b]])
    parts = [max(1, -(-r[2] // TILE_ROWS), -(-8 * r[3] // TILE_BYTES)) for r in ranges]
    base = [sum(parts[:i]) for i in range(len(parts))]
    total = sum(parts)
    spans = []
    for i, r in enumerate(ranges):
        fit = [j for j, o in enumerate(ranges)
               if 100 * min(r[1], o[1]) >= percent * max(r[0], o[0])]
        # compatible ranges are neighbours, so their tiles are one range of numbers
        spans += [(b, base[i], parts[i], base[fit[0]], base[fit[-1]] + parts[fit[-1]] - 1) for b in r[4]]
    names = ("band", "base", "parts", "low", "high")
    lookup = F.create_map(*[x for s in spans for x in
                            (F.lit(s[0]), F.struct(*[F.lit(v).cast("long").alias(k) for k, v in zip(names, s)]))])
    at = banded.withColumn("_p", lookup[F.col("band")])
    at = at.withColumn("tile", F.col("_p.base") + F.pmod(F.xxhash64("node"), F.col("_p.parts")))
    return (at.select("node", "n", "bits", "tile", F.explode(F.sequence("_p.low", "_p.high")).alias("other"))
            .select("node", "n", "bits", (F.least("tile", "other") * F.lit(total) + F.greatest("tile", "other")).alias("tile_pair"),
                    F.when(F.col("tile") == F.col("other"), 0).when(F.col("tile") < F.col("other"), 1).otherwise(2).alias("side")))


def _folded(bits: Blobs, width: int) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, wider ones folded (halves united) to ``width`` bytes."""
    out = np.zeros((len(bits), width // 8), dtype=np.uint64)
    for i in range(len(bits)):
        out[i] = np.bitwise_or.reduce(bits[i].reshape(-1, width // 8), axis=0)
    return out


def _candidates(table: pa.Table, percent: int):
    """Rows of ``table`` in pairs (i, j, differing bits) that the bitmaps do not rule out; yields blocks of rows i."""
    side = np.asarray(table["side"])
    n = np.asarray(table["n"], dtype=np.int64)
    raw = Blobs(table["bits"], "<u8")
    left, right = np.flatnonzero(side < 2), np.flatnonzero(side != 1)
    if not len(left) or not len(right):
        return
    right = right[np.argsort(n[right], kind="stable")]
    width = int(np.diff(raw.at).min())
    words = _folded(raw, width)
    a, b = words[left], np.ascontiguousarray(words[right].T)
    nb = n[right]
    first = max(1, math.ceil(0.6 * a.shape[1]))
    same = side[left[0]] == 0
    place = np.empty(len(n), dtype=np.int64)
    place[right] = np.arange(len(right))
    block = max(1, (1 << 20) // max(1, len(right)))
    for i in range(0, len(left), block):
        rows = left[i:i + block]
        diff = np.zeros((len(rows), len(right)), dtype=np.uint32 if width > 8000 else np.uint16)
        for w in range(first):
            diff += np.bitwise_count(a[i:i + block, w, None] ^ b[None, w, :])
        # |A xor B| <= (1 - t) / (1 + t) * (|A| + |B|) at Jaccard t
        limit = (100 - percent) * (n[rows] + nb[-1]) // (100 + percent)
        r, c = np.nonzero(diff <= limit[:, None])
        if same:
            later = c > place[rows[r]]
            r, c = r[later], c[later]
        for s in range(0, max(1, len(r)), 1 << 20):
            rr, cc = r[s:s + (1 << 20)], c[s:s + (1 << 20)]
            d = np.bitwise_count(a[i + rr] ^ b[:, cc].T).sum(axis=1).astype(np.int64)
            d = np.maximum(d, np.abs(n[rows[rr]] - nb[cc]))
            ok = (100 + percent) * d <= (100 - percent) * (n[rows[rr]] + nb[cc])
            if ok.any():
                yield rows[rr[ok]], right[cc[ok]], d[ok]


def jaccard_links(nodes: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """(a, b): a forest of links in every tile pair that together connect all nodes with Jaccard >= percent / 100.

    ``nodes``: node, n, bits; ``arrays``: node, hashes.
    """
    tiles = _tiles(nodes, percent)

    def involved(table: pa.Table) -> pa.Table:
        hit = np.zeros(table.num_rows, dtype=bool)
        for i, j, _ in _candidates(table, percent):
            hit[i] = True
            hit[j] = True
        return table.filter(pa.array(hit))

    def linked(table: pa.Table) -> pa.Table:
        raw, n = Blobs(table["hashes"], "<u8"), np.asarray(table["n"], dtype=np.int64)
        node = np.asarray(table["node"], dtype=np.int64)
        group, out = np.arange(len(n)), []  # of each row: the number of its tree
        for i, j, d in _candidates(table, percent):
            by = np.lexsort((d, i))
            i, j = i[by], j[by]
            starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
            for s, e in zip(starts, np.r_[starts[1:], len(i)]):
                x = int(i[s])
                mine, rest = raw[x], j[s:e]
                while len(rest := rest[group[rest] != group[x]]):
                    y, rest = int(rest[0]), rest[1:]
                    both = len(np.intersect1d(mine, raw[y], assume_unique=True))
                    if 100 * both >= percent * (n[x] + n[y] - both):
                        group[group == group[y]] = group[x]
                        out.append((int(node[x]), int(node[y])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    shape = "node long, n long, bits binary, tile_pair long, side int"
    some = stored(tiles.groupBy("tile_pair").applyInArrow(involved, shape), "op5-candidates")
    # where the involved are few, their numbers go to the arrays and only those are sent; else all are
    ids = some.select("node").distinct()
    if ids.count() <= FEW_ROWS:
        arrays = arrays.join(F.broadcast(ids), "node", "left_semi")
    full = some.join(arrays, "node")
    return full.groupBy("tile_pair").applyInArrow(linked, "a long, b long")


def ngram_components(rows: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """(row_id, id, n_shingles, component, component_id) of rows (row_id, id, text).

    ``component`` is the number of a connected group (null for texts without
    shingles); ``component_id`` its smallest id, or the own id for those.
    """
    sets = stored(shingle_table(rows, k), "op5-shingles")
    named = stored(sets.where("n > 0").groupBy("key").agg(F.min("row_id").alias("node"), F.min("id").alias("low_id")),
                   "op5-sets")
    only = sets.join(named.select(F.col("node").alias("row_id")), "row_id")
    links = jaccard_links(only.select(F.col("row_id").alias("node"), "n", "bits"),
                          sets.select(F.col("row_id").alias("node"), "hashes"), percent)
    comps = connected_components(links, "a", "b")
    whole = named.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    low = whole.groupBy("component").agg(F.min("low_id").alias("component_id"))
    by_set = whole.join(low, "component").select("key", "component", "component_id")
    return (sets.select("row_id", "id", "n", "key").join(by_set, "key", "left")
            .select("row_id", "id", F.col("n").alias("n_shingles"), "component",
                    F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id")))


def one_of_each_group(docs: DataFrame, id_col: str, text_col: str, k: int = 5, percent: int = 80,
                      scanned: bool = False) -> DataFrame:
    """``docs`` without near-duplicates: of each group the row with the smallest id stays (null ids last,
    then the first row). Rows without any shingle all stay. ``scanned``: ``docs`` is read straight from files."""
    kept = with_row_id(docs, "op5-rows", scanned)
    rows = kept.select("row_id", F.col("row")[id_col].alias("id"), F.col("row")[text_col].alias("text"))
    with scratch_scope(docs.sparkSession) as scope:
        groups = ngram_components(rows, k, percent).where("component is not null")
        first = groups.groupBy("component").agg(
            F.min(F.struct(F.col("id").isNull().alias("x"), "id", "row_id"))["row_id"].alias("first"))
        go = groups.join(first, "component").where("row_id <> first").select("row_id")
        go = keep(stored(go, "op5-copies"), scope)
    if go.count() <= FEW_ROWS:
        go = F.broadcast(go)
    return kept.join(go, "row_id", "left_anti").select("row.*")
