"""How far the sources of a language lie from each other and from the language, term by term.

Tokeniser: one ``bytes.translate`` table lower-cases A-Z and blanks every ASCII
byte that is no letter, ``bytes.split`` cuts at the blanks, and a ``Counter`` of
every document gives its term counts and, by its keys, the document counts. A
task adds the counters of its documents up per (language, source) before it
hands sparse rows on; the cluster adds those up.

A language keeps the terms that ``least_docs`` of its documents hold. A group
(language, source) gives each kept term the share
``p = 1 + floor(SCALE * (count + 1) / (N + V))``; the distance of one term is
``floor((p - q)^2 / q)``. All of it is exact in integers.

Nulls in text, language and source count as empty; a row repeated counts as
often as it stands there; a group without kept terms has count 0 everywhere; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.llm.common import map_texts, stored, text_bytes
from wayfarer.session import small_table

#: Parts that a share of 1 has.
SCALE = 1_000_000_000
#: (group, term) cells that a task adds up before it hands them on.
CELLS = 100_000
#: Sources in a tile, terms and rows in a block of the comparison of sources.
TILE, BLOCK_TERMS, BLOCK_ROWS = 128, 4096, 200_000

_TABLE = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters (lower-cased) and bytes above 0x7F."""
    return text.translate(_TABLE).split() if text else []


def _counted(batches):
    groups, docs, cells = defaultdict(Counter), defaultdict(Counter), 0

    def rows():
        keys = [k for k in groups for _ in range(len(groups[k]))]
        terms = [t for c in groups.values() for t in c]
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array(terms, pa.binary()).cast(pa.string()),
             pa.array([n for c in groups.values() for n in c.values()], pa.int64()),
             pa.array([docs[k][t] for k, c in groups.items() for t in c], pa.int64())],
            ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), text_bytes(batch["text"])):
            counter = Counter(terms_of(text))
            if not counter:
                continue
            group, seen = groups[lang, source], docs[lang, source]
            cells -= len(group)
            for term, n in counter.items():
                group[term] += n
            seen.update(counter.keys())
            cells += len(group)
            if cells >= CELLS:
                yield rows()
                groups.clear(), docs.clear()
                cells = 0
    if groups:
        yield rows()


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with the term) of every group and term."""
    clean = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                          for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    cells = map_texts(clean, _counted, "lang string, source string, term string, n long, docs long")
    # tasks have added their cells up already; all of a term's sources meet, so that its totals need no further shuffle
    cells = cells.repartition("lang", "term")
    return cells.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)); null where there are no terms."""
    wide = "decimal(20,0)"
    exact = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast(wide), (total + terms).cast(wide))
    short = F.call_function("div", F.lit(SCALE) * (count + 1), total + terms)  # in 64 bits where the product fits
    return F.when(terms > 0, F.when(count < (1 << 63) // SCALE - 1, short).otherwise(exact) + 1)


def _distance(p: Column, q: Column) -> Column:
    # the difference of two shares is at most SCALE, its square below 2^63
    return F.call_function("div", (p - q) * (p - q), q)


def _few(df: DataFrame) -> DataFrame:
    """Broadcast where counting it allows that, else the table itself (its joins then shuffle)."""
    small = small_table(df, 1_000_000)
    return df if small is None else small


def _blocks(table: pa.Table) -> pa.Table:
    """Sums of distances between the sources of two tiles over the terms of one block."""
    a, b = table["a"][0].as_py(), table["b"][0].as_py()
    place = table["place"].to_numpy()
    share = table["p"].to_numpy()
    term = table["term"].combine_chunks()
    known = ~np.asarray(term.is_null())
    sources, first = np.unique(place[~known], return_index=True)
    base = share[~known][first]
    terms = term.filter(pa.array(known)).dictionary_encode()
    size = len(terms.dictionary)
    shares = np.repeat(base[:, None], size, axis=1)
    shares[np.searchsorted(sources, place[known]), terms.indices.to_numpy()] = share[known]
    here, there = np.flatnonzero(sources // TILE == a), np.flatnonzero(sources // TILE == b)
    out = []
    for x, y in ((here, there), (there, here)) if a != b else ((here, here),):
        q = shares[y]
        out += [(sources[i], sources[y], ((shares[i] - q) ** 2 // q).sum(axis=1)) for i in x]
    n = [len(s) for _, s, _ in out]
    lang = table["lang"][0].as_py()
    return pa.table({
        "lang": pa.array([lang] * sum(n), pa.string()),
        "place": pa.array(np.repeat([g for g, _, _ in out], n) if n else [], pa.int32()),
        "other": pa.array(np.concatenate([s for _, s, _ in out]) if n else [], pa.int32()),
        "value": pa.array(np.concatenate([v for _, _, v in out]) if n else [], pa.int64()),
        "seen": pa.array([size] * sum(n), pa.int64())})


def _between(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, place, other, value, seen: sums over the terms that the tiles' sources hold, and how many those are.

    Sources are cut into tiles and terms into blocks; a task gets the cells of
    two tiles for one block of terms, so neither a language nor a source nor a
    term has to fit in one task, and pairs are made as sums, never as rows of a
    join.
    """
    langs = groups.groupBy("lang").agg((F.floor(F.max("place") / TILE) + 1).cast("int").alias("tiles"), F.max("terms").alias("terms"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("cells"))
    langs = langs.join(sizes, "lang").select("lang", "tiles", F.greatest(
        F.ceil(F.col("cells") / BLOCK_ROWS), F.ceil(F.col("terms") / BLOCK_TERMS)).cast("int").alias("blocks"))
    langs = _few(langs)
    tile = F.floor(F.col("place") / TILE).cast("int")
    cells = (kept.select("lang", "place", "term", "p").join(langs, "lang")
             .withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")))
    bases = (groups.select("lang", "place", F.lit(None).cast("string").alias("term"), F.col("base").alias("p")).join(langs, "lang")
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    both = cells.unionByName(bases).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    both = both.select("lang", F.least(tile, "with").alias("a"), F.greatest(tile, "with").alias("b"), "block", "place", "term", "p")
    sums = both.groupBy("lang", "a", "b", "block").applyInArrow(_blocks, "lang string, place int, other int, value long, seen long")
    return sums.groupBy("lang", "place", "other").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))


def source_divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
                      least_docs: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: the distance of the group to every other source of its
    language over all kept terms; part ``term``: the ``top`` terms in which the
    group exceeds its language most. Ranks go by value descending, then item.
    """
    counts = term_counts(docs, lang, source, text)
    term = Window.partitionBy("lang", "term")
    kept = (counts.withColumns({"lang_n": F.sum("n").over(term), "docs": F.sum("docs").over(term),
                                "first": F.row_number().over(term.orderBy("source")) == 1})
            .where(F.col("docs") >= least_docs).drop("docs"))
    kept = stored(kept, "kept-terms")
    sums = stored(kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if("first").alias("terms")), "term-totals")
    whole = sums.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("terms").alias("terms"))
    names = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")).distinct()
    groups = (names.join(sums.drop("terms"), ["lang", "source"], "left").join(whole, "lang", "left")
              .na.fill(0, ["total", "terms", "lang_total"])
              .withColumn("place", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("int"))
              .withColumn("base", _share(F.lit(0), F.col("total"), F.col("terms"))))
    groups = stored(groups, "source-groups")
    rows = (kept.join(_few(groups), ["lang", "source"])
            .withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms"))))

    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    above = (rows.withColumn("q", q).where(F.col("p") > F.col("q"))
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value")))
    # every block of a group gives its best, then the group's best are taken among those
    rank = F.row_number().over(Window.partitionBy("lang", "source", "block").orderBy(F.desc("value"), "item"))
    above = (above.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(64))).withColumn("rank", rank)
             .where(F.col("rank") <= top).drop("block", "rank"))

    other = groups.select("lang", F.col("place").alias("other"), F.col("source").alias("item"), F.col("base").alias("other_base"))
    pairs = (groups.join(other, "lang").where(F.col("place") != F.col("other"))
             .join(_between(rows, groups), ["lang", "place", "other"], "left"))
    unseen = (F.col("terms") - F.coalesce("seen", F.lit(0))) * _distance(F.col("base"), F.col("other_base"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item",
                         (F.coalesce("value", F.lit(0)) + F.coalesce(unseen, F.lit(0))).alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (above.unionByName(pairs).withColumn("rank", F.row_number().over(order).cast("int"))
            .where((F.col("part") == "pair") | (F.col("rank") <= top)))
