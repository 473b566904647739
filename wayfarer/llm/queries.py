"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector at cosine 0.95."""
    from wayfarer.llm.embedding_dedup import near_duplicate_vectors

    out = near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", threshold=0.95)
    return out.withColumnRenamed("id", "vec_id")


def op10_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, by inner product."""
    from wayfarer.llm.ann_search import nearest_neighbours

    vectors = _table(spark, sf_dir, "embeddings")
    out = nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 20 == 0), "vec_id", "embedding", k=20)
    return out.withColumnRenamed("id", "vec_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; learnt from rows outside fold 0 of 5."""
    from wayfarer.llm.common import fold_of
    from wayfarer.llm.quality import fit_quality, score_quality

    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    weights = fit_quality(docs, labels.where(fold_of("doc_id", 5) != 0))
    return score_quality(docs, weights).withColumnRenamed("id", "doc_id").select(
        "doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-bigram and single-word log10 probability of every document; learnt from rows outside fold 1 of 5."""
    from wayfarer.llm.class_lm import fit_class_model, score_class_model
    from wayfarer.llm.common import fold_of

    docs = _table(spark, sf_dir, "documents")
    model, counts = fit_class_model(docs.where(fold_of("doc_id", 5) != 1).select("text"))
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").alias("id"), "text")
    return score_class_model(rows, model, counts).withColumnRenamed("id", "doc_id").select(
        "doc_id", (fold_of("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "perplexity")


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and the conversion record of every page's response."""
    from wayfarer.llm.warc import derivatives, responses_of_pages

    return derivatives(responses_of_pages(_table(spark, sf_dir, "pages"))).withColumnRenamed("id", "page_id")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id at 4 words and Jaccard 0.85."""
    from wayfarer.llm.ngram_join import ngram_components

    docs = _table(spark, sf_dir, "documents")
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").alias("id"), "text")
    return ngram_components(rows, k=4, percent=85).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; groups of equal text stay together, bytes are balanced."""
    from wayfarer.llm.sharding import sharded

    return sharded(_table(spark, sf_dir, "documents"), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, source weights 1, 2, 3 repeating."""
    from wayfarer.llm.mixing import mixed

    return mixed(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learnt from rows outside fold 1 of 3."""
    from wayfarer.llm.common import fold_of
    from wayfarer.llm.langid import fit_language, identify_language

    docs = _table(spark, sf_dir, "documents")
    model = fit_language(docs.where(fold_of("doc_id", 3) != 1))
    return identify_language(docs, model).withColumnRenamed("id", "doc_id").select(
        "doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 tokens."""
    from wayfarer.llm.packing import packed

    return packed(_table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the bytes that 50-byte strings of documents with smaller ids cover."""
    from wayfarer.llm.suffix_dedup import repeated_spans

    out = repeated_spans(_table(spark, sf_dir, "documents"), "doc_id", "text", length=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of every language by how much more often than its parts foretell each occurs."""
    from wayfarer.llm.collocation import collocations

    return collocations(_table(spark, sf_dir, "documents"), least=100, longest=5, percent=100, top=2000)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of a language, and each source's 200 most excessive terms."""
    from wayfarer.llm.divergence import source_divergence

    return source_divergence(_table(spark, sf_dir, "documents"), least_docs=3, top=200)


QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_quality, op3_class_lm, op4_warc_derivatives, op5_ngram_join,
                                   op6_sharding, op7_mixing, op8_language_id, op9_packing, op10_ann_search, op11_suffix_dedup, op12_collocations,
                                   op13_source_divergence)}
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_USABLE = ("embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 "
           "AND len(list_filter(embedding, lambda x: x <> 0)) > 0")

ORACLE: dict[str, str] = {
    "op1_embedding_dedup": f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE {_USABLE}),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
          WHERE len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.r),
low AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
deg AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM low LEFT JOIN deg USING (vec_id)""",
    "op5_ngram_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] AS g
       FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 4)
       UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(*) AS c FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT p.a, p.b FROM pairs p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
          WHERE 100 * p.c >= 85 * (x.c + y.c - p.c)),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT reach.doc_id, coalesce(min(n.c), 0) AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = reach.doc_id GROUP BY reach.doc_id""",
    "op7_mixing": f"""
WITH d AS (SELECT doc_id, source, coalesce(len({_WORDS.format('text')}), 0) AS size,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM s),
w AS (SELECT *, CAST(place % 3 + 1 AS DOUBLE) AS weight, source_size * 3 AS lim,
             CAST(sum(source_size) OVER () AS BIGINT) AS total FROM p),
o AS (SELECT *, row_number() OVER (ORDER BY lim / weight, place) AS k,
             CAST(coalesce(sum(lim) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS gone,
             sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
      FROM w),
r AS (SELECT *, (total - gone) / rest AS rate FROM o),
lev AS (SELECT arg_min(rate, k) FILTER (WHERE NOT (lim <= rate * weight)) AS level FROM r),
t AS (SELECT source, source_size, place, total,
             CASE WHEN level IS NULL THEN CAST(lim AS DOUBLE) ELSE least(CAST(lim AS DOUBLE), level * weight) END AS target
      FROM r, lev),
q AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.place, t.total, d.h,
             sum(d.size) OVER (PARTITION BY t.place ORDER BY d.h, d.doc_id) AS fin
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
turns AS (SELECT *, unnest(range(CAST(1 + least(2, floor(target / source_size)) AS BIGINT))) AS pass
          FROM q WHERE size > 0 AND target > 0),
z AS (SELECT doc_id, size, total,
             sum(size) OVER (ORDER BY (fin + pass * source_size) / target, place, h, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM turns),
taken AS (SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM z WHERE upto <= total GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(taken.taken, 0) AS taken FROM q LEFT JOIN taken USING (doc_id)""",
    "op10_ann_search": f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE {_USABLE} AND vec_id IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0 AND len(q.x) = len(c.x)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op13_source_divergence": r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS k,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT lang, source, k, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
tot AS (SELECT lang, sum(c)::HUGEINT AS n, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
gn AS (SELECT grp.lang, grp.source, coalesce(sum(c), 0)::HUGEINT AS n FROM grp LEFT JOIN cnt USING (lang, source) GROUP BY ALL),
p AS (SELECT gn.lang, gn.source, kept.term, coalesce(cnt.c, 0) AS c,
             1 + (1000000000::HUGEINT * (coalesce(cnt.c, 0) + 1)) // (gn.n + tot.v) AS p,
             1 + (1000000000::HUGEINT * (kept.c + 1)) // (tot.n + tot.v) AS ql
      FROM gn JOIN kept USING (lang) JOIN tot USING (lang) LEFT JOIN cnt ON cnt.lang = gn.lang AND cnt.source = gn.source AND cnt.term = kept.term),
pairs AS (SELECT a.lang, a.source, b.source AS item,
                 coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // y.p) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
                           WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source),
o AS (SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value FROM pairs
      UNION ALL SELECT lang, source, 'term', term, CAST(((p - ql) * (p - ql)) // ql AS BIGINT) FROM p WHERE c > 0 AND p > ql),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM o)
SELECT * FROM r WHERE part = 'pair' OR rank <= 200""",
    "op11_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT doc_id, i, h[2 * i + 1:2 * i + 100] AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)),
low AS (SELECT s, min(doc_id) AS m FROM g GROUP BY s),
hit AS (SELECT g.doc_id, g.i FROM g JOIN low USING (s) WHERE low.m < g.doc_id),
runs AS (SELECT doc_id, i, sum(CASE WHEN i <= prev + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
         FROM (SELECT *, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -100) AS prev FROM hit)),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM spans),
pieces AS (SELECT doc_id, string_agg(h[2 * since + 1:2 * a], '' ORDER BY a) AS kept FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
tot AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS n, max(b) AS last FROM spans GROUP BY doc_id)
SELECT d.doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n IS NULL THEN h ELSE kept || h[2 * last + 1:] END)) AS kept_sha256
FROM d LEFT JOIN tot USING (doc_id) LEFT JOIN pieces USING (doc_id)""",
    "op12_collocations": rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM d),
tot AS (SELECT lang, CAST(sum(len(ws)) AS HUGEINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, m, count(*) AS a
      FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, range(1, 6) AS x(m) WHERE len(ws) >= m)
      GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT * FROM g WHERE m >= 2),
s AS (SELECT c.lang, c.phrase, c.a, c.m, string_split(c.phrase, ' ') AS ws FROM c),
cuts AS (SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS p1, array_to_string(ws[k + 1:m], ' ') AS p2
         FROM (SELECT *, unnest(range(1, m)) AS k FROM s)),
sc AS (SELECT cuts.*, x.a AS l, y.a AS r, tot.n, CAST((1000::HUGEINT * cuts.a * tot.n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
       FROM cuts JOIN g x ON x.lang = cuts.lang AND x.phrase = p1 JOIN g y ON y.lang = cuts.lang AND y.phrase = p2 JOIN tot ON tot.lang = cuts.lang),
b AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = b.lang AND c.a >= b.a AND c.phrase <> b.phrase
                                           AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' '))),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM r WHERE rank <= 2000""",
}
