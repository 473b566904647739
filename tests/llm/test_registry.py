"""Registered corpus queries: names, columns and the components helper."""

import numpy as np

import __spark_entry__ as E

COLUMNS = {
    "op1_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op2_quality": ["doc_id", "held_out", "score", "predicted"],
    "op3_class_lm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op4_warc_derivatives": ["page_id", "warc_type", "record_id", "refers_to", "target_uri"],
    "op5_ngram_join": ["doc_id", "n_shingles", "component_id"],
    "op6_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op7_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op8_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op9_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op10_ann_search": ["query_id", "rank", "vec_id", "score"],
}


def test_corpus_queries(spark):
    qs = E.queries()
    assert set(COLUMNS) <= set(qs) and "pipeline" in qs
    documents = spark.read.parquet(f"{E.SMOKE_DIR}/documents.parquet").count()
    pages = spark.read.parquet(f"{E.SMOKE_DIR}/pages.parquet").count()
    for name, rows in (("op4_warc_derivatives", 2 * pages), ("op6_sharding", documents), ("op8_language_id", documents)):
        df = qs[name](spark, E.SMOKE_DIR)
        assert df.columns[:len(COLUMNS[name])] == COLUMNS[name] and df.count() == rows
    df = qs["op9_packing"](spark, E.SMOKE_DIR)
    assert df.columns[:len(COLUMNS["op9_packing"])] == COLUMNS["op9_packing"] and df.count() >= documents


def test_components(spark):
    from wayfarer.llm.components import connected_components

    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, 2000)]
    links += [(5000, 5001 + i) for i in range(50)] + [(None, 3)]
    up = {}

    def root(a):
        up.setdefault(a, a)
        while up[a] != a:
            a = up[a]
        return a

    for a, b in links:
        if a is not None and a != b:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in up}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_runs(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "mix", "pack"]
    docs = spark.read.parquet(f"{E.SMOKE_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = corpus_pipeline.stored(stage(spark, docs, E.SMOKE_DIR), f"test-{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0 < docs.count() <= before * 3
    assert corpus_pipeline.STAGES[-1][1](spark, docs, E.SMOKE_DIR).count() >= docs.count()
