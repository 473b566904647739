"""Repeated ids, many languages and odd characters: results that neither partitioning nor repetition changes."""

import random

import numpy as np


def test_mix_is_the_same_under_any_partitioning(spark):
    from wayfarer.llm.mixing import mixed, repeated

    rng = random.Random(4)
    rows = [(i % 7, " ".join(rng.choices("abcdef", k=rng.randrange(1, 9))), rng.choice(["s", "t", None]), 1) for i in range(120)]
    rows += rows[:10] + [(None, "x y", "s", 1), (None, "z", "s", 1), (3, None, "t", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int")
    found = []
    for parts in (1, 3, 5):
        plan = mixed(df.repartition(parts)).select("doc_id", "source", "size", "taken").collect()
        texts = repeated(df.repartition(parts)).collect()
        found.append((sorted(map(str, plan)), sorted(map(str, texts))))
    assert found[0] == found[1] == found[2]


def test_quality_learns_one_text_of_an_id(spark, monkeypatch):
    from wayfarer.llm import quality

    docs = spark.range(4000).selectExpr("cast(if(id < 3000, 0, id) as long) as doc_id", "concat('word', id, ' good text') as text")
    labels = spark.range(4000).where("id = 0 or id >= 3000").selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    monkeypatch.setattr(quality, "ftrl", lambda rows, labels, bits, epochs: np.array([len(rows), labels.sum()], np.float32))
    assert list(quality.fit_quality(docs, labels)) == [1001, 500]
    assert list(quality.fit_quality(docs.repartition(7), labels.union(labels))) == [1001, 500]


def test_every_language_is_learnt(spark):
    from wayfarer.llm.langid import fit_language, identify_language

    # 300 languages, each with words of its own; one document stands there very often
    rows = [(i, f"{chr(0x4E00 + 7 * (i % 300)) * 3} {chr(0x4E00 + 7 * (i % 300) + 1) * 2}", f"l{i % 300:03}") for i in range(1500)]
    df = spark.createDataFrame(rows + [rows[0]] * 3000, "doc_id long, text string, lang string")
    model = fit_language(df)
    assert len(model.languages) == 300
    got = {r.id: r.lang_pred for r in identify_language(df, model).collect()}
    assert np.mean([got[i] == k for i, _, k in rows]) > 0.99
    odd = spark.createDataFrame([(1, "² ½ ①"), (2, "१२३ _"), (3, "ª"), (4, "1 a"), (5, "ⅷ")], "doc_id long, text string")
    und = {r.id for r in identify_language(odd, model).collect() if r.lang_pred == "und"}
    assert und == {1, 2, 5}
