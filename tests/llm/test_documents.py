"""Document operators against brute force on small tables with every odd case."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), T.StructField("row_id", T.StringType()),
                     T.StructField("score", T.StringType()), T.StructField("part", T.StringType()),
                     T.StructField("size", T.StringType()), T.StructField("shard", T.StringType())])
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def frame(spark, rows):
    """Rows (doc_id, text, lang, source), with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 0, "a", "b", "c", "d", "e") for r in rows], DOCS)


def corpus(n=150, seed=2):
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        t = " ".join(rng.choice(vocab, rng.integers(1, 120), p=None))
        out.append((i, t.capitalize(), "en" if i % 2 else "de", f"s{i % 4}"))
    for k in range(40):                                      # near copies: a word or two changed
        w = out[k % 12 + 20][1].split()
        for _ in range(rng.integers(0, 3)):
            w[rng.integers(0, len(w))] = f"x{rng.integers(0, 9)}"
        out.append((1000 + k, " ".join(w), "en", "s0"))
    long = " ".join(rng.choice(vocab, 6000))
    out += [(2000, None, None, None), (2001, "", "en", "s1"), (2002, " \t\n ", None, None), (2003, "one", "en", "s1"),
            (2004, "ONE", "en", "s1"), (2005, "one two three", "en", "s1"), (2006, long, "en", "s2"), (2007, long + " end", "en", "s2"),
            (2008, "é É ß 日本語   x y 123 !!!", "fr", "Ä"), (None, "no id here at all", "en", "s1"),
            (2009, "same row", "en", "s3"), (2009, "same row", "en", "s3"), (2010, "12 34 ??", "en", "s3")]
    return out


# -- n-gram join ----------------------------------------------------------------

def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both and 100 * both >= percent * len(a | sets[j]):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return sets, [root(i) for i in range(len(rows))]


@pytest.mark.parametrize("k,percent,tile", [(4, 85, 16_384), (5, 80, 16)])
def test_ngram_components(spark, monkeypatch, k, percent, tile):
    from wayfarer.llm import ngram_join

    monkeypatch.setattr(ngram_join, "TILE_ROWS", tile)      # many tiles give the same groups
    monkeypatch.setattr(ngram_join, "THIN_ROWS", tile)
    rows = [(i, t) for i, t, _, _ in corpus()]
    df = frame(spark, corpus()).select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").alias("id"), "text")
    got = ngram_join.ngram_components(df, k, percent).collect()
    sets, root = components(rows, k, percent)
    want = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        want.append((d, len(sets[i]), min(ids, default=None) if sets[i] else d))
    assert sorted([(r.id, r.n_shingles, r.component_id) for r in got], key=str) == sorted(want, key=str)


def test_one_of_each_group(spark):
    from wayfarer.llm.ngram_join import one_of_each_group

    rows = corpus()
    df = frame(spark, rows)
    got = one_of_each_group(df, "doc_id", "text", 5, 80)
    assert got.columns == df.columns
    sets, root = components([(i, t) for i, t, _, _ in rows], 5, 80)
    assert got.count() == len({r for r, s in zip(root, sets) if s}) + sum(not s for s in sets)
    kept = Counter(r.doc_id for r in got.collect())
    assert kept[2009] == 1 and kept[2006] + kept[2007] == 1 and kept[2000] == 1 and kept[2001] == 1
    assert one_of_each_group(frame(spark, []), "doc_id", "text").count() == 0


def scan(spark, folder, rows, files=12):
    """The rows read from several files of unequal size."""
    for k in range(files):
        part = rows[k * len(rows) // files:(k + 1) * len(rows) // files][:None if k % 3 else 4]
        frame(spark, part).coalesce(1).write.mode("append").parquet(folder)
    return spark.read.parquet(folder)


def splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.mark.parametrize("step", ["rows", "near_duplicates", "mix"])
def test_rows_of_a_scan_keep_their_numbers_when_splits_move(spark, monkeypatch, tmpdir_path, step):
    from wayfarer.llm import mixing, ngram_join
    from wayfarer.llm.common import with_row_id

    df = scan(spark, f"{tmpdir_path}/docs", corpus())
    small, large = "3000", "100m"
    module = {"near_duplicates": ngram_join, "mix": mixing}.get(step)

    def run():
        if step == "near_duplicates":
            return ngram_join.one_of_each_group(df, "doc_id", "text", 5, 80, scanned=True)
        return mixing.repeated(df, scanned=True)

    before = {k: spark.conf.get(f"spark.sql.files.{k}") for k in ("maxPartitionBytes", "openCostInBytes")}
    try:
        splits(spark, large)
        if not module:
            kept = with_row_id(df, "test-rows", True)
            one = {r.row_id: r.row for r in kept.select("*").collect()}
            splits(spark, small)
            two = {r.row_id: r.row for r in kept.select("*").collect()}
            assert len(one) == df.count() and one == two
            return
        want = Counter(tuple(r) for r in run().collect())
        # the splits of the second scan are others than those of the first, as after the loss of an executor
        splits(spark, large)
        monkeypatch.setattr(module, "keep", lambda t, scope, f=module.keep: (splits(spark, small), f(t, scope))[1])
        assert Counter(tuple(r) for r in run().collect()) == want
    finally:
        for k, v in before.items():
            spark.conf.set(f"spark.sql.files.{k}", v)


# -- sharding -------------------------------------------------------------------

def test_sharding(spark):
    from wayfarer.llm.sharding import longest_first, sharded

    rows = corpus() + [(5000 + i, "the hot text", "en", "s0") for i in range(400)]
    got = sharded(frame(spark, rows), shards=4).collect()
    assert len(got) == len(rows)
    by_text, load, slots = {}, Counter(), {}
    text = {i: t for i, t, _, _ in rows}
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert r.size == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
        by_text.setdefault(raw, set()).add(r.shard)
        load[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(load.values()) / 4
    assert set(load) == {0, 1, 2, 3} and max(load.values()) <= max(1.02 * mean, len("a" * 13) * 400 + mean)
    assert longest_first([("a", 5), ("b", 4), ("c", 3), ("d", 3), ("e", 3)], 2) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}
    assert sharded(frame(spark, [])).count() == 0


# -- mixing ---------------------------------------------------------------------

def water(sizes, weights, passes):
    """Targets by raising the level step by step."""
    left, open_ = float(sum(sizes)), set(range(len(sizes)))
    out = [0.0] * len(sizes)
    while open_:
        level = left / sum(weights[i] for i in open_)
        met = {i for i in open_ if sizes[i] * passes <= level * weights[i]}
        if not met:
            for i in open_:
                out[i] = level * weights[i]
            break
        for i in met:
            out[i] = sizes[i] * passes
            left -= out[i]
        open_ -= met
    return out


def test_mixing(spark):
    from wayfarer.llm.mixing import mixed, repeated

    rows = corpus() + [(9000 + i, "w " * 30, "en", "zz") for i in range(2)]
    df = frame(spark, rows)
    got = mixed(df).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = dict(zip(order, water([sizes[s] for s in order], [i % 3 + 1 for i in range(len(order))], 3)))
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.times * r.size <= 3 * r.size
        taken[r.source] += r.taken
    most = max(len(words(t)) for _, t, _, _ in rows)
    assert all(abs(taken[s] - want[s]) <= 2 * most for s in order)
    assert sum(sizes.values()) - 2 * most <= sum(taken.values()) <= sum(sizes.values())
    assert sorted(map(str, got)) == sorted(map(str, mixed(df).collect()))
    again = repeated(df)
    assert again.columns == df.columns
    assert again.count() == sum(r.times if r.size else 1 for r in got)
    assert mixed(frame(spark, [])).count() == 0
    assert [r.times for r in mixed(frame(spark, [(1, None, None, None)])).collect()] == [0]


# -- packing --------------------------------------------------------------------

def test_plan_is_whole_and_tight():
    from wayfarer.llm.packing import plan_windows

    rng = np.random.default_rng(4)
    for counts in ({}, {1: 100}, {16: 3}, {9: 7}, {5: 4, 11: 4}, {3: 2, 6: 1, 7: 1, 16: 1},
                   {int(k): int(v) for k, v in zip(rng.permutation(16)[:9] + 1, rng.integers(1, 60, 9))}):
        places = plan_windows(counts, 16)
        fill, seen = Counter(), Counter()
        for length, first, last, sequence, per, offset in places:
            for k in range(last - first):
                seen[length, first + k] += 1
                fill[sequence + k // per] += length
                assert offset + (k % per + 1) * length <= 16
        assert seen == Counter({(n, i): 1 for n, c in counts.items() for i in range(c)})
        assert all(v <= 16 for v in fill.values())
        bound = -(-sum(n * c for n, c in counts.items()) // 16)
        assert bound <= len(fill) <= bound * 1.3 + 2
    assert len({p[3] for p in plan_windows({5: 4, 11: 4}, 16)}) == 1      # one exact shape, four windows of it


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from wayfarer.llm.packing import packed

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = corpus() + [(3000, "it's a <|endoftext|> x<|startoftext|>y don't 'S İstanbul Ǆ é naïve", "en", "s"),
                       (3001, "a\x1cb\x85c d", "en", "s")]
    got = packed(frame(spark, rows), window=256).collect()
    places, pieces = {}, {}
    for r in got:
        assert r.length == len(r.ids) <= 256 and r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, list(r.ids)))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    assert len(places) <= 1.05 * sum(r.length for r in got) / 256 + 2
    for i, t, _, _ in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        own = sorted(pieces[i], key=lambda p: p[:2])
        if i == 2009:
            own = own[::2]
        assert [x for p in own for x in p[2]] == ids
        assert [(p, s) for p, s, _ in own] == [(k, 256 * k) for k in range(-(-len(ids) // 256))]
    assert packed(frame(spark, [])).count() == 0


# -- language model -------------------------------------------------------------

def test_class_model(spark):
    from wayfarer.llm.class_lm import fit_class_model, score_class_model

    rows = corpus()
    df = frame(spark, rows)
    learn = [r for r in rows if r[0] is None or r[0] % 5 != 1]
    model, counts = fit_class_model(frame(spark, learn), core=40, dictionary=200, classes=6)
    got = score_class_model(df.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").alias("id"), "text"),
                            model, counts).collect()
    c = Counter()
    for _, t, _, _ in learn:
        c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    assert model.tokens == n and model.distinct == v and len(got) == len(rows)
    label = dict(zip(model.words, model.classes))
    emit = dict(zip(model.words, model.emissions))
    text = {i: t for i, t, _, _ in rows}
    for r in got:
        w = [*words(text[r.id]), None]
        assert r.n_tokens == len(w) and r.n_known == sum(c[x] > 0 for x in w) and r.train_tokens == n
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), abs=1e-9)
        before, total = model.end, 0.0
        for x in w:
            k = model.end if x is None else label.get(x.encode(), model.rest)
            total += model.transitions[before, k]
            if x is not None:
                total += emit[x.encode()] if x.encode() in emit else math.log10((c[x] + 0.5) / model.rest_total)
            before = k
        assert r.score == pytest.approx(total, abs=1e-9)
        assert r.perplexity == pytest.approx(10 ** (-total / len(w)))
    # the model is a distribution: transitions of every class, and words of every class with one never seen
    assert np.allclose((10 ** model.transitions).sum(axis=1), 1)
    for k in range(model.rest):
        own = [e for w, e in emit.items() if label[w] == k]
        assert not own or sum(10 ** e for e in own) == pytest.approx(1)
    rest = [c[x] + 0.5 for x in c if x is not None and label.get(x.encode(), model.rest) == model.rest]
    assert (sum(rest) + 0.5) / model.rest_total == pytest.approx(1)


def test_neighbour_counts_of_many_tasks(spark, monkeypatch):
    from wayfarer.llm import class_lm

    monkeypatch.setattr(class_lm, "TOKENS", 50)
    texts = [t for _, t, _, _ in corpus()]
    known = [f"w{i}".encode() for i in range(30)]
    pairs = class_lm.count_neighbours(frame(spark, corpus()).repartition(40), known)
    want = np.zeros((32, 32), dtype=np.int64)
    number = {w.decode(): i for i, w in enumerate(known)}
    for t in texts:
        ids = [31, *(number.get(w, 30) for w in words(t)), 31]
        np.add.at(want, (ids[:-1], ids[1:]), 1)
    got = np.zeros_like(want)
    for r in pairs.collect():
        got[r.a, r.b] += r.n
    assert np.array_equal(got, want)
    # classes of the words, and the class that fits each word of a range, against every class tried
    label = np.array([i % 3 if i < 12 else 3 for i in range(31)] + [4], dtype=np.int32)
    table = class_lm._class_table(pairs, label, 5)
    one = np.eye(5)[label]
    assert np.array_equal(table, one.T @ want @ one)
    best = class_lm._best_classes(pairs, label, table, 3, 12, 30)
    p = np.log((table + 0.5) / (table + 0.5).sum(axis=1, keepdims=True))
    q = np.log((table.T + 0.5) / (table.T + 0.5).sum(axis=1, keepdims=True))
    for w in range(12, 30):
        fit = [sum(want[w, x] * p[c, label[x]] + want[x, w] * q[c, label[x]] for x in range(32)) for c in range(3)]
        assert fit[best[w - 12]] == pytest.approx(max(fit)) if want[w].any() else best[w - 12] == 3


def test_words_beyond_the_core_find_their_classes(spark):
    from wayfarer.llm.class_lm import fit_class_model

    # three kinds of words that follow each other in turn; words of a kind differ in how often they occur
    rng = np.random.default_rng(8)
    kinds = [[f"{k}{i}" for i in range(40)] for k in "abc"]
    share = 1 / np.arange(1, 41)
    rows = [(i, " ".join(rng.choice(kinds[(i + j) % 3], p=share / share.sum()) for j in range(60)), "en", "s") for i in range(400)]
    model, _ = fit_class_model(frame(spark, rows), core=12, classes=3)
    by = {}
    for w, c in zip(model.words, model.classes):
        by.setdefault(w[:1], set()).add(int(c))
    assert len(model.words) > 100 and all(len(x) == 1 for x in by.values()) and len(set.union(*by.values())) == 3


def test_most_frequent_words(spark):
    from wayfarer.llm.class_lm import most_frequent

    table = [(f"w{i:02d}".encode(), 7) for i in range(50)] + [(b"top", 900), (b"", 5000), (b"once", 1)]
    df = spark.createDataFrame(table, "word binary, n long")
    assert most_frequent(df, 41)[0] == [b"top"] + [f"w{i:02d}".encode() for i in range(40)]
    assert len(most_frequent(df, 100)[0]) == 51 and most_frequent(df.where("n = 7"), 3)[0] == [b"w00", b"w01", b"w02"]


def test_class_model_of_nothing(spark):
    from wayfarer.llm.class_lm import fit_class_model, score_class_model

    rows = frame(spark, [(1, "a b", "en", "s"), (2, None, "en", "s")])
    model, counts = fit_class_model(frame(spark, []), classes=4)
    got = score_class_model(rows.select(F.lit(1).cast("long").alias("row_id"), F.col("doc_id").alias("id"), "text").where("id = 1"),
                            model, counts).collect()
    assert got[0].n_known == 0 and math.isfinite(got[0].score) and got[0].base_score == pytest.approx(0.0)


def test_exchange_raises_likelihood():
    from wayfarer.llm.class_lm import exchange_classes

    rng = np.random.default_rng(0)
    true = np.arange(30) % 3
    counts = np.zeros((32, 32), dtype=np.int64)
    for a in range(30):
        for b in range(30):
            counts[a, b] = rng.poisson(20 if true[b] == (true[a] + 1) % 3 else 0.3)
    perm = rng.permutation(30)
    counts[:30, :30] = counts[:30, :30][np.ix_(perm, perm)]
    label = exchange_classes(counts, 3)
    assert len({(label[i], true[perm[i]]) for i in range(30)}) == 3


# -- classifiers ----------------------------------------------------------------

def test_quality(spark):
    from wayfarer.llm.quality import features, fit_quality, keep_quality, score_quality

    rng = np.random.default_rng(3)
    good = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "of", "the"], 30)) + ".", "en", "s") for i in range(200)]
    bad = [(1000 + i, " ".join(rng.choice(["alpha%%%", "beta&&&", "x$$$", "|"], 30)), "en", "s") for i in range(200)]
    odd = [(2000, None, None, None), (2001, "", None, None), (2002, "spam " * 5000, "en", "s")]
    df = frame(spark, good + bad + odd)
    labels = spark.createDataFrame([(i, 1, 0) for i, *_ in good[:150]] + [(i, 0, 0) for i, *_ in bad[:150]] + [(7777, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    w = fit_quality(df, labels)
    got = {r.id: r.score for r in score_quality(df, w).collect()}
    assert all(got[i] > 0.5 for i, *_ in good[150:]) and all(got[i] < 0.3 for i, *_ in bad[150:])
    assert got[2000] == got[2001] == pytest.approx(1 / (1 + math.exp(-w[-1])))
    assert np.array_equal(w, fit_quality(df, labels))
    at, v = features(b"Ab ab ab cd")
    direct = sum(float(w[a]) * float(x) for a, x in zip(at, v)) + float(w[-1])
    one = score_quality(frame(spark, [(1, "Ab ab ab cd", "en", "s")]), w).first().score
    assert one == pytest.approx(1 / (1 + math.exp(-direct)), rel=1e-5)
    kept = keep_quality(df, w, least=0.3)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s >= 0.3}
    none = fit_quality(df, labels.where("false"))
    assert {r.score for r in score_quality(df, none).collect()} == {0.5}
    assert score_quality(frame(spark, []), w).count() == 0


def test_language(spark):
    from wayfarer.llm.langid import fit_language, identify_language, keep_language

    rng = np.random.default_rng(6)
    parts = {"en": ["th", "er", "ing", "on", "wh"], "fr": ["é", "eau", "que", "ll", "oi"], "de": ["sch", "ü", "ung", "ei", "ch"]}

    def text(k):
        return " ".join("".join(rng.choice(parts[k], 3)) for _ in range(20)).capitalize()

    rows = [(i, text(k), k, "s") for i, k in enumerate(sorted(parts) * 60)]
    odd = [(900, None, "en", "s"), (901, "", "en", "s"), (902, "12 ?! 34", "en", "s"), (903, text("fr") * 500, None, "s")]
    df = frame(spark, rows + odd)
    model = fit_language(df.where("doc_id % 5 <> 1 or doc_id >= 900"), landmarks=8)
    got = {r.id: (r.lang_pred, r.score) for r in identify_language(df, model).collect()}
    assert model.languages == ["de", "en", "fr"] and all(0 <= s <= 1 for _, s in got.values())
    assert np.mean([got[i][0] == k for i, _, k, _ in rows]) > 0.98
    assert got[900] == got[901] == got[902] == ("und", 0.0) and got[903][0] == "fr"
    kept = keep_language(df, model)
    assert kept.columns == df.columns and kept.count() == len(rows) + 1
    empty = fit_language(frame(spark, []))
    assert {r.lang_pred for r in identify_language(df, empty).collect()} == {"und"}


def test_language_drops_what_is_in_no_learnt_language(spark):
    import __spark_entry__ as E
    from wayfarer.llm.langid import KNOWN, LEAST, _LETTER, fit_language, identify_language, keep_language, presence_rows

    clean = spark.read.parquet(f"{E.SMOKE_DIR}/documents.parquet").select("doc_id", "text", "lang")
    rng = np.random.default_rng(1)
    junk = ["".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), 200)), "<div><td class='x'></td></div><br/>" * 20,
            "日本語のテキストです。これは学習されていない" * 3, '{"a": [1,2,{"b": null}]}' * 10]
    odd = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate([*junk, None, "", "12 ?!"])], clean.schema)
    docs = clean.unionByName(odd)
    model = fit_language(docs)
    kept = {r.doc_id for r in keep_language(docs, model).collect()}
    rows = {r.doc_id: r.text for r in docs.collect()}
    lettered = {i for i, t in rows.items() if t and _LETTER.search(t)}
    assert kept == {i for i in lettered if i >= 0}
    # the same by brute force from every text's score and n-grams
    score = {r.id: r.score for r in identify_language(docs, model).collect()}
    known = set(np.flatnonzero(model.matrix.any(axis=1)))
    grams = {i: set(np.flatnonzero(presence_rows([rows[i]])[0])) for i in lettered}
    assert kept == {i for i in lettered if score[i] >= LEAST or len(grams[i] & known) >= KNOWN * len(grams[i])}
    # with nothing learnt, all that have letters stay
    nothing = fit_language(docs.where("lang is null"))
    assert {r.doc_id for r in keep_language(docs, nothing).collect()} == lettered


def test_kernel_matrix_is_the_kernel_regression():
    from wayfarer.llm import langid

    texts = ["the thing on when", "where the ring", "eau que oui", "la belle eau", "schule und buch", "das ist ein buch"]
    p = langid.presence_rows(texts)
    y = np.array([0, 0, 1, 1, 2, 2])
    m = langid.ridge_matrix(np.packbits(p.astype(np.uint8), axis=1, bitorder="little"), y, 3, 2, 0.1)
    # with every text a landmark, the coordinates reproduce the kernel: plain kernel ridge regression
    sets = [set(np.flatnonzero(r)) for r in p]
    k = np.array([[len(a & b) / math.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    target = np.where(y[:, None] == np.arange(3), 1.0, -1.0)
    plain = k @ np.linalg.solve(k + 0.1 * np.eye(6), target)
    folded = (p @ m) / np.sqrt(p.sum(axis=1, keepdims=True))
    assert np.allclose(plain, folded, atol=1e-3)


def test_words_with_marks_need_no_pattern():
    from wayfarer.llm.packing import WordTokens

    words = WordTokens("word_bpe_49k.json")
    chunks = ["Harbour", "réier.", "ÉTÉ,", "end?!", "a", "ªº...", "x)\""]
    want = [words.tokenizer.encode(c, add_special_tokens=False).ids for c in chunks]
    words.split = None                       # the general way is not asked
    assert [np.frombuffer(words.ids(c.encode()), dtype="<u4").tolist() for c in chunks] == want
    odd = WordTokens("word_bpe_49k.json")
    for c in ["it's", "'ll", "a1.", "<|endoftext|>", "é́.", "ſt.", "日本.", "--", "x.y", "İ", "don't!", "ŵord,"]:
        assert np.frombuffer(odd.ids(c.encode()), dtype="<u4").tolist() == odd.tokenizer.encode(c, add_special_tokens=False).ids
