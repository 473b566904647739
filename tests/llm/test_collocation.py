"""Phrase mining against a plain computation over all phrases."""

import random
import re
from collections import Counter

from wayfarer.llm.collocation import collocations

SCHEMA = "doc_id long, text string, lang string, gram string, n long, key string, part int"


def brute(rows, least, longest, percent, top):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, total = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            ws = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for i in range(len(ws)):
                for m in range(1, longest + 1):
                    if i + m <= len(ws):
                        f[lang, tuple(ws[i:i + m])] += 1
    cand = {g: n for g, n in f.items() if n >= least and len(g[1]) >= 2}
    gone = set()
    for (lang, ws), n in cand.items():
        for i in range(len(ws)):
            for j in range(i + 2, len(ws) + 1):
                if j - i < len(ws) and 100 * n >= percent * cand[lang, ws[i:j]]:
                    gone.add((lang, ws[i:j]))
    out = {}
    for (lang, ws), a in cand.items():
        if (lang, ws) in gone:
            continue
        cuts = [(1000 * a * total[lang] // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    return sorted((lang, r + 1, p.decode(), -a, le, ri, total[lang], -s)
                  for lang, found in out.items() for r, (s, a, p, le, ri) in enumerate(sorted(found)[:top]))


def result(spark, rows, **kw):
    df = collocations(spark.createDataFrame(rows, SCHEMA), **kw)
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


def corpus(seed, docs):
    rng = random.Random(seed)
    words = ["the", "of", "The", "é", "\x01x", "x\x1f", "on", "a", "über", "b", "c", "d-d", "z"] + [f"w{i}" for i in range(60)]
    line = "in the name of the law we trust"
    rows = []
    for i in range(docs):
        lang = rng.choice(["en", "en", "de", None, ""])
        parts = []
        for _ in range(rng.choice([0, 1, 3, 8])):
            parts.append(" ".join(rng.choices(words, weights=[80 // (j + 1) + 1 for j in range(len(words))], k=rng.randrange(1, 12))))
            if rng.random() < 0.4:
                parts.append(line)
        text = "".join(p + rng.choice([". ", "\n", "!", " ", "\t ", "\x0b", "  "]) for p in parts)
        rows.append((i % 50, text if i % 37 else None, lang, "g", 1, None, None))
    return rows


def test_against_plain_computation(spark):
    rows = corpus(1, 300)
    rows += rows[:30] + [(9, "", "fr", None, None, None, None), (9, "again and " * 30_000, "long", None, None, None, None)]
    for kw in ({"least": 5, "longest": 5, "percent": 100, "top": 2000}, {"least": 3, "longest": 3, "percent": 60, "top": 7},
               {"least": 2, "longest": 2, "percent": 100, "top": 2000}):
        got = result(spark, rows, **kw)
        assert got == brute(rows, **kw) and len(got) > 10


def test_one_family_over_many_ranges(spark):
    """Every phrase begins, or ends, with the same word, so ranges start inside a family."""
    rng = random.Random(5)
    rows = [(i, " ".join(["x"] * rng.randrange(1, 6) + [rng.choice("pqrs")] * rng.randrange(3) + ["x"] * rng.randrange(4)), "en", "", 0, "", 0)
            for i in range(400)]
    kw = {"least": 2, "longest": 5, "percent": 100, "top": 50}
    assert result(spark, rows, **kw) == brute(rows, **kw)


def test_nothing_frequent(spark):
    assert result(spark, []) == [] and result(spark, corpus(2, 20), least=10_000) == []
