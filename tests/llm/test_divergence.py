"""Source divergence against a plain computation in Python integers."""

import random
import re
from collections import Counter, defaultdict

from wayfarer.llm.divergence import SCALE, source_divergence, terms_of

SCHEMA = "doc_id long, text string, lang string, source string, term string, value long, place int"


def brute(rows, least, top):
    word = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    groups, held = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        c = Counter(word.findall((text or "").translate(lower)))
        groups[lang or "", source or ""].update(c)
        held[lang or ""].update(c.keys())
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in held[lang].items() if n >= least]
        mine = {s: groups[lang, s] for la, s in groups if la == lang}
        total = sum(mine.values(), Counter())

        def share(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + SCALE * (c[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in mine.items()}, share(total)
        for s in mine:
            found = {"pair": [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in mine if o != s],
                     "term": [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if mine[s][t] and p[s][t] > q[t]]}
            for part, items in found.items():
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, t, v, r + 1) for r, (v, t) in enumerate(items if part == "pair" else items[:top])]
    return sorted(out)


def result(spark, rows, **kw):
    df = source_divergence(spark.createDataFrame(rows, SCHEMA), **kw)
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


def test_terms():
    assert [t.decode() for t in terms_of("Das É-x1y Z\x7fa_b\n".encode())] == ["das", "É", "x", "y", "z", "a", "b"]
    assert terms_of(None) == terms_of(b"") == terms_of(b" 12 .\x00") == []


def test_against_plain_computation(spark):
    rng = random.Random(3)
    words = [a + b for a in "abcdefghé" for b in ["", "a", "ß", "Ω", "zz"]]
    rows = []
    for i in range(400):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = "hot" if i % 3 == 0 else rng.choice(["s1", "s2", "S3", None, "ä"])
        text = None if i % 41 == 0 else " ".join(rng.choices(words, weights=range(1, len(words) + 1), k=rng.choice([0, 1, 9, 60])))
        rows.append((i % 300, text and text.title() + "!", lang, source, "x", 7, 1))
    rows += rows[:20] + [(1, "word " * 50_000, "en", "long", None, None, None), (2, "1 2 3", "xx", "only", None, None, None)]
    rows += [(3, "1", "yy", "a", None, None, None), (4, None, "yy", "b", None, None, None)]
    assert result(spark, rows) == brute(rows, 3, 200)
    assert result(spark, rows, least_docs=1, top=4) == brute(rows, 1, 4)


def test_more_sources_than_a_tile(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices("abcdefghij", k=4)), "en", f"s{i % 140}", None, None, None) for i in range(420)]
    assert result(spark, rows) == brute(rows, 3, 200)


def test_no_rows(spark):
    assert result(spark, []) == []
