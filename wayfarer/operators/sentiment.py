"""Lexicon-based review sentiment as a Spark job.

Whole review texts are tokenised once, on the executors: runs of letters of any
script, with apostrophes inside them (``isn't`` is one token; the apostrophe is
dropped before any lookup), and the lexicon's emoticons where they stand between
blanks. Tokens are generated as narrow rows (key, place, word), and only those
of the vocabulary go on as events: lexicon words, words of phrases, and words
that the rules name. All a word's neighbourhood can matter by are events too, so
neighbours are found by their places among a review's events; a review without
events is neutral and makes no rows at all.

Lexicon entries of several words are phrases: n-grams of consecutive events from
a phrase's first word on are looked up by hash for each phrase length, and the
longest match at a place counts. Of matches that overlap the longer one stands,
of equal ones the first. The words inside a phrase take no further part.

Scores follow the published valence-aware rules:

* a token in capitals, in a text that is not all capitals, weighs 0.733 more;
* degree words and phrases ("kind of") that end among the three tokens before
  move the valence by 0.293 (0.95 and 0.9 of it from two and three tokens away), a
  lexicon word in that place takes no part;
* a negation among the three tokens before multiplies by -0.74 ("never so" and
  "never this" by 1.25, "without doubt" leaves it), so does "least" right
  before, but for "at least" and "very least";
* what precedes the first "but" counts half, what follows it one and a half;
* up to four "!" add 0.292 each, two or three "?" 0.18 each, more 0.96, away
  from zero.

compound = s / sqrt(s^2 + 15) with s the sum of valences; pos / neg / neu are the
shares of (v + 1), |v - 1| and neutral tokens. A review without text or without
tokens scores (0, 0, 1, 0). ``key`` names a review; of repeated lexicon entries
the largest valence counts.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfarer.schema import SENTIMENT_COLUMNS
from wayfarer.session import materialize, spread_if_narrow

# --- Fixed values (must equal the published rules), without apostrophes --------
NEGATIONS = [
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "despite", "didnt", "doesnt", "dont",
    "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neednt", "neither", "never",
    "none", "nope", "nor", "not", "nothing", "nowhere", "oughtnt", "rarely", "seldom", "shant", "shouldnt",
    "uhuh", "wasnt", "werent", "without", "wont", "wouldnt",
]
INTENSIFIERS = [
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably", "decidedly", "deeply",
    "enormous", "enormously", "entirely", "especially", "exceptional", "exceptionally", "extreme", "extremely",
    "fabulously", "fully", "greatly", "hella", "highly", "hugely", "incredible", "incredibly", "intensely",
    "major", "majorly", "more", "most", "particularly", "purely", "quite", "really", "remarkably", "so",
    "substantially", "thoroughly", "total", "totally", "tremendous", "tremendously", "uber", "unbelievably",
    "unusually", "utter", "utterly", "very",
]
DIMINISHERS = [
    "almost", "barely", "hardly", "kinda", "kindof", "less", "little", "marginal", "marginally", "occasional",
    "occasionally", "partly", "scarce", "scarcely", "slight", "slightly", "somewhat", "sorta", "sortof",
]
DIMINISHING_PHRASES = ["kind of", "sort of", "just enough"]
DEGREE, CAPITALS, NEGATION_SCALAR = 0.293, 0.733, -0.74
DISTANCE = (1.0, 0.95, 0.9)
ALPHA = 15.0
# -------------------------------------------------------------------------------
TOKEN_PATTERN = r"\p{L}+(?:['’]\p{L}+)*"
MAX_BROADCAST_LEXICON = 2_000_000
#: Emoticons (entries that are no words) that a lexicon may have; they become one pattern.
MAX_EMOTICONS = 1_000
_BLANKS = r" \t\n\r\f\x0B"
# what the rules take a word for
NEGATION, NEVER, WITHOUT, EMPHATIC, DOUBT, LEAST, AT_OR_VERY, BUT = range(1, 9)


def lexicon_frame(spark: SparkSession, entries: Iterable[tuple[str, float]]) -> DataFrame:
    return spark.createDataFrame(list(entries), "token string, valence double")


def _plain(word: Column) -> Column:
    """How a token is looked up: without apostrophes, in lower case; emoticons without letters as they are."""
    return F.when(F.upper(word) == F.lower(word), word).otherwise(F.lower(F.translate(word, "'’", "")))


def _is_capitals(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


def _rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A few fixed rows (words without quotes, numbers, null) as one literal table."""
    literal = lambda v: "null" if v is None else f"'{v}'" if isinstance(v, str) else str(v).lower()
    names = [c.split(" ") for c in schema.split(", ")]
    values = ", ".join(f"({', '.join(map(literal, row))})" for row in rows)
    columns = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in names)
    return spark.sql(f"SELECT {columns} FROM VALUES {values} AS fixed({', '.join(n for n, _ in names)})")


def _rule_words(spark: SparkSession) -> DataFrame:
    code = {w: NEGATION for w in NEGATIONS} | {"never": NEVER, "without": WITHOUT, "so": EMPHATIC, "this": EMPHATIC, "doubt": DOUBT,
                                              "least": LEAST, "at": AT_OR_VERY, "very": AT_OR_VERY, "but": BUT}
    degree = {w: DEGREE for w in INTENSIFIERS} | {w: -DEGREE for w in DIMINISHERS}
    return _rows(spark, "token string, valence double, degree double, code int, head boolean, m int",
                 [(w, None, degree.get(w), code.get(w), False, 1) for w in sorted({*code, *degree})])


def _vocabulary(lexicon: DataFrame) -> tuple[DataFrame, DataFrame, list[int], str]:
    """Tokens with what they mean, phrases (token holds the n-gram, m its length), the phrases' lengths, and the token pattern.

    Written once: tokens have m = 1, phrases more, emoticons as the lexicon writes them 0.
    """
    spark = lexicon.sparkSession
    none = lambda t: F.lit(None).cast(t)
    parts = F.split(F.btrim("token"), " +")
    entries = lexicon.select(F.transform(parts, _plain).alias("words"), F.col("valence").cast("double").alias("valence"),
                             none("double").alias("degree"), parts.alias("raw")).where(F.col("token") != "")
    fixed = _rows(spark, "words string, valence double, degree double", [(p, None, -DEGREE) for p in DIMINISHING_PHRASES])
    known = entries.drop("raw").unionByName(fixed.withColumn("words", F.split("words", " ")))
    size = F.size("words")
    whole = known.select(F.array_join("words", " ").alias("token"), "valence", "degree", none("int").alias("code"),
                         F.lit(False).alias("head"), size.alias("m"))
    inner = known.where(size > 1).select(F.posexplode("words").alias("at", "token")).select(
        "token", none("double").alias("valence"), none("double").alias("degree"), none("int").alias("code"),
        (F.col("at") == 0).alias("head"), F.lit(1).alias("m"))
    faces = entries.select(F.explode("raw").alias("token")).where(~F.col("token").rlike(f"^(?:{TOKEN_PATTERN})$")).select(
        "token", none("double").alias("valence"), none("double").alias("degree"), none("int").alias("code"),
        F.lit(False).alias("head"), F.lit(0).alias("m"))
    table = whole.unionByName(inner).unionByName(_rule_words(spark)).unionByName(faces).groupBy("m", "token").agg(
        F.max("valence").alias("valence"), F.max("degree").alias("degree"), F.max("code").alias("code"), F.bool_or("head").alias("head"))
    table = materialize(table, "lexicon")
    counts = {r.m: r.n for r in table.groupBy("m").agg(F.count("*").alias("n")).collect()}
    pattern = TOKEN_PATTERN
    if counts.get(0, 0) > MAX_EMOTICONS:
        raise ValueError(f"a lexicon may have at most {MAX_EMOTICONS} entries that are no words")
    if counts.get(0):
        odd = sorted((r.token for r in table.where("m = 0").select("token").collect()), key=lambda w: (-len(w), w))
        pattern = f"(?<![^{_BLANKS}])(?:{'|'.join(f'\\Q{w}\\E' for w in odd)})(?![^{_BLANKS}])|{pattern}"
    if sum(counts.values()) <= MAX_BROADCAST_LEXICON:
        table = F.broadcast(table)
    return table.where("m = 1").drop("m"), table.where("m > 1"), sorted(m for m in counts if m > 1), pattern


def _units(events: DataFrame, phrases: DataFrame, lengths: list[int], key: str) -> DataFrame:
    """Events with phrases put together: ``_end`` is a phrase's last place; words inside a phrase are gone."""
    w = Window.partitionBy(key).orderBy("_pos")
    at = F.col("_pos")
    ev = events
    for m in lengths:
        gram = F.concat_ws(" ", "token", *[F.lead("token", i).over(w) for i in range(1, m)])
        ev = ev.withColumn(f"_g{m}", F.when(F.col("head") & (F.lead("_pos", m - 1).over(w) == at + (m - 1)), gram))
    for m in lengths:
        table = phrases.where(F.col("m") == m).select(F.col("token").alias(f"_g{m}"), F.struct("m", "valence", "degree").alias(f"_f{m}"))
        ev = ev.join(table, f"_g{m}", "left").drop(f"_g{m}")
    found = F.coalesce(*[F.col(f"_f{m}") for m in reversed(lengths)])
    ev = ev.withColumn("_f", found).drop(*[f"_f{m}" for m in lengths])
    ev = ev.withColumn("_m", F.coalesce("_f.m", F.lit(1)))
    m, reach, here = F.col("_m"), range(1, max(lengths)), F.struct("_pos", "_m")
    beaten = F.lit(False)
    for i in reach:
        prev, nxt = F.lag(here, i).over(w), F.lead(here, i).over(w)
        beaten = (beaten | F.coalesce((prev["_m"] >= m) & (prev["_pos"] + prev["_m"] > at), F.lit(False))
                  | F.coalesce((nxt["_m"] > m) & (nxt["_pos"] < at + m), F.lit(False)))
    ev = ev.withColumn("_m", F.when((m > 1) & ~beaten, m).otherwise(1))
    inside = F.lit(False)
    for i in reach:
        inside = inside | F.coalesce(F.lag(at + F.col("_m"), i).over(w) > at, F.lit(False))
    ev = ev.withColumn("_inside", inside).where(~F.col("_inside"))
    phrase = F.col("_m") > 1
    return ev.withColumns({
        "valence": F.when(phrase, F.col("_f.valence")).otherwise(F.col("valence")),
        "degree": F.when(phrase, F.col("_f.degree")).otherwise(F.col("degree")),
        "code": F.when(~phrase, F.col("code")), "_end": at + F.col("_m") - 1}).drop("_f", "_m", "_inside")


def token_scores(df: DataFrame, lexicon: DataFrame, key: str, text: str = "review_text",
                 negation: bool = True) -> DataFrame:
    """key, s, pos_sum, neg_sum, neu_count for every review that has events."""
    tokens, phrases, lengths, pattern = _vocabulary(lexicon)
    txt = F.col(text).cast("string")
    blank = txt.isNull() | (F.btrim(txt) == "") | (F.lower(F.btrim(txt)) == "nan")
    marks = F.least(F.lit(4), F.length(txt) - F.length(F.replace(txt, F.lit("!"), F.lit("")))) * F.lit(0.292)
    asks = F.length(txt) - F.length(F.replace(txt, F.lit("?"), F.lit("")))
    asking = F.when(asks > 3, F.lit(0.96)).when(asks > 1, asks * F.lit(0.18)).otherwise(0.0)
    tok = spread_if_narrow(df.select(key, text), key).select(
        key, F.when(~blank, F.regexp_extract_all(txt, F.lit(pattern), 0)).alias("_t"), (marks + asking).alias("_punct"))
    capitals = F.size(F.filter("_t", _is_capitals))
    # what holds for the whole review is computed below the generate, once; an outer generate, as Spark would push
    # the size test that it infers for an inner one, tokenising and all, below the projections
    tok = tok.select(key, "_punct", F.size("_t").alias("_size"), capitals.between(1, F.size("_t") - 1).alias("_mixed"), "_t")
    tok = tok.select(key, "_punct", "_size", "_mixed", F.posexplode_outer("_t").alias("_pos", "_word"))
    events = (tok.withColumn("token", _plain(F.col("_word"))).join(tokens, "token")
              .withColumn("_loud", F.col("_mixed") & _is_capitals(F.col("_word"))).drop("_word", "_mixed"))
    whole = Window.partitionBy(key).orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    events = events.withColumn("_but", F.min(F.when(F.col("code") == BUT, F.col("_pos"))).over(whole))
    units = _units(events, phrases, lengths, key)

    loud = F.when(F.col("_loud"), F.lit(CAPITALS)).otherwise(0.0)
    known = F.col("valence").isNotNull()
    own = F.struct("_end", F.when(~known, F.coalesce(F.col("degree") + loud, F.lit(0.0))).otherwise(0.0).alias("push"),
                   F.when(~known, F.col("code")).alias("code"), F.col("code").alias("word"))
    w = Window.partitionBy(key).orderBy("_pos")
    units = units.withColumn("_u", own)
    units = units.withColumns({f"_b{i}": F.lag("_u", i).over(w) for i in (1, 2, 3)}).where(known)
    for d in (1, 2, 3):
        # what ends d places before: one of the last d units
        ends = [F.when(F.col(f"_b{i}._end") == F.col("_pos") - d, F.col(f"_b{i}")) for i in range(1, d + 1)]
        units = units.withColumn(f"_n{d}", F.coalesce(*ends))
    toward = lambda v, x: F.when(v > 0, x).otherwise(-x)
    v = F.col("valence")
    units = units.withColumn("_v", v + toward(v, loud))
    is_ = lambda c, *codes: F.coalesce(c.isin(*codes), F.lit(False))
    for d, far in zip((1, 2, 3), DISTANCE):
        code = F.col(f"_n{d}.code")
        factor = F.lit(1.0)
        if negation:
            factor = F.when(is_(code, NEGATION, NEVER, WITHOUT), F.lit(NEGATION_SCALAR)).otherwise(1.0)
            if d > 1:
                nearer = [F.col(f"_n{i}.word") for i in range(1, min(d, 3))]
                near = [is_(c, EMPHATIC) for c in nearer], [is_(c, DOUBT) for c in nearer]
                so, doubt = (x[0] if len(x) == 1 else x[0] | x[1] for x in near)
                factor = F.when(is_(code, NEVER) & so, F.lit(1.25)).when(is_(code, WITHOUT) & doubt, F.lit(1.0)).otherwise(factor)
        v = F.col("_v")
        units = units.withColumn("_v", (v + toward(v, F.coalesce(F.col(f"_n{d}.push"), F.lit(0.0)) * far)) * factor)
    v = F.col("_v")
    if negation:
        v = F.when(is_(F.col("_n1.code"), LEAST) & ~is_(F.col("_n2.word"), AT_OR_VERY), v * NEGATION_SCALAR).otherwise(v)
    v = v * F.when(F.col("_pos") < F.col("_but"), 0.5).when(F.col("_pos") > F.col("_but"), 1.5).otherwise(1.0)
    units = units.withColumn("_v", v)
    sums = units.groupBy(key).agg(
        F.sum("_v").alias("_s"),
        F.sum(F.when(F.col("_v") > 0, F.col("_v") + 1.0).otherwise(0.0)).alias("_p"),
        F.sum(F.when(F.col("_v") < 0, F.col("_v") - 1.0).otherwise(0.0)).alias("_n"),
        (F.max("_size") - F.count_if(F.col("_v") != 0)).alias("neu_count"), F.max("_punct").alias("_e"))
    e = F.col("_e")
    return sums.select(
        key, F.when(F.col("_s") > 0, F.col("_s") + e).when(F.col("_s") < 0, F.col("_s") - e).otherwise(F.col("_s")).alias("s"),
        F.when(F.col("_p") > F.abs("_n"), F.col("_p") + e).otherwise(F.col("_p")).alias("pos_sum"),
        F.when(F.col("_p") < F.abs("_n"), F.col("_n") - e).otherwise(F.col("_n")).alias("neg_sum"), "neu_count")


def sentiment(df: DataFrame, lexicon: DataFrame | None, key: str, text: str = "review_text",
              negation: bool = True, digits: tuple[int, int] | None = (4, 3)) -> DataFrame:
    """Adds sentiment_compound / _pos / _neg / _neu; without a lexicon the rows
    pass through unchanged."""
    if lexicon is None:
        return df
    sc = token_scores(df, lexicon, key, text, negation)
    s = F.col("s")
    total = F.col("pos_sum") + F.abs(F.col("neg_sum")) + F.col("neu_count")
    comp = s / F.sqrt(s * s + F.lit(ALPHA))
    pos = F.abs(F.col("pos_sum") / total)
    neg = F.abs(F.col("neg_sum") / total)
    neu = F.abs(F.col("neu_count") / total)
    if digits is not None:
        comp, pos, neg, neu = (F.bround(comp, digits[0]), F.bround(pos, digits[1]),
                               F.bround(neg, digits[1]), F.bround(neu, digits[1]))
    scores = sc.select(key, comp.alias("_c"), pos.alias("_p"), neg.alias("_n"), neu.alias("_u"))
    out = df.join(scores, key, "left")
    return out.withColumns({
        "sentiment_compound": F.coalesce(F.col("_c"), F.lit(0.0)),
        "sentiment_pos": F.coalesce(F.col("_p"), F.lit(0.0)),
        "sentiment_neg": F.coalesce(F.col("_n"), F.lit(0.0)),
        "sentiment_neu": F.coalesce(F.col("_u"), F.lit(1.0)),
    }).drop("_c", "_p", "_n", "_u")


def sentiment_rollup(scored: DataFrame, by: str = "location") -> DataFrame:
    """Mean scores per group (e.g. location or source)."""
    return scored.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.count(F.lit(1)).alias("reviews"), *[F.avg(c).alias(f"avg_{c}") for c in SENTIMENT_COLUMNS])
