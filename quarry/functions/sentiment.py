"""Lexicon sentiment (T16), re-aimed as a pure column expression.

All word tables are parameters. They are compiled into literal maps inside the
projection, so scoring needs no join and no shuffle; a lexicon that is itself a
large table is joined first (``with_compound_joined``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import params

WORD_RE = "[A-Za-z]+"


def _bound(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once, whatever number of times
    ``fn`` uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _word_map(pairs) -> Column:
    return F.create_map(*[x for w, v in pairs for x in (F.lit(w), F.lit(float(v)))]) if pairs else F.lit(None).cast("map<string,double>")


def sentiment_words(text) -> Column:
    """Words of the text, in their case."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(col, F.lit(WORD_RE), 0)


def with_compound(df: DataFrame, text: str, out: str = "sentiment", **kw) -> DataFrame:
    return df.withColumn(out, compound_score(text, **kw))


def with_compound_joined(df: DataFrame, id_col: str, text: str, lexicon: DataFrame, out: str = "sentiment", **kw) -> DataFrame:
    """As ``with_compound`` with a ``lexicon`` table (word, valence) of any
    size. The distinct words of a text meet the lexicon in an equi-join; a text
    takes back the entries of its own words only. Of a word listed twice the
    smallest valence counts; ``id_col`` is unique in ``df``."""
    words = df.select(F.col(id_col).alias("__id"), F.explode(F.array_distinct(F.transform(sentiment_words(text), F.lower))).alias("__word"))
    table = lexicon.groupBy(F.col("word").alias("__word")).agg(F.min("valence").cast("double").alias("__valence"))
    own = (words.join(table, "__word").groupBy("__id")
           .agg(F.map_from_entries(F.collect_list(F.struct("__word", "__valence"))).alias("__lexicon")))
    scored = df.join(own, df[id_col] == own["__id"], "left").drop("__id")
    return scored.withColumn(out, compound_score(text, lexicon=F.col("__lexicon"), **kw)).drop("__lexicon")


def compound_score(text, lexicon: list[tuple[str, float]] | Column | None = None,
                   negations: list[str] | None = None,
                   boosters: list[tuple[str, float]] | None = None,
                   contrast: list[str] | None = None,
                   alpha: float = params.VADER_ALPHA,
                   negation_scalar: float = params.NEGATION_SCALAR) -> Column:
    """compound = s / sqrt(s^2 + alpha), rounded to 4; s is the sum of the words'
    valences, changed by their surroundings as in the published rules:

    * a word in capitals, where others are not, is stronger by CAPS;
    * each of the three words before it that is not in the lexicon itself: a
      booster adds its strength away from zero (less with distance), a negation
      multiplies by ``negation_scalar``, nearest first;
    * words before the first contrast word count half, those after it one and a
      half times;
    * exclamation marks (four at most) and repeated question marks add to |s|.

    Boosters have no valence of their own. Idioms are not looked at. A null
    text has a null score, a text without lexicon words 0."""
    lexicon = params.LEXICON if lexicon is None else lexicon
    negations = params.NEGATIONS if negations is None else negations
    boosters = params.BOOSTERS if boosters is None else boosters
    contrast = params.CONTRAST if contrast is None else contrast
    lex = lexicon if isinstance(lexicon, Column) else _word_map(lexicon)
    boost = _word_map(boosters)
    strings = lambda words: F.array(*[F.lit(w) for w in words]).cast("array<string>")
    neg, but = strings(negations), strings(contrast)
    fade = F.array(*[F.lit(x) for x in params.FADE])
    text = F.col(text) if isinstance(text, str) else text
    zero, one = F.lit(0.0), F.lit(1.0)
    sign = lambda v: F.when(v < 0, -one).otherwise(one)
    loud = lambda w: w == F.upper(w)

    def total(words, lower, mixed, turn):
        def valence(t, i):
            def neighbour(v, d):
                before = F.get(lower, i - d)
                strength = F.try_element_at(boost, before)
                strength = strength + F.when(mixed & loud(F.get(words, i - d)), F.lit(params.CAPS)).otherwise(zero)
                moved = v + F.coalesce(sign(v) * strength * F.element_at(fade, d), zero)
                moved = F.when(F.array_contains(neg, before), moved * negation_scalar).otherwise(moved)
                return F.when(F.try_element_at(lex, before).isNull(), moved).otherwise(v)
            own = F.try_element_at(lex, t)
            own = own + F.when(mixed & loud(F.get(words, i)), sign(own) * params.CAPS).otherwise(zero)
            weight = F.when((turn > 0) & (i + 1 < turn), F.lit(0.5)).when((turn > 0) & (i + 1 > turn), F.lit(1.5)).otherwise(one)
            return F.when(F.try_element_at(lex, t).isNull() | F.try_element_at(boost, t).isNotNull(), zero).otherwise(
                F.aggregate(F.array(F.lit(1), F.lit(2), F.lit(3)), own, neighbour) * weight)
        return F.aggregate(F.transform(lower, valence), zero, lambda a, x: a + x)

    def over_words(words):
        capitals = F.size(F.filter(words, loud))
        mixed = (capitals > 0) & (capitals < F.size(words))
        return _bound(F.transform(words, F.lower), lambda lower: _bound(mixed, lambda m: _bound(
            F.array_position(F.transform(lower, lambda t: F.array_contains(but, t)), True), lambda turn: total(words, lower, m, turn))))

    shouts, asks = F.regexp_count(text, F.lit("!")), F.regexp_count(text, F.lit(r"\?"))
    marks = F.least(shouts, F.lit(4)) * F.lit(params.SHOUT) + F.when(asks > 3, F.lit(params.ASK_MOST)).when(
        asks > 1, asks * F.lit(params.ASK)).otherwise(zero)
    stressed = lambda s: F.when(s == 0, s).otherwise(s + sign(s) * marks)
    score = lambda s: F.round(s / F.sqrt(s * s + F.lit(alpha)), 4)
    return _bound(_bound(sentiment_words(text), over_words), lambda s: _bound(stressed(s), score))
