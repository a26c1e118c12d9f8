"""Text / sentiment queries over the UNITS binding."""

from __future__ import annotations

import string

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry import params
from quarry.functions.sentiment import with_compound_joined
from quarry.functions.text import (alpha_tokens, explode_nonempty, normalize_text, replace_aliases, replace_table, rnd,
                                   round_doubles, tokenize)
from quarry.operators import topics_tables as TT
from quarry.operators import words as W
from quarry.plans import sql as Q
from quarry.plans.catalog import register
from quarry.session import table, written
from quarry.sources import bindings as B


def _stats(spark, sf, again=False):
    """Units and their word statistics; ``again``: the caller reads the units
    too, so the cleaned texts are written once."""
    u = written(B.units(spark, sf)) if again else B.units(spark, sf)
    return u, W.word_stats(u)


@register("unit_sentiment", lambda: f"""WITH {Q.units_ctes()}
SELECT unit_id, period, kind, score, sentiment, {Q.polarity('sentiment')} AS sentiment_label, text
FROM units""")
def unit_sentiment(spark, sf):
    """Normalised, scored and period-tagged units."""
    return B.units(spark, sf).select("unit_id", "period", "kind", "score", "sentiment",
                                     "sentiment_label", "text")


@register("word_stats", lambda: f"""WITH {Q.terms_ctes()}
SELECT period, token, count, n_docs, avg_sentiment FROM word_stats""")
def word_stats(spark, sf):
    """Per-period term counts and mean document sentiment."""
    _, s = _stats(spark, sf)
    return s.select("period", "token", "count", "n_docs", "avg_sentiment")


@register("frequent_words", lambda: f"""WITH {Q.terms_ctes()}
SELECT period, token, count FROM word_stats WHERE count >= {params.MIN_WORD_FREQ}""")
def frequent_words(spark, sf):
    """A4: terms at or above the minimum frequency."""
    _, s = _stats(spark, sf)
    return W.frequent_words(s).select("period", "token", "count")


def _top_sql(n):
    return f"""WITH {Q.terms_ctes()},
r AS (SELECT *, row_number() OVER (PARTITION BY period ORDER BY count DESC, token) AS rank
      FROM word_stats WHERE count >= {params.MIN_WORD_FREQ})
SELECT period, rank, token, count, avg_sentiment FROM r WHERE rank <= {n}"""


@register("common_words", lambda: _top_sql(50))
def common_words(spark, sf):
    """A5: top-50 frequent words per period with mean sentiment."""
    _, s = _stats(spark, sf)
    return W.most_common_words(s, 50)


@register("word_cloud_weights", lambda: _top_sql(200))
def word_cloud_weights(spark, sf):
    """Top-200 word weights (cloud data) with mean sentiment."""
    _, s = _stats(spark, sf)
    return W.most_common_words(s, 200)


@register("word_list_weights", lambda: f"""WITH {Q.terms_ctes()},
l AS (SELECT period, unnest(list_filter(string_split(lower(text), ' '), lambda w: regexp_full_match(w, '[a-z]+') AND length(w) >= 3)) AS token
      FROM units WHERE kind = 'title'),
c AS (SELECT period, token, count(*) AS count FROM l GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY period ORDER BY count DESC, token) AS rank FROM c)
SELECT period, rank, token, r.count, coalesce(avg_sentiment, 0.0) AS avg_sentiment
FROM r LEFT JOIN word_stats USING (period, token) WHERE rank <= 200""")
def word_list_weights(spark, sf):
    """Weights of a supplied word list (here the words of the titles) with
    the mean sentiment of their texts."""
    u, s = _stats(spark, sf, again=True)
    titles = u.filter("kind = 'title'").withColumn("words", alpha_tokens("text", 3))
    return W.word_list_weights(explode_nonempty(titles, "words", "token", "period"), s)


@register("normalized_texts", lambda: f"""WITH {Q.UNITS_RAW}
SELECT unit_id, {Q.lemmatized(Q.normalize(Q.symbol_names('raw_text')))} AS text FROM units_raw""")
def normalized_texts(spark, sf):
    """The whole cleaning chain with its symbol (T8) and lemma (T9) tables."""
    chain = normalize_text("raw_text", symbols=params.SYMBOLS, lemmas=params.LEMMAS)
    return B.post_units_raw(spark, sf).select("unit_id", chain.alias("text"))


@register("symbol_names", lambda: f"""SELECT doc_id, md5({Q.symbol_names('text')}) AS text_md5,
       {" + ".join(f"length(text) - length(replace(text, {Q.S(a)}, ''))" for a, _ in params.SYMBOLS)} AS n_symbols FROM documents""")
def symbol_names(spark, sf):
    """Symbols of a caller's table replaced by their names, in whole documents."""
    text = F.col("text")
    n = sum((F.length(text) - F.length(F.replace(text, F.lit(a), F.lit(""))) for a, _ in params.SYMBOLS), F.lit(0))
    return table(spark, sf, "documents").select("doc_id", F.md5(replace_table(text, params.SYMBOLS)).alias("text_md5"), n.cast("bigint").alias("n_symbols"))


@register("lexicon_table_sentiment", lambda: f"""WITH {Q.units_ctes()}
SELECT unit_id, sentiment FROM units""")
def lexicon_table_sentiment(spark, sf):
    """The same scores with the lexicon as a table, joined word by word."""
    u = B.units(spark, sf).select("unit_id", "text")
    lexicon = spark.createDataFrame(params.LEXICON, "word string, valence double")
    return with_compound_joined(u, "unit_id", "text", lexicon).select("unit_id", "sentiment")


@register("sentiment_extremes", lambda: f"""WITH {Q.terms_ctes()},
f AS (SELECT * FROM word_stats WHERE count >= {params.MIN_WORD_FREQ}),
n AS (SELECT *, 'most_negative' AS kind, row_number() OVER (PARTITION BY period ORDER BY avg_sentiment, token) AS rank FROM f),
p AS (SELECT *, 'most_positive' AS kind, row_number() OVER (PARTITION BY period ORDER BY avg_sentiment DESC, token DESC) AS rank FROM f)
SELECT period, kind, rank, token, avg_sentiment, count FROM n WHERE rank <= 10
UNION ALL
SELECT period, kind, rank, token, avg_sentiment, count FROM p WHERE rank <= 10""")
def sentiment_extremes(spark, sf):
    """Ten most negative and most positive frequent words per period."""
    _, s = _stats(spark, sf)
    return W.sentiment_extremes(s, 10)


@register("summary_stats", lambda: f"""WITH {Q.terms_ctes()},
c AS (SELECT period, CAST(sum(CASE WHEN kind = 'title' THEN 1 ELSE 0 END) AS BIGINT) AS total_posts,
             CAST(sum(CASE WHEN kind = 'comment' THEN 1 ELSE 0 END) AS BIGINT) AS total_comments
      FROM units GROUP BY period),
w AS (SELECT period, CAST(sum(count) AS BIGINT) AS total_words, CAST(count(*) AS BIGINT) AS unique_words,
             CAST(sum(CASE WHEN count >= {params.MIN_WORD_FREQ} THEN 1 ELSE 0 END) AS BIGINT) AS words_above_threshold,
             round(avg(avg_sentiment), 6) AS average_sentiment, round(stddev_pop(avg_sentiment), 6) AS sentiment_std
      FROM word_stats GROUP BY period)
SELECT c.period, total_posts, total_comments, coalesce(total_words, 0) AS total_words,
       coalesce(unique_words, 0) AS unique_words, coalesce(words_above_threshold, 0) AS words_above_threshold,
       coalesce(average_sentiment, 0.0) AS average_sentiment, coalesce(sentiment_std, 0.0) AS sentiment_std
FROM c LEFT JOIN w USING (period)""")
def summary_stats(spark, sf):
    """Per-period summary statistics."""
    u, s = _stats(spark, sf, again=True)
    return W.summary_stats(u, s)


def _entity_sql_ctes():
    ents = ", ".join(f"({Q.S(e)}, {Q.S(e.lower().replace(' ', '_'))})" for e in params.entities())
    return f"""{Q.terms_ctes()},
ents(name, token) AS (VALUES {ents}),
ctx AS (SELECT period, token, stddev_pop(sentiment) AS sd FROM (
          SELECT DISTINCT period, token, text, sentiment FROM term_occ WHERE token IN (SELECT token FROM ents))
        GROUP BY period, token),
es AS (SELECT s.period, e.name, s.token, s.count AS mention_count, s.avg_sentiment AS average_sentiment,
              round(coalesce(ctx.sd, 0.0), 6) AS sentiment_std_dev
       FROM word_stats s JOIN ents e ON s.token = e.token LEFT JOIN ctx ON ctx.period = s.period AND ctx.token = s.token)"""


@register("entity_sentiments", lambda: f"""WITH {_entity_sql_ctes()} SELECT * FROM es""")
def entity_sentiments(spark, sf):
    """Entity mention count, mean sentiment and std over distinct texts."""
    u, s = _stats(spark, sf, again=True)
    return W.entity_sentiments(u, s)


def _over_time_sql():
    """Sums of ten-thousandths over counts, rounded as fractions, halves to even."""
    periods = sorted(p for p, _, _ in params.PERIODS)
    cols = ", ".join(f"coalesce(max(CASE WHEN period = {Q.S(p)} THEN m END), 0) / 10000.0::DOUBLE AS \"{p}\"" for p in periods)
    return f"""WITH {_entity_sql_ctes()},
sums AS (SELECT period, token, CAST(sum(CAST(round(sentiment * 10000) AS BIGINT)) AS BIGINT) AS s, count(sentiment) AS n FROM term_docs GROUP BY period, token),
parts AS (SELECT period, token, n, ((s % n) + n) % n AS rest, (s - ((s % n) + n) % n) // n AS low FROM sums),
means AS (SELECT period, token, low + CASE WHEN 2 * rest > n OR (2 * rest = n AND low % 2 <> 0) THEN 1 ELSE 0 END AS m FROM parts)
SELECT name AS entity, {cols} FROM means JOIN ents USING (token) GROUP BY name"""


@register("sentiment_over_time", _over_time_sql)
def sentiment_over_time(spark, sf):
    """Entity x period sentiment matrix."""
    _, s = _stats(spark, sf)
    return W.sentiment_over_time(s)


@register("word_contexts", lambda: f"""WITH {Q.terms_ctes()},
f AS (SELECT period, token, text, min(unit_id) AS first_unit, arg_min(sentiment, unit_id) AS sentiment
      FROM term_occ GROUP BY period, token, text),
r AS (SELECT *, row_number() OVER (PARTITION BY period, token ORDER BY first_unit) AS rank FROM f)
SELECT period, token, rank, sentiment, substring(text, 1, 100) AS preview FROM r WHERE rank <= 3""")
def word_contexts(spark, sf):
    """First three distinct example texts per word."""
    return W.word_contexts(B.units(spark, sf))


@register("polarity_histogram", lambda: f"""WITH {Q.terms_ctes()},
own AS (SELECT period, token, {Q.sentiment('token')} AS score FROM word_stats),
lab AS (SELECT period, {Q.polarity('score')} AS label FROM own),
g AS (SELECT DISTINCT period, l.label FROM word_stats, (VALUES ('positive'), ('neutral'), ('negative')) l(label))
SELECT g.period, g.label, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM g LEFT JOIN (SELECT period, label, count(*) AS n FROM lab GROUP BY ALL) c USING (period, label)""")
def polarity_histogram(spark, sf):
    """Polarity histogram of the vocabulary per period."""
    _, s = _stats(spark, sf)
    return W.polarity_histogram(s)


@register("positive_words", lambda: f"""WITH {Q.units_ctes()},
t AS (SELECT period, unit_id, unnest(list_filter(regexp_extract_all(lower(text), '\\b[a-z]{{3,}}\\b'),
          lambda w: NOT list_contains({params.sql_list(params.STOP_WORDS)}, w))) AS token
      FROM units WHERE text <> ''),
a AS (SELECT period, token, count(*) AS count FROM t GROUP BY ALL HAVING count(*) >= 3),
s AS (SELECT *, {Q.sentiment('token')} AS score FROM a),
r AS (SELECT *, row_number() OVER (PARTITION BY period ORDER BY score DESC, token) AS rank FROM s)
SELECT period, rank, token, score, CAST(count AS BIGINT) AS count FROM r WHERE rank <= 10""")
def positive_words(spark, sf):
    """Top positive words by own polarity, min frequency 3."""
    return W.positive_words(B.units(spark, sf))


# ---- text models (M1-M6) ---------------------------------------------------

from quarry.operators import topics as TP  # noqa: E402


@register("bag_of_words", lambda: f"""WITH {Q.terms_ctes()}
SELECT period, unit_id, token, CAST(n AS BIGINT) AS n FROM term_docs""")
def bag_of_words(spark, sf):
    """M1: bag-of-words counts per document."""
    return W.term_docs(B.units(spark, sf)).select("period", "unit_id", "token", F.col("n").cast("bigint").alias("n"))


@register("vocab_pruned", lambda: f"""WITH {Q.terms_ctes()},
n AS (SELECT period, count(DISTINCT unit_id) AS nd FROM term_docs GROUP BY period),
d AS (SELECT period, token, count(DISTINCT unit_id) AS df FROM term_docs GROUP BY ALL)
SELECT period, token, CAST(df AS BIGINT) AS df, CAST(nd AS BIGINT) AS N FROM d JOIN n USING (period) WHERE df >= 2 AND df <= 0.8 * nd""")
def vocab_pruned(spark, sf):
    """M2: vocabulary pruned by document frequency (>= 2, <= 80%)."""
    td = W.term_docs(B.units(spark, sf))
    return TP.vocab_pruned(td, ["period"], "unit_id").select(
        "period", "token", F.col("df").cast("bigint").alias("df"), F.col("N").cast("bigint").alias("N"))


def _tfidf_sql(extra=None, grouped=False, ngram=2, top=50):
    stop = params.sql_list(params.STOP_WORDS + (extra or []))
    toks = f"list_filter(regexp_extract_all(lower(doc), '\\b[a-z_]{{3,}}\\b'), lambda t: NOT list_contains({stop}, t))"
    grams = f"list_concat(tk, list_transform(range(1, len(tk)), lambda i: tk[i] || ' ' || tk[i + 1]))" if ngram == 2 else "tk"
    if grouped:
        docs = f"""docs AS (SELECT period, post_id AS doc_id, string_agg({Q.replace_aliases('text')}, ' ' ORDER BY unit_id) AS doc
                  FROM units WHERE text <> '' GROUP BY period, post_id)"""
    else:
        docs = f"docs AS (SELECT period, unit_id AS doc_id, {Q.replace_aliases('text')} AS doc FROM units WHERE text <> '')"
    return f"""WITH {Q.units_ctes()}, {docs},
t1 AS (SELECT period, doc_id, {toks} AS tk FROM docs),
t2 AS (SELECT period, doc_id, unnest({grams}) AS term FROM t1),
tf AS (SELECT period, doc_id, term, count(*) AS tf FROM t2 GROUP BY ALL),
dfr AS (SELECT period, term, count(*) AS df FROM tf GROUP BY ALL),
nd AS (SELECT period, count(*) AS N FROM docs GROUP BY period),
w AS (SELECT tf.period, tf.doc_id, tf.term, tf * (ln((1.0 + N) / (1.0 + df)) + 1.0) AS w, N
      FROM tf JOIN dfr USING (period, term) JOIN nd USING (period)),
nw AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY period, doc_id)) AS nw FROM w),
m AS (SELECT period, term, sum(nw) / max(N) AS score FROM nw GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY period ORDER BY score DESC, term) AS rank FROM m)
SELECT period, term, round(score, 6) AS score, rank FROM r WHERE rank <= {top}"""


@register("tfidf_words", lambda: _tfidf_sql())
def tfidf_words(spark, sf):
    """M3: top-50 mean TF-IDF uni/bi-grams per period."""
    d = TP.alias_docs(B.units(spark, sf))
    t = TP.tfidf_top(d, ["period"], "unit_id", "doc", params.STOP_WORDS, 2, 50)
    return t.select("period", "term", F.round("score", 6).alias("score"), "rank")


@register("tfidf_grouped", lambda: _tfidf_sql(TP.EXTRA_STOP, grouped=True, ngram=1, top=20))
def tfidf_grouped(spark, sf):
    """M4 + T15: TF-IDF over per-post concatenated documents, extra stop words."""
    # unigram term counts of a post's texts add up per post_id, which equals
    # the counts of their space-joined concatenation (T15) without building it
    u = TP.alias_docs(B.units(spark, sf))
    t = TP.tfidf_top(u, ["period"], "post_id", "doc", params.STOP_WORDS + TP.EXTRA_STOP, 1, 20)
    return t.select("period", "term", F.round("score", 6).alias("score"), "rank")


def _unit_tokens(spark, sf):
    """Tokens of every unit (T10), once."""
    u = B.units(spark, sf)
    return written(u.select("period", F.col("unit_id").alias("doc"), tokenize(replace_aliases("text")).alias("toks")))


@register("lsa_topics")
def lsa_topics(spark, sf):
    """M5: the five greatest singular values of each period and their eight
    weightiest terms."""
    occ = explode_nonempty(_unit_tokens(spark, sf), "toks", "token", "period", "doc")
    vocabulary, counts = TT.counts_with_ids(occ, ["period"], "doc", "token", 2, 0.8)
    values, weights = TT.truncated_svd(counts, ["period"], 5)
    return TT.top_terms(weights, vocabulary, ["period"], 8, signed=True).join(F.broadcast(values), ["period", "topic"])


#: Words of entity names are no topic words.
NAMES = sorted({w for e in params.entities() for w in e.lower().split()})


@register("lda_topics")
def lda_topics(spark, sf):
    """M6: two topics over whole posts (title and comments): words of more than
    three letters without stop words and names, pruned by document frequency;
    eight terms each."""
    u = B.units(spark, sf)
    dropped = F.array(*[F.lit(w) for w in [*params.STOP_WORDS, *NAMES]])
    words = F.split(F.translate(F.lower("text"), string.punctuation, ""), r"\s+")
    u = u.select(F.col("post_id").alias("doc"), F.filter(words, lambda w: (F.length(w) > 3) & ~F.array_contains(dropped, w)).alias("toks"))
    u = u.withColumn("corpus", F.lit("posts"))
    vocabulary, counts = TT.counts_with_ids(explode_nonempty(u, "toks", "token", "corpus", "doc"), ["corpus"], "doc", "token", 2, 0.8)
    weights, _ = TT.lda(counts, ["corpus"], 2, 15, 42)
    return TT.top_terms(weights, vocabulary, ["corpus"], 8)


@register("lda_topics_legacy")
def lda_topics_legacy(spark, sf):
    """M7: older variant: five topics, 15 passes, comments only, split at white
    space, alphabetic words, nothing pruned; five terms each."""
    u = B.units(spark, sf).where("kind = 'comment'")
    u = u.select(F.col("unit_id").alias("doc"), F.filter(F.split(F.lower("text"), r"\s+"), lambda w: w.rlike("^[a-z]+$")).alias("toks"))
    u = u.withColumn("corpus", F.lit("comments"))
    vocabulary, counts = TT.counts_with_ids(explode_nonempty(u, "toks", "token", "corpus", "doc"), ["corpus"], "doc", "token")
    weights, _ = TT.lda(counts, ["corpus"], 5, 15, 42)
    return TT.top_terms(weights, vocabulary, ["corpus"], 5)


_WORD_VECTORS = f"""{{ctes}},
top AS (SELECT period, token FROM (SELECT period, token, row_number() OVER (PARTITION BY period ORDER BY count DESC, token) AS r
        FROM word_stats WHERE NOT contains(token, '_')) WHERE r <= 10),
d AS (SELECT period, toks, len(toks) AS n FROM utok WHERE len(toks) > 0),
win AS (SELECT period, list_distinct(toks[s + 1:s + {TT.WINDOW}]) AS w FROM (SELECT period, toks, unnest(range(greatest(n - {TT.WINDOW}, 0) + 1)) AS s FROM d)),
size AS (SELECT period, count(*) AS windows FROM win GROUP BY period),
hit AS (SELECT win.period, list_filter(w, lambda x: list_contains(l, x)) AS w FROM win JOIN (SELECT period, list(token) AS l FROM top GROUP BY period) USING (period)),
pairs AS (SELECT period, w1, unnest(w) AS w2 FROM (SELECT period, w, unnest(w) AS w1 FROM hit)),
both_ AS (SELECT period, w1, w2, count(*) AS n FROM pairs GROUP BY ALL),
v AS (SELECT a.period, a.token AS w1, b.token AS w2, coalesce(c.n, 0) / windows + {TT.EPSILON} AS p, x.n / windows AS p1, y.n / windows AS p2
      FROM top a JOIN top b USING (period) JOIN size USING (period) LEFT JOIN both_ c ON c.period = a.period AND c.w1 = a.token AND c.w2 = b.token
      JOIN both_ x ON x.period = a.period AND x.w1 = a.token AND x.w2 = a.token JOIN both_ y ON y.period = a.period AND y.w1 = b.token AND y.w2 = b.token),
m AS (SELECT period, w1, w2, ln(p / (p1 * p2)) / -ln(p) AS x FROM v),
s AS (SELECT period, w2, sum(x) AS y FROM m GROUP BY ALL),
c AS (SELECT m.period, w1, sum(x * y) / sqrt(sum(x * x) * sum(y * y)) AS cosine FROM m JOIN s ON s.period = m.period AND s.w2 = m.w2 GROUP BY ALL)
SELECT period, round(avg(cosine), 6) AS coherence FROM c GROUP BY period"""


@register("topic_coherence", lambda: f"WITH {_WORD_VECTORS.replace('{ctes}', Q.terms_ctes())}")
def topic_coherence(spark, sf):
    """M8: c_v of the ten most frequent words of each period, over sliding windows."""
    toks = _unit_tokens(spark, sf)
    counted = explode_nonempty(toks, "toks", "token", "period").where(~F.contains(F.col("token"), F.lit("_"))).groupBy("period", "token").count()
    w = Window.partitionBy("period").orderBy(F.desc("count"), "token")
    top = counted.withColumn("r", F.row_number().over(w)).where("r <= 10").select("period", F.lit(0).alias("topic"), "token")
    return round_doubles(TT.coherence(toks, ["period"], "doc", written(top)).select("period", "coherence"))


@register("term_npmi", lambda: f"""WITH {Q.terms_ctes()},
top AS (SELECT period, token FROM (SELECT period, token, row_number() OVER (PARTITION BY period ORDER BY count DESC, token) AS r
        FROM word_stats) WHERE r <= 10),
t AS (SELECT DISTINCT d.period, d.unit_id, d.token FROM term_docs d JOIN top USING (period, token)),
n AS (SELECT period, count(DISTINCT unit_id) AS N FROM term_docs GROUP BY period),
p1 AS (SELECT period, token, count(*) AS c1 FROM t GROUP BY ALL),
co AS (SELECT a.period, a.token AS w1, b.token AS w2, count(*) AS c12 FROM t a JOIN t b
       ON a.period = b.period AND a.unit_id = b.unit_id AND a.token < b.token GROUP BY ALL),
pr AS (SELECT a.period, a.token AS w1, b.token AS w2, coalesce(c12, 0) AS c12 FROM p1 a JOIN p1 b ON a.period = b.period AND a.token < b.token
       LEFT JOIN co ON co.period = a.period AND co.w1 = a.token AND co.w2 = b.token)
SELECT pr.period, w1, w2, CAST(c12 AS BIGINT) AS c12,
       round(CASE WHEN c12 = 0 THEN -1.0 WHEN c12 = N THEN 1.0 ELSE ln((c12 / N) / ((x.c1 / N) * (y.c1 / N))) / -ln(c12 / N) END, 6) AS npmi
FROM pr JOIN p1 x ON x.period = pr.period AND x.token = w1 JOIN p1 y ON y.period = pr.period AND y.token = w2
JOIN n ON n.period = pr.period""")
def term_npmi(spark, sf):
    """M8 (NPMI part): document co-occurrence NPMI of the top-10 terms."""
    u = B.units(spark, sf)
    st = W.word_stats(u)
    top = W.most_common_words(st, 10, min_freq=0).select("period", "token")
    r = TP.term_npmi(W.term_docs(u), ["period"], "unit_id", top)
    return r.select("period", "w1", "w2", F.col("c12").cast("bigint").alias("c12"), F.round("npmi", 6).alias("npmi"))


def _lemma_sql():
    m = "MAP {" + ", ".join(f"{Q.S(a)}: {Q.S(b)}" for a, b in params.LEMMAS) + "}"
    return f"""WITH {Q.units_ctes()},
t AS (SELECT period, unnest(list_transform({Q.tokenize('text')}, lambda w: coalesce({m}[w], w))) AS lemma FROM units)
SELECT period, lemma, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY ALL"""


@register("lemma_counts", _lemma_sql)
def lemma_counts(spark, sf):
    """Tokens mapped through a (form, lemma) table, counted per period."""
    from quarry.functions.text import lemmatize_tokens, tokenize
    u = B.units(spark, sf).withColumn("lem", lemmatize_tokens(tokenize("text"), params.LEMMAS))
    e = explode_nonempty(u, "lem", "lemma", "period")
    return e.groupBy("period", "lemma").agg(F.count("*").cast("bigint").alias("n"))
