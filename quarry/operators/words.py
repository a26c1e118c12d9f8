"""Word statistics per period (A1-A14, T15) over UNITS.

Shuffle plan: tokens are exploded per unit, counted per (period, unit,
token) with a map-side partial aggregate (a unit's rows are in one
partition, so only distinct (unit, token) pairs cross the network), then
re-aggregated per (period, token). Top-k reports use ``row_number() <= k``,
which Spark turns into a partial WindowGroupLimit before the shuffle, so a
hot token never sorts more than k rows per map partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry import params
from quarry.functions.text import explode_nonempty, mean_e4, ngrams, ratio_half_even, replace_aliases, rnd, slug, tokenize


def unit_terms(units: DataFrame, ngram_max: int = params.NGRAM_MAX,
               stop_words: list[str] | None = None) -> DataFrame:
    """T10 -> T11 -> T12 per non-empty unit: ``terms`` array column."""
    # empty texts yield no tokens, so no filter is needed (a filter on the
    # normalised text would be pushed below and re-run the cleaning chain)
    u = units
    # materialise tokens once: the n-gram lambdas reference them repeatedly
    u = u.withColumn("toks", tokenize(replace_aliases("text"), stop_words=stop_words))
    return u.withColumn("terms", ngrams("toks", ngram_max)).drop("toks")


def term_docs(units: DataFrame, **kw) -> DataFrame:
    """(period, unit_id, sentiment, token, n): occurrences of a term in a unit."""
    t = explode_nonempty(unit_terms(units, **kw), "terms", "token",
                         "period", "unit_id", "sentiment")
    return t.groupBy("period", "unit_id", "sentiment", "token").agg(F.count("*").alias("n"))


def text_key(c: str = "text"):
    """128-bit content key of a text (two independent 64-bit hashes), used to
    de-duplicate by text without shuffling whole documents."""
    return F.struct(F.xxhash64(F.col(c)).alias("h1"), F.xxhash64(F.lit("#"), F.col(c)).alias("h2"))


def word_stats(units: DataFrame, **kw) -> DataFrame:
    """A1 + A2: total count, documents containing the term, and mean unit
    sentiment over those documents (one observation per document)."""
    td = term_docs(units, **kw)
    return td.groupBy("period", "token").agg(
        F.sum("n").cast("bigint").alias("count"),
        F.count("*").cast("bigint").alias("n_docs"),
        mean_e4("sentiment").alias("avg_sentiment"),
        F.sum(F.round(F.col("sentiment") * 10000).cast("long")).alias("sentiment_e4"), F.count("sentiment").alias("sentiment_n"))


def frequent_words(stats: DataFrame, min_freq: int = params.MIN_WORD_FREQ) -> DataFrame:
    """A4: HAVING count >= min_freq."""
    return stats.filter(F.col("count") >= min_freq)


def most_common_words(stats: DataFrame, n: int = 50,
                      min_freq: int = params.MIN_WORD_FREQ) -> DataFrame:
    """Top-n frequent words per period (ties: token ascending)."""
    w = Window.partitionBy("period").orderBy(F.col("count").desc(), F.col("token"))
    return (frequent_words(stats, min_freq)
            .withColumn("rank", F.row_number().over(w).cast("bigint"))
            .filter(F.col("rank") <= n)
            .select("period", "rank", "token", "count",
                    "avg_sentiment"))


def word_list_weights(words: DataFrame, stats: DataFrame, n: int = 200) -> DataFrame:
    """Weights of a supplied word list, one row (period, token) for each
    time a word is in it: its n most frequent words (ties: token ascending) with
    their mean sentiment in ``stats``, 0 for a word that the texts do not have."""
    w = Window.partitionBy("period").orderBy(F.col("count").desc(), F.col("token"))
    top = (words.groupBy("period", "token").agg(F.count("*").cast("bigint").alias("count"))
           .withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= n))
    return (top.join(stats.select("period", "token", "avg_sentiment"), ["period", "token"], "left")
            .select("period", "rank", "token", "count", F.coalesce("avg_sentiment", F.lit(0.0)).alias("avg_sentiment")))


def sentiment_extremes(stats: DataFrame, n: int = 10,
                       min_freq: int = params.MIN_WORD_FREQ) -> DataFrame:
    """N lowest and n highest mean-sentiment words above min frequency."""
    f = frequent_words(stats, min_freq)
    wn = Window.partitionBy("period").orderBy(F.col("avg_sentiment"), F.col("token"))
    wp = Window.partitionBy("period").orderBy(F.col("avg_sentiment").desc(), F.col("token").desc())
    neg = f.withColumn("rank", F.row_number().over(wn).cast("bigint")).filter(F.col("rank") <= n) \
        .withColumn("kind", F.lit("most_negative"))
    pos = f.withColumn("rank", F.row_number().over(wp).cast("bigint")).filter(F.col("rank") <= n) \
        .withColumn("kind", F.lit("most_positive"))
    return neg.unionByName(pos).select(
        "period", "kind", "rank", "token", "avg_sentiment", "count")


def summary_stats(units: DataFrame, stats: DataFrame,
                  min_freq: int = params.MIN_WORD_FREQ) -> DataFrame:
    """Posts, comments, total / unique / frequent words, mean and
    population std of the per-word mean sentiment, per period."""
    counts = units.groupBy("period").agg(
        F.sum((F.col("kind") == "title").cast("long")).alias("total_posts"),
        F.sum((F.col("kind") == "comment").cast("long")).alias("total_comments"))
    words = stats.groupBy("period").agg(
        F.sum("count").cast("bigint").alias("total_words"),
        F.count("*").cast("bigint").alias("unique_words"),
        F.sum((F.col("count") >= min_freq).cast("long")).alias("words_above_threshold"),
        rnd(F.avg("avg_sentiment")).alias("average_sentiment"),
        rnd(F.stddev_pop("avg_sentiment")).alias("sentiment_std"))
    return counts.join(words, "period", "left").na.fill(0)


def entity_sentiments(units: DataFrame, stats: DataFrame,
                      entities: list[str] | None = None, **kw) -> DataFrame:
    """A8 (Q7 kept): mean over documents, population std over distinct texts."""
    spark = units.sparkSession
    ents = spark.createDataFrame([(e,) for e in (entities or params.entities())], "name string") \
        .withColumn("token", slug("name"))
    ut = unit_terms(units, **kw).withColumn("tk", text_key())
    ctx = (explode_nonempty(ut, "terms", "token", "period", "tk", "sentiment")
           .join(F.broadcast(ents.select("token")), "token")
           .dropDuplicates(["period", "token", "tk"])
           .groupBy("period", "token").agg(F.stddev_pop("sentiment").alias("sentiment_std_dev")))
    return (stats.join(F.broadcast(ents), "token")
            .join(ctx, ["period", "token"], "left")
            .select("period", "name", "token", F.col("count").alias("mention_count"),
                    F.col("avg_sentiment").alias("average_sentiment"),
                    rnd(F.coalesce("sentiment_std_dev", F.lit(0.0))).alias("sentiment_std_dev")))


def word_contexts(units: DataFrame, k: int = 3, preview: int = 100, **kw) -> DataFrame:
    """First k distinct texts per word in unit order, with sentiment and
    a ``preview``-character prefix for display (the full text is matched)."""
    # distinct texts by a content hash; only a ``preview``-char prefix
    # travels through the shuffle, never the whole document
    ut = unit_terms(units, **kw).withColumn("tk", text_key()) \
        .withColumn("pv", F.substring("text", 1, preview))
    t = explode_nonempty(ut, "terms", "token", "period", "unit_id", "tk", "pv", "sentiment")
    first = t.groupBy("period", "token", "tk").agg(
        F.min(F.struct("unit_id", "sentiment", "pv")).alias("f"))
    w = Window.partitionBy("period", "token").orderBy(F.col("f.unit_id"))
    return (first.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= k)
            .select("period", "token", "rank", F.col("f.sentiment").alias("sentiment"),
                    F.col("f.pv").alias("preview")))


def sentiment_over_time(stats: DataFrame, periods: list[str] | None = None, entities: list[str] | None = None) -> DataFrame:
    """Entity x period matrix of mean sentiment, missing = 0, to 4 places,
    halves to the even digit. Means are sums of whole ten-thousandths over
    counts, so they are rounded as fractions and never lie next to a half. The
    pivot receives its value list, so no extra distinct pass runs."""
    periods = periods or sorted(p for p, _, _ in params.PERIODS)
    ents = stats.sparkSession.createDataFrame([(e,) for e in (entities or params.entities())], "name string").withColumn("token", slug("name"))
    mean = ratio_half_even(F.col("sentiment_e4"), F.col("sentiment_n"))
    m = stats.withColumn("mean", mean).join(F.broadcast(ents), "token").groupBy("name").pivot("period", periods).agg(F.first("mean"))
    return m.select(F.col("name").alias("entity"), *[(F.coalesce(F.col(f"`{p}`"), F.lit(0)) / F.lit(10000.0)).alias(p) for p in periods])


def polarity_histogram(stats: DataFrame, threshold: float = params.SENTIMENT_THRESHOLD) -> DataFrame:
    """Count of words per polarity label of each word's own sentiment,
    zero-filled over the label set."""
    from quarry.functions.sentiment import with_compound
    from quarry.functions.text import polarity_label
    lab = polarity_label("word_sentiment", threshold)
    stats = with_compound(stats, "token", "word_sentiment")
    spark = stats.sparkSession
    labels = spark.createDataFrame([("positive",), ("neutral",), ("negative",)], "label string")
    periods = stats.select("period").distinct()
    grid = periods.crossJoin(F.broadcast(labels))  # periods x 3 labels, both tiny
    c = stats.groupBy("period", lab.alias("label")).agg(F.count("*").cast("bigint").alias("n"))
    return grid.join(c, ["period", "label"], "left").na.fill(0, ["n"])


def positive_words(units: DataFrame, top_n: int = 10, min_freq: int = 3) -> DataFrame:
    """Words (3+ letters, stop words removed) ranked by their own
    lexicon polarity averaged over texts, above a frequency floor."""
    from quarry.functions.sentiment import compound_score
    stop = F.array(*[F.lit(w) for w in params.STOP_WORDS])
    toks = F.filter(F.regexp_extract_all(F.lower("text"), F.lit(r"\b[a-z]{3,}\b"), 0),
                    lambda t: ~F.array_contains(stop, t))
    t = explode_nonempty(units.withColumn("toks", toks), "toks", "token", "period", "unit_id")
    per_doc = t.groupBy("period", "unit_id", "token").agg(F.count("*").alias("n"))
    agg = per_doc.groupBy("period", "token").agg(F.sum("n").alias("count"))
    scored = agg.filter(F.col("count") >= min_freq).withColumn("score", compound_score("token"))
    w = Window.partitionBy("period").orderBy(F.col("score").desc(), F.col("token"))
    return (scored.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= top_n)
            .select("period", "rank", "token", "score", F.col("count").cast("bigint").alias("count")))
