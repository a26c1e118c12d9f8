"""Text statistics (M1-M4, M8): bag of words, vocabulary pruning, TF-IDF, NPMI.

TF-IDF is written relationally (sklearn's smooth idf and L2 row norm), so
it stays a pair of aggregations. Topic models are in ``topics_tables``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry import params
from quarry.functions.text import explode_nonempty, replace_aliases
from quarry.session import written

SK_TOKEN_RE = r"\b[a-z_]{3,}\b"


def sk_terms(text_col, stop_words: list[str], ngram_max: int = 2, sep: str = " "):
    """sklearn-style analyser: lower-case, ``[a-z_]{3,}`` tokens, stop words
    removed, then 1..n-grams joined by a space."""
    stop = F.array(*[F.lit(w) for w in stop_words])
    toks = F.filter(F.regexp_extract_all(F.lower(text_col), F.lit(SK_TOKEN_RE), 0),
                    lambda t: ~F.array_contains(stop, t))
    return toks


def tfidf_top(docs: DataFrame, keys: list[str], doc_id: str, text: str, stop_words: list[str],
              ngram_max: int = 2, top_n: int = 20) -> DataFrame:
    """M3 / M4: mean TF-IDF per term over all documents of a group, top-n.
    idf = ln((1+N)/(1+df)) + 1, tf = raw count, rows L2-normalised."""
    from quarry.functions.text import ngrams
    d = written(docs.select(*keys, doc_id, sk_terms(F.col(text), stop_words).alias("__t")))  # texts are analysed once
    # a document may arrive as several rows (e.g. a post and its comments);
    # term counts add up per doc_id, so no text is concatenated or collected
    n_docs = d.groupBy(*keys).agg(F.countDistinct(doc_id).alias("N"))
    occ = explode_nonempty(d.withColumn("__g", ngrams("__t", ngram_max, sep=" ")), "__g", "term", *keys, doc_id)
    tf = written(occ.groupBy(*keys, doc_id, "term").agg(F.count("*").alias("tf")))
    df_ = tf.groupBy(*keys, "term").agg(F.count("*").alias("df"))
    j = tf.join(df_, keys + ["term"]).join(F.broadcast(n_docs), keys)  # one row a group: a group is never one task
    w = j.withColumn("w", F.col("tf") * (F.ln((F.lit(1.0) + F.col("N")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)))
    norm = w.withColumn("nw", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*keys, doc_id))))
    mean = norm.groupBy(*keys, "term").agg((F.sum("nw") / F.first("N")).alias("score"))
    r = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("term"))
    return mean.withColumn("rank", F.row_number().over(r).cast("bigint")).filter(F.col("rank") <= top_n)


def vocab_pruned(term_docs: DataFrame, keys: list[str], doc_id: str, no_below: int = 2,
                 no_above: float = 0.8) -> DataFrame:
    """M2: keep terms in >= no_below documents and <= no_above of them."""
    n = term_docs.groupBy(*keys).agg(F.countDistinct(doc_id).alias("N"))
    df_ = term_docs.groupBy(*keys, "token").agg(F.countDistinct(doc_id).alias("df"))
    j = df_.join(n, keys)
    return j.filter((F.col("df") >= no_below) & (F.col("df") <= F.lit(no_above) * F.col("N")))


def alias_docs(units: DataFrame) -> DataFrame:
    """Documents for TF-IDF: alias-canonicalised non-empty texts."""
    return units.filter(F.col("text") != "").withColumn("doc", replace_aliases("text"))


EXTRA_STOP = [e.lower().split()[0] for e, _ in params.ENTITY_ALIASES]


def term_npmi(term_docs: DataFrame, keys: list[str], doc_id: str, terms: DataFrame) -> DataFrame:
    """M8 (document part): boolean document co-occurrence of the given top
    terms, NPMI = ln(p12 / (p1 p2)) / -ln(p12) per pair; a pair that never
    occurs together has c12 = 0 and the limit, -1. Only the listed terms enter
    the self-join, so pairs are bounded by (top terms)^2 per document."""
    n = term_docs.groupBy(*keys).agg(F.countDistinct(doc_id).alias("N"))
    listed = terms.select(*keys, "token").distinct()
    t = term_docs.join(F.broadcast(listed), keys + ["token"], "left_semi").select(*keys, doc_id, "token").distinct()
    p1 = t.groupBy(*keys, "token").agg(F.count("*").alias("c1"))
    every = (p1.select(*keys, F.col("token").alias("w1"), "c1").join(p1.select(*keys, F.col("token").alias("w2"), F.col("c1").alias("c2")), keys)
             .where("w1 < w2"))
    both = (t.withColumnRenamed("token", "w1").join(t.withColumnRenamed("token", "w2"), [*keys, doc_id]).where("w1 < w2")
            .groupBy(*keys, "w1", "w2").agg(F.count("*").alias("c12")))
    j = every.join(both, [*keys, "w1", "w2"], "left").na.fill(0, ["c12"]).join(n, keys)
    p12 = F.col("c12") / F.col("N")
    pmi = F.ln(p12 / ((F.col("c1") / F.col("N")) * (F.col("c2") / F.col("N"))))
    npmi = F.when(F.col("c12") == 0, F.lit(-1.0)).when(F.col("c12") == F.col("N"), F.lit(1.0)).otherwise(pmi / -F.ln(p12))
    return j.select(*keys, "w1", "w2", "c12", npmi.alias("npmi"))
