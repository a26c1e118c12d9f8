"""Post / comment source queries over the POSTS binding."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import params
from quarry.functions.text import alpha_tokens, explode_nonempty, mean_e4
from quarry.plans import sql as Q
from quarry.plans.catalog import register
from quarry.sources import bindings as B
from quarry.sources import files as FS

POSTS_SQL = f"""{Q.UNITS_RAW},
titles AS (SELECT post_id, raw_text AS title, created_utc, score, author FROM units_raw WHERE turn = 0),
crows AS (SELECT post_id, CAST(turn - 1 AS INTEGER) AS pos, author, raw_text AS body, score FROM units_raw WHERE turn > 0)"""


@register("posts", f"""WITH {POSTS_SQL}
SELECT t.post_id, t.title, t.created_utc, t.score, CAST(count(c.post_id) AS BIGINT) AS num_comments
FROM titles t LEFT JOIN crows c USING (post_id) GROUP BY ALL""")
def posts(spark, sf):
    """S1-S3 shape: nested posts (title, timestamp, score, comment count)."""
    return B.posts(spark, sf).select("post_id", "title", "created_utc", "score", "num_comments")


@register("comment_rows", f"WITH {POSTS_SQL} SELECT post_id, pos, author, body, score FROM crows")
def comment_rows(spark, sf):
    """S3: comments flattened with their position, post context kept."""
    return FS.comment_rows(B.posts(spark, sf), ["post_id"]).filter(F.col("pos").isNotNull())


@register("top_posts", f"""WITH {POSTS_SQL},
k AS (SELECT post_id, title, score, author AS channel, {Q.period_case('created_utc')} AS keyword FROM titles),
r AS (SELECT *, row_number() OVER (PARTITION BY channel, keyword ORDER BY score DESC, post_id) AS rank FROM k)
SELECT channel, keyword, rank, post_id, score FROM r WHERE rank <= 50""")
def top_posts(spark, sf):
    """Top-50 posts per (channel, keyword)."""
    p = B.posts(spark, sf)
    t = B.post_units_raw(spark, sf).filter("turn = 0").select("post_id", F.col("author").alias("channel"))
    k = p.join(t, "post_id").withColumn("keyword", B.period_of("created_utc"))
    return FS.top_posts(k, ["channel", "keyword"], 50).select("channel", "keyword", "rank", "post_id", "score")


@register("top_comments", f"""WITH {POSTS_SQL}
SELECT post_id, pos, author, body, score FROM crows WHERE pos < 20 AND body NOT IN ('[deleted]', '[removed]')""")
def top_comments(spark, sf):
    """First 20 comments, then deleted / removed ones dropped."""
    return FS.first_comments(B.posts(spark, sf), ["post_id"], 20)


@register("post_documents", f"""WITH {POSTS_SQL}
SELECT t.post_id, concat_ws(' ', t.title, coalesce(string_agg(c.body, ' ' ORDER BY c.pos), '')) AS document
FROM titles t LEFT JOIN crows c USING (post_id) GROUP BY t.post_id, t.title""")
def post_documents(spark, sf):
    """A post's title and comment bodies as one document."""
    p = B.posts(spark, sf)
    return p.select("post_id", F.concat_ws(" ", F.col("title"),
                                           F.array_join(F.transform("comments", lambda c: c["body"]), " ")).alias("document"))


@register("legacy_word_scores", lambda: f"""WITH {Q.units_ctes()},
w AS (SELECT period, lower(unnest(string_split(text, ' '))) AS word, sentiment FROM units WHERE text <> '')
SELECT period, word, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(CAST(round(sentiment * 10000) AS BIGINT)) AS DOUBLE) / count(sentiment) / 10000.0::DOUBLE AS avg_sentiment
FROM w WHERE word <> '' GROUP BY ALL""")
def legacy_word_scores(spark, sf):
    """A3: older variant, mean sentiment per whitespace-token occurrence."""
    u = B.units(spark, sf).filter(F.col("text") != "").withColumn("ws", F.split("text", " "))
    w = explode_nonempty(u, "ws", "w", "period", "sentiment").select("period", F.lower("w").alias("word"), "sentiment")
    return w.filter(F.col("word") != "").groupBy("period", "word").agg(
        F.count("*").cast("bigint").alias("n"), mean_e4("sentiment").alias("avg_sentiment"))


NAMES = [e.lower().split()[0] for e, _ in params.ENTITY_ALIASES]


@register("alt_token_counts", lambda: f"""WITH {Q.units_ctes()},
a AS (SELECT period, 'alpha' AS variant, unnest(list_filter(string_split(lower(text), ' '), lambda w: regexp_full_match(w, '[a-z]+'))) AS tok FROM units),
b AS (SELECT period, 'stripped4' AS variant, unnest(list_filter(list_transform(string_split(lower(text), ' '), lambda w: regexp_replace(w, '[^\\w]', '', 'g')),
          lambda w: length(w) >= 4 AND NOT list_contains({params.sql_list(NAMES)}, w))) AS tok FROM units)
SELECT period, variant, CAST(count(*) AS BIGINT) AS n_tokens, CAST(count(DISTINCT tok) AS BIGINT) AS n_distinct
FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY ALL""")
def alt_token_counts(spark, sf):
    """Whitespace alpha-only tokens, and punctuation-stripped 4+ char
    tokens minus entity names."""
    u = B.units(spark, sf)
    a = explode_nonempty(u.withColumn("t", alpha_tokens("text")), "t", "tok", "period").withColumn("variant", F.lit("alpha"))
    b = explode_nonempty(u.withColumn("t", alpha_tokens("text", 4, True, NAMES)), "t", "tok", "period") \
        .withColumn("variant", F.lit("stripped4"))
    return a.unionByName(b).groupBy("period", "variant").agg(
        F.count("*").cast("bigint").alias("n_tokens"), F.countDistinct("tok").cast("bigint").alias("n_distinct"))
