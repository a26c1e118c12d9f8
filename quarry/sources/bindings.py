"""Bind the generated tables to the reference's data model (FIXTURES.md §3).

Every binding is a lazy DataFrame derived from the input tables, so its
work grows with them. No binding collects anything to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import params
from quarry.functions.sentiment import with_compound
from quarry.functions.text import normalize_text, polarity_label
from quarry.session import spread, table


def period_of(ts, periods=None) -> Column:
    """First period (dictionary order) whose inclusive [start, end]
    holds ``ts``; end is midnight of the last day (Q3). The period table is a
    small parameter, so the interval join compiles to a CASE chain: no join,
    no shuffle."""
    periods = params.PERIODS if periods is None else periods
    ts = F.col(ts) if isinstance(ts, str) else ts
    col = None
    for name, lo, hi in periods:
        cond = ts.between(F.to_timestamp(F.lit(lo)), F.to_timestamp(F.lit(hi)))
        col = F.when(cond, name) if col is None else col.when(cond, name)
    return col


def post_units_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as posts: turn 0 is the title, later turns comments.
    created_utc = order date of order ``conv_id`` plus ``conv_id`` hours."""
    conv = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), "conv_id", "turn")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("conv_id"), F.col("o_orderdate"))
    j = conv.join(orders, "conv_id", "left")
    created = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
                                  + F.col("conv_id") * 3600)
    return j.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("unit_id"),
        F.col("conv_id").alias("post_id"),
        F.col("turn"),
        F.when(F.col("turn") == 0, "title").otherwise("comment").alias("kind"),
        F.col("role").alias("author"),
        F.col("text").alias("raw_text"),
        (F.length("text") % 100 - 10).cast("bigint").alias("score"),
        created.alias("created_utc"),
    )


def units(spark: SparkSession, sf_dir: str, with_period_only: bool = True) -> DataFrame:
    """UNITS: every title and comment with normalised text, sentiment and
    period (P2: rows without a period drop out)."""
    u = post_units_raw(spark, sf_dir)
    u = u.select(
        "unit_id", "post_id", "turn", "kind", "author", "score", "created_utc",
        period_of("created_utc").alias("period"),
        normalize_text("raw_text").alias("text"),
    )
    u = with_compound(u, "text")
    u = u.withColumn("sentiment_label", polarity_label("sentiment"))
    if with_period_only:
        u = u.filter(F.col("period").isNotNull())
    return u


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """POSTS (S1-S3 shape): one row per conversation with the title and a
    turn-ordered ``comments`` array<struct<author, body, score>>.

    The nesting is a per-conversation aggregate; conversations are small by
    construction (a post and its comment thread)."""
    u = post_units_raw(spark, sf_dir)
    comments = (u.filter(F.col("turn") > 0)
                .groupBy("post_id")
                .agg(F.sort_array(F.collect_list(F.struct(
                    F.col("turn"), F.col("author"), F.col("raw_text").alias("body"),
                    F.col("score")))).alias("c")))
    titles = u.filter(F.col("turn") == 0).select(
        "post_id", F.col("raw_text").alias("title"), "created_utc", "score")
    p = titles.join(comments, "post_id", "left")
    arr = F.coalesce(F.transform("c", lambda s: F.struct(
        s["author"].alias("author"), s["body"].alias("body"), s["score"].alias("score"))),
        F.array().cast("array<struct<author:string,body:string,score:bigint>>"))
    return p.select("post_id", "title", "created_utc", "score",
                    F.size(arr).cast("bigint").alias("num_comments"), arr.alias("comments"))
