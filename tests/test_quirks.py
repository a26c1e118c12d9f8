
from pyspark.sql import functions as F

from quarry.operators import mentions as M
from quarry.sources.bindings import period_of

PERIODS = [("a", "2020-01-01", "2020-12-31"), ("b", "2021-01-01", "2021-12-31")]


def test_period_end_is_midnight(spark):
    # Q3: the last day after 00:00 has no period
    df = spark.createDataFrame([("2020-12-31 00:00:00",), ("2020-12-31 10:00:00",), ("2021-06-01 00:00:00",)], "t string")
    got = [r.p for r in df.select(period_of(F.to_timestamp("t"), PERIODS).alias("p")).collect()]
    assert got == ["a", None, "b"]


def test_substring_mentions_and_word_option(spark):
    # Q4: substring hits inside other words unless match='word'
    table = [("Ark Invest", ["ark"]), ("Jim", ["jim"])]
    df = spark.createDataFrame([("the market is parked",), ("jim said",)], "text string")
    sub = [r.m for r in df.select(M.mentions_expr("text", table).alias("m")).collect()]
    word = [r.m for r in df.select(M.mentions_expr("text", table, match="word").alias("m")).collect()]
    assert sub == [["Ark Invest"], ["Jim"]]
    assert word == [[], ["Jim"]]


def test_edge_pairs_sorted_and_aggregated(spark):
    # Q21 fixed: src < dst; weight = sum of text scores; mean of sentiments
    table = [("A", ["aa"]), ("B", ["bb"]), ("C", ["cc"])]
    df = spark.createDataFrame([("p", "bb aa cc", 3, 0.5), ("p", "aa bb", 2, -0.1)],
                               "period string, text string, score int, sentiment double")
    e = {(r.src, r.dst): (r.weight, r.num_mentions, r.average_sentiment)
         for r in M.edges(df, table=table).collect()}
    assert e[("A", "B")] == (5, 2, 0.2)
    assert e[("A", "C")] == (3, 1, 0.5) and e[("B", "C")] == (3, 1, 0.5)
