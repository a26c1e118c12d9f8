"""Graphs over the generated tables whose rows grow with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import table


def part_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst)``, src < dst: parts of one order in about the same quantity
    (equal halves of it, rounded down). Nodes and edges grow with the orders."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.floor(F.col("l_quantity") / 2).alias("half"))
    other = lines.withColumnRenamed("l_partkey", "dst")
    return (lines.withColumnRenamed("l_partkey", "src").join(other, ["l_orderkey", "half"]).where("src < dst")
            .select("src", "dst").distinct())


def brand_backbone(spark: SparkSession, sf_dir: str, pairs: int = 80) -> DataFrame:
    """``(src, dst, weight)``: the pairs of brands that most orders hold, the
    strongest ``pairs`` of them (ties: smaller names), so that a graph of few
    nodes does not become complete as orders are added."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").join(part, "l_partkey").select("l_orderkey", "p_brand").distinct()
    both = lines.withColumnRenamed("p_brand", "src").join(lines.withColumnRenamed("p_brand", "dst"), "l_orderkey").where("src < dst")
    return both.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight")).orderBy(F.desc("weight"), "src", "dst").limit(pairs)
