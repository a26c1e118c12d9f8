"""TAB and CAT bindings (FIXTURES.md §3) and the training-table reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import table

TAB_NUMERIC = ["age", "driving_experience", "credit_score", "annual_mileage",
               "speeding_violations", "past_accidents"]
TAB_CATEGORICAL = ["vehicle_type", "married", "children"]


def tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer feature table with injected nulls and a 0/1 label."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"),
        F.sum((F.col("o_orderpriority") == "1-URGENT").cast("long")).alias("urgent"),
        F.sum((F.col("o_orderstatus") == "P").cast("long")).alias("pending"))
    c = table(spark, sf_dir, "customer")
    j = c.join(o, "c_custkey", "left")
    k = F.col("c_custkey")
    return j.select(
        k.alias("id"),
        (F.lit(16) + k % 70).alias("age"),
        (k * 7 % 60).alias("driving_experience"),
        F.when(k % 17 != 0, (F.col("c_acctbal") + 1000) / 11000).alias("credit_score"),
        F.when(k % 19 != 0, F.col("cents").cast("double") / F.lit(100000.0)).alias("annual_mileage"),
        F.coalesce("urgent", F.lit(0)).alias("speeding_violations"),
        F.coalesce("pending", F.lit(0)).alias("past_accidents"),
        F.col("c_mktsegment").alias("vehicle_type"),
        F.when(F.col("c_nationkey") % 2 == 0, "yes").otherwise("no").alias("married"),
        F.when(k % 3 == 0, "yes").otherwise("no").alias("children"),
        (F.col("c_acctbal") > 0).cast("int").alias("outcome"))


TRAINING_SCHEMA = ("ID long, age long, driving_experience long, credit_score double, annual_mileage double, speeding_violations long, "
                   "past_accidents long, vehicle_type string, married string, children string, outcome int")


def read_training_table(spark: SparkSession, path: str, fmt: str = "csv", schema: str = TRAINING_SCHEMA) -> DataFrame:
    """Read the training table with its declared schema and drop its ID column."""
    df = spark.read.schema(schema).option("header", True).csv(path) if fmt == "csv" else spark.read.format(fmt).load(path)
    return df.drop("ID")
