"""PRICES / EPS bindings (FIXTURES.md §3) and price-file readers.

Weekly market-segment price series derived from orders x customer. Prices
are carried as exact cents so every engine and partitioning produce the
same closes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import params
from quarry.session import table


def _seg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return o.join(c, "o_custkey").select(
        F.col("c_mktsegment").alias("symbol"), "o_orderkey", "o_orderdate",
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, date, open, close, volume): weekly mean order price per
    segment = close, order count = volume, first order's price = open."""
    s = _seg_orders(spark, sf_dir)
    wk = F.to_date(F.date_trunc("week", F.col("o_orderdate")))
    g = s.groupBy("symbol", wk.alias("date")).agg(
        F.sum("cents").alias("sc"), F.count("*").alias("n"),
        F.min_by("cents", F.struct("o_orderdate", "o_orderkey")).alias("oc"))
    return g.select("symbol", "date",
                    (F.col("oc") / F.lit(100.0)).alias("open"),
                    (F.col("sc").cast("double") / F.col("n") / F.lit(100.0)).alias("close"),
                    F.col("n").cast("double").alias("volume"))


def eps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, date, quarterly_eps, publish_date): quarterly mean price /
    10000, published 40 days after the quarter end."""
    s = _seg_orders(spark, sf_dir)
    q = F.to_date(F.date_trunc("quarter", F.col("o_orderdate")))
    g = s.groupBy("symbol", q.alias("date")).agg(F.sum("cents").alias("sc"), F.count("*").alias("n"))
    return g.select("symbol", "date",
                    (F.col("sc").cast("double") / F.col("n") / F.lit(1000000.0)).alias("quarterly_eps"),
                    F.date_add(F.date_sub(F.add_months("date", 3), 1), 40).alias("publish_date"))


def betas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(params.BETAS, "symbol string, beta double")


def with_beta(df: DataFrame, beta_dim: DataFrame) -> DataFrame:
    """Attach a per-symbol constant through a broadcast dimension join
    (the dimension has one row per symbol)."""
    return df.join(F.broadcast(beta_dim), "symbol", "left")


# ---- file readers (S7-S9) -------------------------------------------------

VENDOR_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in
                              ["Date", "Price", "Open", "High", "Low", "Vol.", "Change %"]])


def parse_volume(c) -> F.Column:
    """'46.14M' -> 46140000.0 (K, M, B suffixes)."""
    c = F.trim(F.col(c) if isinstance(c, str) else c)
    num = F.try_to_number(F.regexp_replace(c, "[KMB]$", ""), F.lit("9999999999.9999"))
    mult = (F.when(c.endswith("K"), 1e3).when(c.endswith("M"), 1e6)
            .when(c.endswith("B"), 1e9).otherwise(1.0))
    return num.cast("double") * mult


def read_vendor_prices(spark: SparkSession, path: str, symbol: str | None = None) -> DataFrame:
    """Vendor CSV (BOM, quoted, MM/dd/yyyy, '46.14M', '-1.17%'); bad
    dates become null."""
    df = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
          .schema(VENDOR_SCHEMA).csv(path))
    num = lambda c: F.regexp_replace(F.col(c), ",", "").cast("double")
    out = df.select(
        *[c for c in df.columns if c == "symbol"],
        F.to_date(F.try_to_timestamp(F.col("Date"), F.lit("MM/dd/yyyy"))).alias("date"),
        num("Price").alias("close"), num("Open").alias("open"),
        num("High").alias("high"), num("Low").alias("low"),
        parse_volume("`Vol.`").alias("volume"),
        (F.regexp_replace(F.col("Change %"), "%", "").cast("double") / 100).alias("change"))
    return out.withColumn("symbol", F.lit(symbol)) if symbol else out


def read_normalised_prices(spark: SparkSession, path: str) -> DataFrame:
    """Date, close, volume, open, beta layout; lower-case names."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    df = df.toDF(*[c.lower() for c in df.columns])
    return df.select(F.to_date(F.substring("date", 1, 10)).alias("date"),
                     *[F.col(c).cast("double").alias(c) for c in ("close", "volume", "open", "beta")
                       if c in df.columns])


def read_eps(spark: SparkSession, path: str) -> DataFrame:
    """Date, quarterly_eps, publish_date."""
    sch = "date string, quarterly_eps double, publish_date string"
    df = spark.read.option("header", True).schema(sch).csv(path)
    return df.select(F.to_date("date").alias("date"), "quarterly_eps",
                     F.to_date("publish_date").alias("publish_date"))
