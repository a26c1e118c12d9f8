"""File sources and sinks as round trips (S1, S2, S7-S9, S11, S12, S14-S18): a
binding is written in the reference layout into the shared checkpoint folder
and read back by the reader under test."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quarry.plans import graph_queries, series_queries as SQ, source_queries, text_queries  # noqa: F401 - their oracles are reused
from quarry.plans.catalog import ORACLES, QUERIES, register
from quarry.plans.path_queries import PLACES_SQL
from quarry.plans.tab_sql import TAB_SQL
from quarry.session import ensure_checkpoint_dir
from quarry.sources import bindings as B
from quarry.sources import files as FS
from quarry.sources import geo as GE
from quarry.sources import prices as P
from quarry.sources import tabular as TBS


def folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files/{uuid.uuid4().hex}"


@register("file_posts", f"""WITH {source_queries.POSTS_SQL}
SELECT 'e' || t.post_id % 5 AS entity, t.title, t.created_utc, t.score, CAST(count(c.post_id) AS BIGINT) AS num_comments,
       CAST(count(c.post_id) AS INTEGER) AS n_read, md5(coalesce(string_agg(c.author || c.body || c.score, chr(10) ORDER BY c.pos), '')) AS comments_md5
FROM titles t LEFT JOIN crows c USING (post_id) GROUP BY t.post_id, t.title, t.created_utc, t.score""")
def file_posts(spark, sf):
    """S1 + S2: posts written per entity with their comments as a Python
    literal, read back and decoded."""
    path = folder(spark)
    FS.write_posts(B.posts(spark, sf).withColumn("entity", F.concat(F.lit("e"), F.col("post_id") % 5)), path)
    text = F.array_join(F.transform("comments", lambda c: F.concat(c["author"], c["body"], c["score"].cast("string"))), "\n")
    return FS.read_posts(spark, path).select("entity", "title", "created_utc", "score", "num_comments",
                                             F.size("comments").alias("n_read"), F.md5(text).alias("comments_md5"))


@register("file_vendor_prices", f"""WITH {SQ.BASE_SQL}
SELECT symbol, CASE WHEN CAST(volume AS BIGINT) % 7 <> 0 THEN date END AS date, CAST(floor(close) AS DOUBLE) AS close, CAST(floor(open) AS DOUBLE) AS open,
       CAST(floor(open) AS DOUBLE) AS high, CAST(floor(close) AS DOUBLE) AS low, round(volume * 1000, 3) AS volume, 0.0125::DOUBLE AS change FROM prices""")
def file_vendor_prices(spark, sf):
    """Vendor price layout (MM/dd/yyyy, thousands separators, 12.5K, 1.25%);
    a bad date reads as null."""
    path = folder(spark)
    money = lambda c: F.format_number(F.floor(c), 2)
    date = F.when(F.col("volume").cast("long") % 7 != 0, F.date_format("date", "MM/dd/yyyy")).otherwise("n/a")
    rows = P.prices(spark, sf).select("symbol", date.alias("Date"), money("close").alias("Price"), money("open").alias("Open"),
                                      money("open").alias("High"), money("close").alias("Low"),
                                      F.concat(F.format_string("%.1f", "volume"), F.lit("K")).alias("Vol."), F.lit("1.25%").alias("Change %"))
    rows.write.partitionBy("symbol").option("header", True).option("quoteAll", True).csv(path)
    return P.read_vendor_prices(spark, path).withColumn("volume", F.round("volume", 3))


@register("file_eps", f"""WITH {SQ.BASE_SQL}
SELECT date, quarterly_eps, publish_date FROM eps2""")
def file_eps(spark, sf):
    """EPS table with parsed publish date."""
    path = folder(spark)
    P.eps(spark, sf).select("date", "quarterly_eps", "publish_date").write.option("header", True).csv(path)
    return P.read_eps(spark, path)


@register("file_quotes", f"""WITH {SQ.BASE_SQL} SELECT date, close, volume, open FROM prices""")
def file_quotes(spark, sf):
    """Quote history with upper-case names and timestamps."""
    path = folder(spark)
    P.prices(spark, sf).select(F.concat(F.col("date").cast("string"), F.lit(" 00:00:00-05:00")).alias("Date"), F.col("open").alias("Open"),
                               F.col("close").alias("Close"), F.col("volume").alias("Volume")).write.option("header", True).csv(path)
    return P.read_normalised_prices(spark, path)


@register("file_training_table", f"""WITH {TAB_SQL}
SELECT age, driving_experience, credit_score, annual_mileage, speeding_violations, past_accidents, vehicle_type, married, children, outcome FROM tab""")
def file_training_table(spark, sf):
    """Training table read back without its ID."""
    path = folder(spark)
    TBS.tab(spark, sf).withColumnRenamed("id", "ID").select(*[c.split()[0] for c in TBS.TRAINING_SCHEMA.split(", ")]).write.option("header", True).csv(path)
    return TBS.read_training_table(spark, path)


@register("file_adjacency", f"WITH {PLACES_SQL} SELECT place AS countyname, neighbor AS neighborname, 1 AS w FROM adj")
def file_adjacency(spark, sf):
    """Adjacency table, first two columns renamed by position."""
    path = folder(spark)
    GE.adjacency(spark, sf).select(F.col("place").alias("a"), F.col("neighbor").alias("b"), F.lit(1).alias("w")).write.option("header", True).csv(path)
    return GE.read_adjacency(spark, path).withColumn("w", F.col("w").cast("int"))


def _stored(name: str):
    """A registered result written as one CSV folder per period and read back."""
    def run(spark, sf):
        path, df = folder(spark), QUERIES[name](spark, sf)
        FS.write_partitioned(df, path)
        return spark.read.schema(df.schema).option("header", True).csv(path).select(df.columns)
    run.__doc__ = f"S14 / S16: ``{name}`` written per period and read back."
    return run


for _name in ("word_stats", "edge_sentiment"):
    register(f"file_{_name}", ORACLES[_name])(_stored(_name))


@register("file_sentiment_over_time", ORACLES["sentiment_over_time"])
def file_sentiment_over_time(spark, sf):
    """The entity x period matrix as CSV."""
    path, df = folder(spark), QUERIES["sentiment_over_time"](spark, sf)
    df.write.option("header", True).csv(path)
    return spark.read.schema(df.schema).option("header", True).csv(path)


@register("file_predictions", f"""WITH {TAB_SQL}
SELECT id, CAST(CASE WHEN past_accidents > speeding_violations THEN 1 ELSE 0 END AS INTEGER) AS target FROM tab""")
def file_predictions(spark, sf):
    """Predictions stored under ``target``."""
    path = folder(spark)
    rule = F.when(F.col("past_accidents") > F.col("speeding_violations"), 1).otherwise(0)
    FS.write_predictions(TBS.tab(spark, sf).select("id", rule.alias("prediction")), path)
    return spark.read.parquet(path)


@register("file_reports", f"""WITH o AS ({ORACLES["graph_overview"]})
SELECT period AS report, 'graph' AS section, metric, value FROM (
  SELECT period, unnest(['nodes', 'edges']) AS metric, unnest([CAST(nodes AS VARCHAR), CAST(edges AS VARCHAR)]) AS value FROM o)""")
def file_reports(spark, sf):
    """Metric report as long rows, one folder per report."""
    path = folder(spark)
    rows = [r for o in QUERIES["graph_overview"](spark, sf).collect()  # one row per period
            for r in FS.report_rows(o["period"], "graph", {"nodes": o["nodes"], "edges": o["edges"]})]
    FS.write_report(spark, rows, path)
    return spark.read.schema("section string, metric string, value string, report string").option("header", True).csv(path)
