"""File sources and sinks.

Readers declare their schemas; sinks write one partitioned dataset instead
of one file per loop iteration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

POST_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("created_utc", T.StringType()),
    T.StructField("score", T.LongType()), T.StructField("num_comments", T.LongType()),
    T.StructField("comments", T.StringType())])
COMMENT_SCHEMA = "array<struct<author:string,body:string,score:bigint>>"


def read_posts(spark: SparkSession, glob: str) -> DataFrame:
    """S1 + L5: one CSV (or one ``entity=`` folder) per entity, multi-line
    quoted, concatenated; the entity slug comes from the folder or file name;
    comments decoded (S2)."""
    df = (spark.read.schema(POST_SCHEMA).option("header", True).option("multiLine", True)
          .option("escape", '"').csv(glob))
    ent = F.regexp_extract(F.input_file_name(), r"([^/]+)\.csv$", 1)
    if "entity" in df.columns:
        ent = F.col("entity").cast("string")
    return df.select(ent.alias("entity"), "title", F.to_timestamp("created_utc").alias("created_utc"),
                     "score", "num_comments", parse_comment_literal("comments").alias("comments"))


def parse_comment_literal(c) -> Column:
    """Python-literal list of dicts -> array<struct>. ``\\xNN`` escapes
    become ``\\u00NN`` and the JSON reader accepts single quotes."""
    c = F.col(c) if isinstance(c, str) else c
    j = F.regexp_replace(c, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
    return F.from_json(j, COMMENT_SCHEMA, {"allowSingleQuotes": "true",
                                           "allowBackslashEscapingAnyCharacter": "true"})


def comment_literal(c) -> Column:
    """Inverse of S2: array<struct<author, body, score>> as the text of a Python
    list of dicts."""
    def quoted(x):
        x = F.regexp_replace(F.regexp_replace(x, r"\\", r"\\\\"), "'", r"\\'")
        return F.concat(F.lit("'"), F.regexp_replace(F.regexp_replace(x, "\n", r"\\n"), "\r", r"\\r"), F.lit("'"))
    one = F.transform(c, lambda x: F.concat(F.lit("{'author': "), quoted(x["author"]), F.lit(", 'body': "), quoted(x["body"]),
                                            F.lit(", 'score': "), x["score"].cast("string"), F.lit("}")))
    return F.concat(F.lit("["), F.array_join(one, ", "), F.lit("]"))


def write_posts(posts: DataFrame, path: str) -> None:
    """Posts (``entity`` first) in the layout that ``read_posts`` reads."""
    (posts.select("entity", "title", F.col("created_utc").cast("string").alias("created_utc"), "score", "num_comments",
                  comment_literal("comments").alias("comments"))
     .write.partitionBy("entity").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def comment_rows(posts: DataFrame, keep: list[str]) -> DataFrame:
    """S3: one row per comment with its position and the post context."""
    return posts.select(*keep, F.posexplode_outer("comments").alias("pos", "c")).select(
        *keep, "pos", F.col("c.author").alias("author"), F.col("c.body").alias("body"), F.col("c.score").alias("score"))


def top_posts(posts: DataFrame, keys: list[str], n: int = 50, order: str = "score", tie: str = "post_id") -> DataFrame:
    """Top-n posts per key (e.g. channel, keyword) by score."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc(), F.col(tie))
    return posts.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= n)


def first_comments(posts: DataFrame, keep: list[str], limit: int = 20) -> DataFrame:
    """The first ``limit`` comments, then drop deleted / removed ones
    (this order is the reference's)."""
    r = comment_rows(posts, keep)
    return r.filter(F.col("pos") < limit).filter(~F.col("body").isin("[deleted]", "[removed]"))


# ---- sinks -----------------------------------------------------------------

def write_partitioned(df: DataFrame, path: str, part: str = "period", fmt: str = "csv") -> None:
    """One dataset partitioned by ``part`` (per-period files)."""
    w = df.write.partitionBy(part)
    (w.option("header", True).csv(path) if fmt == "csv" else w.format(fmt).save(path))


def write_predictions(df: DataFrame, path: str, target: str = "target") -> None:
    """Scored rows with a ``target`` column (Parquet instead of Excel)."""
    df.withColumnRenamed("prediction", target).write.parquet(path)


def report_rows(report: str, section: str, metrics: dict) -> list[tuple]:
    """Long (report, section, metric, value) rows for a metric report."""
    return [(report, section, k, str(v)) for k, v in metrics.items()]


def write_report(spark: SparkSession, rows: list[tuple], path: str) -> None:
    spark.createDataFrame(rows, "report string, section string, metric string, value string") \
        .write.partitionBy("report").option("header", True).csv(path)
