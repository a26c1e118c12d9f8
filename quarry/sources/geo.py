"""GEO and ASSIGN bindings (FIXTURES.md §3) and the adjacency reader.

Places are nations ('NATION_k, REGION_r'); coordinates are a fixed rule of
the keys; adjacency = nations of one region plus consecutive keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import table

# The coordinate rule of the test geography and the colours.
COLOURS = ["red", "blue", "green"]
START_KEYS = [0, 1, 2]
GOAL_KEYS = [22, 23, 24]


def region_lat(k) -> Column:
    return F.lit(-20.0) + k * F.lit(10.0)


def region_lon(k) -> Column:
    return F.lit(-80.0) + k * F.lit(40.0)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    j = n.join(F.broadcast(r), "n_regionkey")
    k = F.col("n_nationkey")
    return j.select(
        k.alias("key"),
        F.concat_ws(", ", F.col("n_name"), F.col("r_name")).alias("place"),
        F.col("r_name").alias("state"),
        region_lat(F.col("n_regionkey")).alias("lat"), region_lon(F.col("n_regionkey")).alias("lon"),
        F.element_at(F.array(*[F.lit(c) for c in COLOURS]), (k % 3 + 1).cast("int")).alias("colour"))


def adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(place, neighbor) both directions, no self loops (SP1)."""
    p = places(spark, sf_dir)
    a = p.select(F.col("key").alias("ka"), F.col("place").alias("place"), F.col("state").alias("sa"))
    b = p.select(F.col("key").alias("kb"), F.col("place").alias("neighbor"), F.col("state").alias("sb"))
    # one equi-join per way of being neighbours
    same = a.join(b, F.col("sa") == F.col("sb"))
    for step in (1, -1):
        same = same.unionByName(a.join(b, F.col("kb") == F.col("ka") + step))
    return same.filter(F.col("place") != F.col("neighbor")).select("place", "neighbor").distinct()


def split_place(c) -> tuple[Column, Column]:
    """T23: 'County, ST' -> (county, state), trimmed."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.split(c, ",")[0]), F.trim(F.element_at(F.split(c, ","), -1))


def strip_colour(c) -> Column:
    """Remove a 'colour:' / 'colour ' prefix."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(c, "^(red|blue|green)[: ]+", ""))


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    """Adjacency CSV with positional rename of the first two columns."""
    df = spark.read.option("header", True).csv(path)
    cols = ["countyname", "neighborname"] + df.columns[2:]
    return df.toDF(*cols)


def assignment_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ASSIGN: (i, j, vi, vj, cost) for every directed edge and value pair;
    cost = 100 + (i*31 + j*17 + vi*7 + vj*3) % 100 (symmetric rule applied
    to the unordered pair so the reverse direction is the transpose)."""
    p = places(spark, sf_dir).select("key", "place")
    adj = adjacency(spark, sf_dir)
    e = (adj.join(p.withColumnRenamed("place", "place").withColumnRenamed("key", "i"), "place")
         .join(p.select(F.col("place").alias("neighbor"), F.col("key").alias("j")), "neighbor").select("i", "j"))
    dom = F.array(F.lit(0), F.lit(1), F.lit(2))
    c = e.select("i", "j", F.explode(dom).alias("vi")).select("i", "j", "vi", F.explode(dom).alias("vj"))
    lo, hi = F.least("i", "j"), F.greatest("i", "j")
    vlo = F.when(F.col("i") < F.col("j"), F.col("vi")).otherwise(F.col("vj"))
    vhi = F.when(F.col("i") < F.col("j"), F.col("vj")).otherwise(F.col("vi"))
    return c.select("i", "j", "vi", "vj", (F.lit(100) + (lo * 31 + hi * 17 + vlo * 7 + vhi * 3) % 100).alias("cost"))


def initial_values(spark: SparkSession, sf_dir: str, run: int = 0) -> DataFrame:
    p = places(spark, sf_dir)
    return p.select(F.col("key").alias("agent"), ((F.col("key") + run) % 3).cast("int").alias("value"))
