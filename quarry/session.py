"""Session and table helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "quarry") -> SparkSession:
    """Local / test session. On a cluster, use the cluster's own session."""
    b = (SparkSession.builder
         .appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEM", "8g")))
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only set one when unset (tests)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions manage checkpoints themselves
        return d or ""
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        # only for local runs / tests: the cluster names a shared folder
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="quarry-ckpt-", dir="/tmp")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - static conf in some deployments
            pass
    if sc.getCheckpointDir() is None:  # one folder per application; Spark makes a new one on every call
        sc.setCheckpointDir(d)
    return d


def written(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared checkpoint folder: cuts
    lineage, and later plans know its real size."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deals a scan of fewer partitions than cores out by ``keys``, for work
    that costs far more than the shuffle (text cleaning); larger scans stay."""
    spark = df.sparkSession
    if df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism:
        return df
    return df.repartition(spark.sparkContext.defaultParallelism, *keys)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
