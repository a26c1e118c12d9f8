"""Structured Streaming use of the stateless operators.

The reference has no streaming operators (all data is re-read in batch).
The row-level operators (normalisation, sentiment, period tagging, mention
detection) are plain column expressions, so they apply unchanged to a
streaming DataFrame; this module wires them to ``readStream`` sources and a
checkpointed sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.functions.sentiment import with_compound
from quarry.functions.text import normalize_text, polarity_label
from quarry.operators.mentions import mentions_expr
from quarry.sources.bindings import period_of


def score_texts(stream: DataFrame, text: str = "text", ts: str | None = None) -> DataFrame:
    """Normalise, score, label, tag the period and detect mentions of each
    incoming row (no state, so no watermark is needed)."""
    s = stream.withColumn("text_norm", normalize_text(text))
    s = with_compound(s, "text_norm")
    s = s.withColumn("sentiment_label", polarity_label("sentiment")).withColumn("mentions", mentions_expr("text_norm"))
    if ts:
        s = s.withColumn("period", period_of(ts))
    return s


def stream_parquet(spark: SparkSession, path: str, schema, max_files: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def start_sink(df: DataFrame, out_path: str, checkpoint: str, trigger_once: bool = True):
    """Append the scored rows to Parquet with a checkpoint (exactly-once
    file sink; restartable after executor or driver loss)."""
    w = df.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()

