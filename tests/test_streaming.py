import tempfile

from pyspark.sql import functions as F

from quarry.streaming.stateless import score_texts, start_sink, stream_parquet


def test_stream_scores_match_batch(spark):
    src = tempfile.mkdtemp(prefix="qs-src-", dir="/tmp")
    out = tempfile.mkdtemp(prefix="qs-out-", dir="/tmp")
    ck = tempfile.mkdtemp(prefix="qs-ck-", dir="/tmp")
    conv = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "text")
    conv.write.mode("overwrite").parquet(src + "/in")
    s = stream_parquet(spark, src + "/in", conv.schema)
    q = start_sink(score_texts(s).drop("mentions"), out + "/o", ck)
    q.awaitTermination(120)
    got = spark.read.parquet(out + "/o")
    batch = score_texts(conv).drop("mentions")
    assert got.count() == batch.count()
    assert got.select("conv_id", "turn", "sentiment").exceptAll(batch.select("conv_id", "turn", "sentiment")).count() == 0
