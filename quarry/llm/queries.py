"""The registered queries of this folder: every operator over its whole table
with production parameters, and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import crc_mod, documents, written
from quarry.llm.oracles import ORACLES  # noqa: F401 - read by the entry point
from quarry.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.op4_packing import pack
    return pack(documents(spark, sf_dir), tokenizer_path())


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.op6_rules import rules
    return rules(documents(spark, sf_dir))


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.op1_substrings import remove_repeated
    return remove_repeated(documents(spark, sf_dir)).select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_run_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.op3_runs import remove_repeated
    return remove_repeated(documents(spark, sf_dir)).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.op7_simhash import near_duplicates
    return near_duplicates(documents(spark, sf_dir)).drop("version")


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.op9_winnow import decontaminate
    return decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")).drop("version")


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.op5_quality import CUT, score, train
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    held = crc_mod("doc_id", 5) == 0
    model = train(docs.where(~held), labels.where(~held))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.op8_language import identify, train
    docs = table(spark, sf_dir, "documents")
    held = crc_mod("doc_id", 3) == 1
    model = train(docs.where(~held))
    return identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "languages")


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.op10_toxicity import score, train
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    held = crc_mod("doc_id", 5) == 0
    known = labels.where(~held)
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0  # class prior: share of toxic texts among the labelled ones
    model = train(docs.where(~held), known.where("toxic = 1"), prior)
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.op2_language_model import score
    scored = score(documents(spark, sf_dir), crc_mod("doc_id", 7) != 2)
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.op11_bpe import encode
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encode(documents(spark, sf_dir), tokenizer_path(), decoded=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.op12_search import search
    return search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def aligned(docs: DataFrame) -> DataFrame:
    """Digest columns of the alignment of the two public vocabularies."""
    from quarry.llm.op13_align import align, with_counts
    found = align(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    linked = written(found.select("doc_id", "n_a", "n_b", "n_groups", digest, "link_a", "link_b"))
    return with_counts(linked).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(documents(spark, sf_dir))
