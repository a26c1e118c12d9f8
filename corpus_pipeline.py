"""From raw documents to packed training sequences.

Every stage takes what its predecessor kept. All but the last return the
columns of ``documents``; the last returns the packed pieces."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import op1_substrings, op4_packing, op7_simhash, op8_language, op9_winnow
from quarry.llm.common import crc_mod
from quarry.llm.queries import tokenizer_path
from quarry.session import ensure_checkpoint_dir, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in one language for the most part, as predicted; a null
    ``lang`` gets the prediction. Null texts and texts without a letter go; an
    empty table stays empty; repeated rows are judged alike."""
    model = op8_language.train(docs.where(crc_mod("doc_id", 3) != 1))
    return op8_language.keep_identified(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the smallest id; of equal ids or
    repeated rows one stays. Texts without words are one component."""
    return op7_simhash.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without the words that documents of smaller ids
    repeat. A null text has none; repeated rows have one id and keep theirs."""
    return op1_substrings.cleaned(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark; null and empty texts
    are not, and an empty benchmark contaminates none."""
    return op9_winnow.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, repeated rows each, placed in sequences; a null
    text is an empty document; no documents give no rows."""
    return op4_packing.pack(docs, tokenizer_path())


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("decontamination", decontamination), ("packing", packing)]

#: No SQL: language and tokenizer stages cannot be expressed in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
