"""Language identification by mixture inference.

Letter trigrams (bytes, hashed) give each language an n-gram likelihood. A
document is a mixture: each of its words comes from one language, and
expectation-maximisation estimates the proportions. Starting from all learned
languages, the one with the least share is given up as long as the likelihood
falls by less than a penalty per language; the rest is the language set."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import per_slice, slices

#: Hashed trigram table per language; the model is languages x BUCKETS numbers.
BUCKETS = 1 << 15
SMOOTHING = 0.5
PENALTY = 3.0
ROUNDS = 8
UNDETERMINED = "und"


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # BUCKETS x languages, float32


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed trigram, document, word) of every trigram; words are numbered
    over the whole array. Bytes that are not letters (ASCII) are gaps."""
    texts = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.binary())
    size = np.asarray(pc.binary_length(texts), dtype=np.int64) + 1
    data = np.frombuffer(b" ".join(texts.to_pylist()) + b" ", np.uint8)
    doc = np.repeat(np.arange(len(size), dtype=np.int32), size)
    letter = ((data >= 97) & (data <= 122)) | (data >= 128)
    c = np.where(letter, data, 32).astype(np.uint32)
    before = np.concatenate(([False], letter[:-1]))
    word = np.cumsum(letter & ~before) - 1
    b1 = np.concatenate(([32], c[:-1])).astype(np.uint32)
    b2 = np.concatenate(([32], b1[:-1])).astype(np.uint32)
    b2 = np.where(b1 == 32, 32, b2)  # trigrams do not reach over a gap
    at = np.flatnonzero(letter | before)
    h = (b2[at] * np.uint32(0x01000193) + b1[at]) * np.uint32(0x01000193) + c[at]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(17)).astype(np.int64), doc[at].astype(np.int64), word[at]


def train(rows: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Counts over all given rows with a language. One partial aggregate; what
    comes back is languages x BUCKETS numbers at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                langs = part.column(0).dictionary_encode()
                names = langs.dictionary.to_pylist()
                h, doc, _ = grams(part.column(1))
                found = np.bincount(np.asarray(langs.indices, dtype=np.int64)[doc] * BUCKETS + h, minlength=len(names) * BUCKETS)
                for k, name in enumerate(names):
                    held[name] = held.get(name, 0) + found[k * BUCKETS:(k + 1) * BUCKETS]
        for name, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(n[at])], names=["lang", "bucket", "n"])
    counted = (rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
               .where("lang is not null").mapInArrow(count, "lang string, bucket long, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow().combine_chunks())
    lang, bucket, n = (counted.column(i).to_numpy(zero_copy_only=False) for i in range(3))
    languages = sorted(set(lang.tolist()))
    place = {x: i for i, x in enumerate(languages)}
    table = np.full((BUCKETS, max(len(languages), 1)), SMOOTHING)
    if len(lang):
        np.add.at(table, (bucket, np.array([place[x] for x in lang.tolist()])), n)
    return Model(languages, np.log(table / table.sum(axis=0)).astype(np.float32))


def mixtures(model: Model, texts: pa.Array) -> np.ndarray:
    """Proportions (documents x languages) over each document's language set;
    all zero for a document without words."""
    h, doc, word = grams(texts)
    out = np.zeros((len(texts), len(model.languages)))
    if not len(h) or not model.languages:
        return out
    first = np.flatnonzero(np.diff(word, prepend=-1))
    log = np.add.reduceat(model.log_p[h], first, axis=0)
    likely = np.exp(np.maximum(log - log.max(axis=1, keepdims=True), -60)).astype(np.float64)
    owner = doc[first]
    ids, begin, n = np.unique(owner, return_index=True, return_counts=True)

    def fit(rows: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM of the documents ``rows`` (indices of ids) over allowed languages."""
        size = n[rows]
        base = np.cumsum(size) - size
        words = likely[np.repeat(begin[rows] - base, size) + np.arange(int(size.sum()))]
        share = allowed / allowed.sum(axis=1, keepdims=True)
        for _ in range(ROUNDS):
            part = words * np.repeat(share, size, axis=0)
            total = part.sum(axis=1, keepdims=True)
            part /= np.maximum(total, 1e-300)
            share = np.add.reduceat(part, base, axis=0) / size[:, None]
        total = (words * np.repeat(share, size, axis=0)).sum(axis=1)
        return share, np.add.reduceat(np.log(np.maximum(total, 1e-300)), base)

    allowed = np.ones((len(ids), len(model.languages)))
    share, fitted = fit(np.arange(len(ids)), allowed)
    live = np.arange(len(ids)) if len(model.languages) > 1 else np.zeros(0, np.int64)
    while len(live):
        fewer = allowed[live].copy()
        rank = np.where(fewer > 0, share[live], np.inf)
        fewer[np.arange(len(live)), rank.argmin(axis=1)] = 0
        new_share, new_fitted = fit(live, fewer)
        fine = new_fitted >= fitted[live] - PENALTY
        won = live[fine]
        allowed[won], share[won], fitted[won] = fewer[fine], new_share[fine], new_fitted[fine]
        live = won[allowed[won].sum(axis=1) > 1]
    out[ids] = share * allowed
    return out


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ``lang_pred`` (largest proportion; ``und`` for a null
    text, one without a letter, or a model without languages), ``score`` (that
    proportion, 0 for ``und``) and ``languages`` (the set, largest first). Equal
    proportions go to the first language by name."""
    languages = model.languages

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column(1), "")
        known = np.asarray(pc.match_substring_regex(texts, r"\p{L}"))
        share = mixtures(model, texts)
        known &= share.sum(axis=1) > 0 if len(languages) else False
        best = share.argmax(axis=1) if len(languages) else np.zeros(len(texts), int)
        names = [languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist())]
        score = np.where(known, np.minimum(share.max(axis=1, initial=0.0), 1.0), 0.0)
        sets = [[languages[i] for i in np.argsort(-s, kind="stable") if s[i] > 0] if k else [] for s, k in zip(share, known)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(sets, pa.list_(pa.string()))],
                                          names=["doc_id", "lang_pred", "score", "languages"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        per_slice(run), "doc_id long, lang_pred string, score double, languages array<string>")


def keep_identified(docs: DataFrame, model: Model, languages: list[str] | None = None, least: float = 0.5,
                    lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The rows whose predicted language is one of ``languages`` (None: any that
    the model has learned) and makes up at least ``least`` of the document. A
    null ``lang_col`` gets the prediction; all other values, columns and their
    order stay. Null texts, texts without a letter and mixtures without a
    majority go; repeated rows are judged alike; an empty table, or a model
    without languages, gives none."""
    schema = docs.schema
    chosen = np.array([languages is None or name in languages for name in model.languages], dtype=bool)
    names = pa.array(model.languages, pa.string())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column(batch.schema.get_field_index(text_col)).cast(pa.string()), "")
        share = mixtures(model, texts)
        best = share.argmax(axis=1) if len(names) else np.zeros(len(texts), np.int64)
        fine = np.asarray(pc.match_substring_regex(texts, r"\p{L}")) & (share.max(axis=1, initial=0.0) >= max(least, 1e-12))
        if len(names):
            fine &= chosen[best]
        columns, at = list(batch.columns), batch.schema.get_field_index(lang_col)
        if at >= 0 and len(names):
            columns[at] = pc.coalesce(columns[at], names.take(pa.array(best)).cast(columns[at].type))
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(fine))
    return docs.mapInArrow(per_slice(run, text_col), schema)
