"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives, texts taken without regard to labels
the unlabelled set. A linear numpy classifier on hashed word presence minimises
prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)): toxic
texts among the unlabelled ones do not count as clean."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import id_text, per_slice, small, words_of

FEATURES = 1 << 18
#: Bounds of the training sample (documents, expected); the rest of the corpus is only scored.
POSITIVES, UNLABELLED = 3_000, 9_000
#: A feature counts if so many positives have it.
LEAST_DOCS = 5
EPOCHS, RATE = 150, 0.1
#: The L1 step is the larger of these, the second over the number of positives: fewer positives, fewer features.
L1, L1_POSITIVES = 1e-4, 0.05
#: Lengths of the word beginnings that are features beside the whole words.
BEGINNINGS = (4, 5)
MARKS = ".,;:!?\"'()[]{}<>|*#$%&-_/"


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def word_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document, hashed feature) of the distinct words and word beginnings of
    each document, sorted."""
    counts, flat = words_of(texts, lower=True)
    d = flat.dictionary_encode()
    words = pc.utf8_trim(d.dictionary, MARKS)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code, doc = np.asarray(d.indices, dtype=np.int64), np.repeat(np.arange(len(counts)), counts)
    pair = np.unique(doc * len(words) + code)  # each word once per document
    doc, code = pair // len(words), pair % len(words)
    length = np.asarray(pc.utf8_length(words))
    columns = []
    for n in (0, *BEGINNINGS):
        part = (pc.utf8_slice_codeunits(words, 0, n) if n else words).dictionary_encode()
        hashed = pd.util.hash_array(np.asarray(part.dictionary.to_pylist(), dtype=object), categorize=False)
        hashed = ((hashed ^ np.uint64(n * 0x9E3779B9)) % np.uint64(FEATURES)).astype(np.int64)[np.asarray(part.indices)]
        hashed[(length <= n) if n else (length == 0)] = -1
        columns.append(hashed[code])
    feature = np.concatenate(columns)
    pair = np.unique((np.tile(doc, len(columns)) * FEATURES + feature)[feature >= 0])
    return pair // FEATURES, pair % FEATURES


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Full-batch non-negative PU risk with the logistic loss: Adam steps and an
    L1 proximal step, which leaves weights to few features. Each list holds the
    feature ids of a document."""
    docs = positive + unlabelled
    size = np.array([len(d) for d in docs], dtype=np.int64)
    row = np.repeat(np.arange(len(docs)), size)
    col = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    used = np.flatnonzero(np.bincount(col[row < len(positive)], minlength=FEATURES) >= LEAST_DOCS)
    place = np.full(FEATURES, -1)
    place[used] = np.arange(len(used))
    fine = place[col] >= 0
    row, col = row[fine], place[col[fine]]
    n_pos, n_unl = max(len(positive), 1), max(len(unlabelled), 1)
    is_pos = np.arange(len(docs)) < len(positive)
    w = np.zeros(len(used) + 1)
    w[-1] = np.log(prior / (1 - prior))
    first, second, shrink = np.zeros(len(w)), np.zeros(len(w)), max(L1, L1_POSITIVES / n_pos)
    for step in range(1, EPOCHS + 1):
        z = np.bincount(row, weights=w[col], minlength=len(docs)) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.logaddexp(0, z)  # loss of calling it clean
        negative = (clean[~is_pos].mean() if unlabelled else 0.0) - prior * (clean[is_pos].mean() if positive else 0.0)
        if negative >= 0:  # gradient in z of the whole risk
            g = np.where(is_pos, prior * (p - 1) / n_pos - prior * p / n_pos, p / n_unl)
        else:  # over-fitted: step back from the corrected part alone
            g = np.where(is_pos, prior * p / n_pos, -p / n_unl)
        grad = np.append(np.bincount(col, weights=g[row], minlength=len(used)), g.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        scale = RATE / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-6)
        w -= scale * first / (1 - 0.9 ** step)
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - np.minimum(scale[:-1] * shrink, 1.0), 0)
    weights = np.zeros(FEATURES)
    weights[used] = w[:-1]
    return Model(weights, float(w[-1]))


def train(docs: DataFrame, positives: DataFrame, prior: float, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """``positives``: ids (column doc_id) confirmed toxic. Both sets are samples by id hash
    of at most about POSITIVES and UNLABELLED documents."""
    base = id_text(docs, id_col, text_col).where("doc_id is not null")
    ids = positives.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    share = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    chosen = small(ids.where(share < POSITIVES / max(ids.count(), 1)), 2 * POSITIVES)

    def collect(rows: DataFrame) -> list[np.ndarray]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            doc, feature = word_features(batch.column(1))
            n = np.bincount(doc, minlength=batch.num_rows)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(feature, pa.int32()))
            return pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "features"])
        got = rows.mapInArrow(per_slice(run), "doc_id long, features array<int>").orderBy("doc_id").toArrow()
        return [np.asarray(x.values, dtype=np.int64) for x in got.column("features")]
    toxic = collect(base.join(chosen, "doc_id", "left_semi"))
    mixed = collect(base.where(share < UNLABELLED / max(base.count(), 1)))
    return fit(toxic, mixed, min(max(prior, 1e-3), 0.5))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``score`` (0 to 1) of every row; a null or empty text has the
    score of no words."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, feature = word_features(batch.column(1))
        z = np.bincount(doc, weights=model.weights[feature], minlength=batch.num_rows) + model.bias
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], names=["doc_id", "score"])
    return id_text(docs, id_col, text_col).mapInArrow(per_slice(run), "doc_id long, score double")
