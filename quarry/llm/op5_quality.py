"""Quality classifier by Bradley-Terry pairwise ranking.

Every document has a score; a document labelled good is preferred over one
labelled bad, with probability sigmoid(score difference). The scores are linear
in bands of text statistics, so the logistic loss acts on feature differences of
preference pairs. The score at the quantile that matches the share of bad labels
is the threshold between the classes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import codes_of, id_text, per_slice, small, words_of
from quarry.llm.op6_rules import SPACES, SYMBOLS, repeat_words

#: Bound of the training sample per label (documents, expected) and of the preference pairs.
SAMPLE, PAIRS = 6_000, 60_000
BANDS = 8
STEPS, RATE, DECAY = 300, 0.05, 0.2
#: Score that the threshold maps to.
CUT = 0.3

STATISTICS = ("log_bytes", "log_words", "word_bytes", "upper", "digit", "symbol", "stop", "exclaim", "bar", "other_ascii",
              "non_ascii", "distinct", "common_word", "repeat8", "dup_lines", "line_words", "zstd", "capital_words", "long_words",
              "short_words", "marked_words", "double_marks", "sentence", "space")


@dataclass
class Model:
    edges: np.ndarray  # STATISTICS x (BANDS - 1)
    weights: np.ndarray  # STATISTICS x BANDS
    threshold: float
    scale: float


def _share(mask: np.ndarray, doc: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.bincount(doc[mask], minlength=len(n)) / np.maximum(n, 1)


def statistics(texts: pa.Array) -> np.ndarray:
    """documents x STATISTICS; an empty or null text is all zero."""
    texts = pc.fill_null(texts, "")
    counts, flat = words_of(texts)
    raw = texts.cast(pa.binary()).to_pylist()
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    compress = zstandard.ZstdCompressor(level=1).compress

    def without(chars: bytes) -> np.ndarray:
        return np.fromiter((len(t) - len(t.translate(None, chars)) for t in raw), np.int64, len(raw)) / np.maximum(size, 1)
    upper, digit = without(bytes(range(65, 91))), without(b"0123456789")
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in raw]
    n_lines = np.fromiter(map(len, lines), np.int64, len(raw))
    distinct_lines = np.fromiter((len(set(x)) for x in lines), np.int64, len(raw))
    code, words = codes_of(flat)
    doc = np.repeat(np.arange(len(counts)), counts)
    pair, times = np.unique(doc * max(len(words), 1) + code, return_counts=True)
    owner = pair // max(len(words), 1)
    most = np.zeros(len(counts))
    np.maximum.at(most, owner, times)

    def of_words(mask) -> np.ndarray:
        return _share(np.asarray(mask)[code] if len(code) else np.zeros(0, bool), doc, counts)
    length = np.asarray(pc.binary_length(words), dtype=np.int64)
    word_total = np.bincount(doc, weights=length[code] if len(code) else None, minlength=len(counts))
    packed = np.fromiter((len(t) / len(compress(t)) if t else 0 for t in raw), np.float64, len(raw))
    columns = [
        np.log1p(size), np.log1p(counts), word_total / np.maximum(counts, 1), upper, digit, without(SYMBOLS), without(b"."),
        without(b"!"), without(b"|"), without(b"\"'()[]{}@/\\=+_~^`:;?-"),
        np.fromiter((len(t) - len(t.translate(None, bytes(range(128, 256)))) for t in raw), np.int64, len(raw)) / np.maximum(size, 1),
        np.bincount(owner, minlength=len(counts)) / np.maximum(counts, 1), most / np.maximum(counts, 1),
        repeat_words(counts, code) / np.maximum(counts, 1), 1 - distinct_lines / np.maximum(n_lines, 1) * (n_lines > 0) - (n_lines == 0),
        np.log1p(counts / np.maximum(n_lines, 1)), packed, of_words(pc.match_substring_regex(words, "^[A-Z]")),
        of_words(length > 14), of_words(length <= 2), of_words(pc.match_substring_regex(words, r"[^a-zA-Z.,\x80-\x{10FFFF}]$")),
        of_words(pc.match_substring_regex(words, r"[!?.,%&$*#]{2,}")), of_words(pc.match_substring_regex(words, r"[.!?]$")),
        without(SPACES)]
    return np.stack(columns, axis=1) * (size > 0)[:, None]


def banded(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Index of the band of each value, offset per statistic (documents x STATISTICS)."""
    band = np.stack([np.searchsorted(edges[k], values[:, k], side="left") for k in range(values.shape[1])], axis=1)
    return band + np.arange(values.shape[1]) * (edges.shape[1] + 1)


def fit(good: np.ndarray, bad: np.ndarray, share_bad: float, seed: int = 11) -> Model:
    """Learns from PAIRS random (good, bad) pairs; every sampled document takes part."""
    everything = np.concatenate([good, bad])
    edges = np.quantile(everything, np.arange(1, BANDS) / BANDS, axis=0).T if len(everything) else np.zeros((len(STATISTICS), BANDS - 1))
    weights = np.zeros(len(STATISTICS) * BANDS)
    if not len(good) or not len(bad):
        return Model(edges, weights.reshape(-1, BANDS), 0.0, 1.0)
    g, b = banded(good, edges), banded(bad, edges)
    rng = np.random.default_rng(seed)
    i = np.concatenate([rng.permutation(len(g)) for _ in range(-(-PAIRS // len(g)))])[:PAIRS]
    j = np.concatenate([rng.permutation(len(b)) for _ in range(-(-PAIRS // len(b)))])[:PAIRS]
    first, second = np.zeros(len(weights)), np.zeros(len(weights))
    for step in range(1, STEPS + 1):
        score_g, score_b = weights[g].sum(axis=1), weights[b].sum(axis=1)
        push = 1 / (1 + np.exp(np.clip(score_g[i] - score_b[j], -30, 30))) / len(i)  # -d loss / d difference
        on_g, on_b = np.bincount(i, weights=push, minlength=len(g)), np.bincount(j, weights=push, minlength=len(b))
        grad = (np.bincount(b.ravel(), weights=np.repeat(on_b, b.shape[1]), minlength=len(weights))
                - np.bincount(g.ravel(), weights=np.repeat(on_g, g.shape[1]), minlength=len(weights)) + DECAY / BANDS * weights)
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        weights = weights - RATE * first / (1 - 0.9 ** step) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-7)
    score_g, score_b = weights[g].sum(axis=1), weights[b].sum(axis=1)
    # quantile of the scores as labels occur: good and bad weighted by their shares
    score = np.concatenate([score_g, score_b])
    weight = np.concatenate([np.full(len(g), (1 - share_bad) / len(g)), np.full(len(b), share_bad / len(b))])
    order = np.argsort(score, kind="stable")
    at = np.searchsorted(np.cumsum(weight[order]), share_bad)
    low, high = score[order[max(at - 1, 0)]], score[order[min(at, len(order) - 1)]]
    return Model(edges, weights.reshape(-1, BANDS), float((low + high) / 2), float(max(np.std(score_g), 1e-6)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """``labels``: doc_id and quality (0 or 1). At most about SAMPLE documents
    of each label are read, chosen by id hash."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(
        "doc_id is not null and quality in (0, 1)").distinct()
    counts = {r[0]: r[1] for r in rows.groupBy("quality").count().collect()}
    share = F.pmod(F.xxhash64("doc_id", F.lit("pairs")), F.lit(1 << 20)) / float(1 << 20)
    keep = F.when(F.col("quality") == 1, SAMPLE / max(counts.get(1, 1), 1)).otherwise(SAMPLE / max(counts.get(0, 1), 1))
    chosen = small(rows.where(share < keep), 4 * SAMPLE)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = statistics(batch.column(1))
        lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1]).cast(pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists], names=["doc_id", "quality", "x"])
    got = (id_text(docs, id_col, text_col).join(chosen, "doc_id")
           .mapInArrow(per_slice(run), "doc_id long, quality int, x array<double>").orderBy("doc_id", "quality").toArrow())
    x = np.array(got.column("x").to_pylist(), dtype=np.float64).reshape(-1, len(STATISTICS))
    y = got.column("quality").to_numpy()
    total = counts.get(0, 0) + counts.get(1, 0)
    return fit(x[y == 1], x[y == 0], counts.get(0, 0) / total if total else 0.5)


def scored(values: np.ndarray, model: Model) -> np.ndarray:
    raw = model.weights.ravel()[banded(values, model.edges)].sum(axis=1)
    z = (raw - model.threshold) / model.scale + np.log(CUT / (1 - CUT))
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``score`` (0 to 1; CUT is the threshold) of every row; a null
    text is scored as an empty one."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scored(statistics(batch.column(1)), model))], names=["doc_id", "score"])
    return id_text(docs, id_col, text_col).mapInArrow(per_slice(run), "doc_id long, score double")
