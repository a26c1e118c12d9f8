"""op2, op5, op6, op8, op10: brute force where there is one, held-out accuracy else."""

import base64
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from quarry.llm import op2_language_model, op5_quality, op6_rules, op8_language, op10_toxicity
from quarry.llm.common import crc_mod

LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SF = "/root/testdata/sf0.01"


def crc(i, m):
    return zlib.crc32(("" if i is None else str(i)).encode()) % m


@pytest.mark.parametrize("table", ["odd", "nothing", "sample"])
def test_base_scores(request, table):
    docs = request.getfixturevalue(table)
    rows = [(r["doc_id"], (r["text"] or "").encode().translate(LOW).split() + [None]) for r in docs.collect()]
    counts = Counter(w for i, ws in rows for w in ws if crc(i, 7) != 2)
    total, kinds = sum(counts.values()), len(counts)
    want = sorted((str(i), len(ws), sum(counts[w] > 0 for w in ws), total,
                   round(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in ws), 4)) for i, ws in rows)
    got = op2_language_model.score(docs, crc_mod("doc_id", 7) != 2).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_model_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    r = (op2_language_model.score(docs, crc_mod("doc_id", 7) != 2).where("not training")
         .agg((F.sum("score") / F.sum("n_tokens")).alias("m"), (F.sum("base_score") / F.sum("n_tokens")).alias("b")).first())
    assert r["m"] > r["b"] + 0.1


def test_class_softmax_is_a_distribution_and_its_gradient_is_right():
    rng = np.random.default_rng(0)
    w = rng.normal(0, 0.1, (op2_language_model.N_ROWS, op2_language_model.CLASSES))
    one, two = np.array([3, op2_language_model.BEGIN]), np.array([5, op2_language_model.BEGIN])
    log_p = op2_language_model.log_softmax(w[op2_language_model.rows_of(one, two)].sum(axis=1))
    assert np.allclose(np.exp(log_p).sum(axis=1), 1)
    k, c = op2_language_model.CLASSES, op2_language_model.CLASSES + 1
    code, n = (one * c + two) * k + np.array([7, 9]), np.array([2, 3])
    grad, loss = op2_language_model.gradient(w, code, n)
    assert math.isclose(loss, -(2 * log_p[0, 7] + 3 * log_p[1, 9]))
    for row in op2_language_model.rows_of(one, two)[0][:3]:
        step = np.zeros_like(w)
        step[row, 7] = 1e-5
        numeric = (op2_language_model.gradient(w + step, code, n)[1] - op2_language_model.gradient(w - step, code, n)[1]) / 2e-5
        assert math.isclose(grad[row, 7], numeric, rel_tol=1e-4, abs_tol=1e-6)


def base_rules(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for k in range(8)}
    n = len(words)
    return (n, sum(len(w.decode()) for w in words), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered), n < 20 or 100 * len(covered) > 30 * n)


@pytest.mark.parametrize("table", ["odd", "nothing", "sample"])
def test_rules_match_brute_force(request, table):
    docs = request.getfixturevalue(table)
    want = sorted(str((r["doc_id"], *base_rules(r["text"]))) for r in docs.collect())
    got = op6_rules.rules(docs).collect()
    assert sorted(str((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])) for r in got) == want
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_bands_reject_noise_and_repetition():
    compress = zstandard.ZstdCompressor(level=3).compress
    rng = np.random.default_rng(4)
    bands = op6_rules.Bands()
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(300)]
    prose = " ".join(words[i] for i in (rng.pareto(1.0, 1500) * 10).astype(int) % 300).encode()
    assert op6_rules.verdict(prose, compress, bands)[3]
    assert not op6_rules.verdict(rng.bytes(6000), compress, bands)[3]
    assert not op6_rules.verdict(b"the same words again " * 300, compress, bands)[3]
    half = prose[:4000] + b"again and again " * 500  # fine as a whole text of that length, not in its chunks
    assert not op6_rules.verdict(half, compress, bands)[3]
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    marks = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", np.uint8)

    def words(alphabet, size):
        text, gaps = rng.choice(alphabet, size), np.cumsum(rng.integers(3, 10, size))
        text[gaps[gaps < size]] = 32
        return text.tobytes()
    for size in (300, 450, 600, 900, 1500, 3000, 6000, 12000, 40000):
        wrapped = base64.encodebytes(rng.bytes(size))[:size]
        assert not op6_rules.verdict(wrapped, compress, bands)[3], size
        assert not op6_rules.verdict(words(marks, size), compress, bands)[3], size
        assert size < 2048 or not op6_rules.verdict(words(letters, size), compress, bands)[3], size
    assert op6_rules.verdict(b"", compress, bands)[3]


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = crc_mod("doc_id", 3) == 1
    model = op8_language.train(docs.where(~held))
    assert model.languages == ["de", "en", "es", "fr"]
    r = op8_language.identify(docs.where(held), model).join(docs.select("doc_id", "lang"), "doc_id")
    assert r.where("lang = lang_pred").count() >= 0.97 * r.where("lang is not null").count()
    assert r.where("score < 0 or score > 1").count() == 0


def test_language_of_mixtures_and_odd_texts(spark, odd, nothing):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = op8_language.train(docs)
    one = {x: docs.where(F.col("lang") == x).orderBy(F.desc("n_chars")).first()["text"][:1500] for x in ("de", "en", "fr")}
    texts = pa.array([one["de"], one["de"] + " " + one["fr"], one["en"] + " " + one["en"] + " " + one["de"]])
    share = op8_language.mixtures(model, texts)
    assert np.allclose(share.sum(axis=1), 1)
    assert share[0, 0] > 0.9 and (share[1, [0, 3]] > 0.3).all() and share[2].argmax() == 1 and share[2, 0] > 0.15
    rows = {(r["doc_id"], r["lang_pred"] == "und") for r in op8_language.identify(odd, model).collect()}
    assert {(3, True), (4, True), (5, True), (8, True), (1, False), (None, True), (None, False)} <= rows
    assert op8_language.keep_identified(odd, model).count() == odd.count() - 5
    assert op8_language.identify(nothing, model).count() == 0
    empty = op8_language.train(nothing)
    assert {r["lang_pred"] for r in op8_language.identify(odd, empty).collect()} == {"und"}


def test_quality_on_held_out_documents(spark, odd, nothing):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = crc_mod("doc_id", 5) == 0
    model = op5_quality.train(docs.where(~held), labels.where(~held))
    r = op5_quality.score(docs.where(held), model).join(labels, "doc_id").select("quality", (F.col("score") >= op5_quality.CUT).cast("int").alias("p")).toPandas()
    assert (r.quality == r.p).mean() > 0.97 and (r.p[r.quality == 0] == 0).mean() > 0.9
    scores = [x["score"] for x in op5_quality.score(odd, model).collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert op5_quality.score(nothing, model).count() == 0
    blank = op5_quality.train(nothing, labels.limit(0))
    assert op5_quality.score(odd, blank).count() == odd.count()


def test_toxicity_on_held_out_documents(spark, odd, nothing):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = crc_mod("doc_id", 5) == 0
    model = op10_toxicity.train(docs.where(~held), labels.where(~held & (F.col("toxic") == 1)), 0.1)
    r = op10_toxicity.score(docs.where(held), model).join(labels, "doc_id").select("toxic", (F.col("score") >= 0.5).cast("int").alias("p")).toPandas()
    assert (r.p[r.toxic == 1]).mean() > 0.85 and (r.p[r.toxic == 0]).mean() < 0.02
    scores = [x["score"] for x in op10_toxicity.score(odd, model).collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    none = op10_toxicity.train(nothing, labels.limit(0), 0.0)
    assert op10_toxicity.score(odd, none).count() == odd.count()


def test_nonnegative_risk_learns_from_unlabelled_positives():
    rng = np.random.default_rng(6)

    def doc(toxic):
        words = rng.integers(100, 400, 20)
        return np.unique(np.append(words, rng.integers(0, 10, 2)) if toxic else words)
    model = op10_toxicity.fit([doc(True) for _ in range(300)], [doc(rng.random() < 0.15) for _ in range(1500)], 0.15)
    score = lambda d: model.weights[d].sum() + model.bias
    assert np.mean([score(doc(True)) > 0 for _ in range(200)]) > 0.9 and np.mean([score(doc(False)) > 0 for _ in range(200)]) < 0.05
