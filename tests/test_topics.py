"""Topic models on tables: against numpy, on planted topics, and the coherence from its definition."""

import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.operators import countblocks as CB
from quarry.operators import topics as TP
from quarry.operators import topics_tables as TT


@pytest.fixture(scope="module")
def corpus(spark):
    """Two corpora; in each, documents draw from one of two vocabularies."""
    r = random.Random(8)
    rows = []
    for g in ("x", "y"):
        for d in range(40):
            words = [f"{g}{'ab'[d % 2]}{i}" for i in range(6)]
            rows += [(g, d, w) for w in r.choices(words, k=30)] + [(g, d, "everywhere")]
    return spark.createDataFrame(rows, "g string, doc long, token string").repartition(4)


def matrix(counts):
    docs, terms = sorted({r["doc"] for r in counts}), sorted({r["term"] for r in counts})
    m = np.zeros((len(docs), len(terms)))
    for r in counts:
        m[docs.index(r["doc"]), terms.index(r["term"])] = r["n"]
    return m, terms


def test_svd_equals_numpy(corpus):
    vocabulary, counts = TT.counts_with_ids(corpus, ["g"], "doc", "token", 2, 0.8)
    assert sorted(r["term"] for r in vocabulary.collect()) == list(range(24))  # "everywhere" is in too many documents
    values, vectors = TT.truncated_svd(counts, ["g"], 3)
    for g in ("x", "y"):
        m, terms = matrix([r for r in counts.collect() if r["g"] == g])
        s = sorted((r["topic"], r["value"]) for r in values.collect() if r["g"] == g)
        assert np.allclose([v for _, v in s], np.linalg.svd(m, compute_uv=False)[:3], rtol=1e-7)
        v = np.zeros((len(terms), 3))
        for r in vectors.collect():
            if r["g"] == g:
                v[terms.index(r["term"]), r["topic"]] = r["weight"]
        assert np.allclose(v.T @ v, np.eye(3), atol=1e-7)
        assert np.allclose(np.linalg.norm(m @ v, axis=0), [x for _, x in s], rtol=1e-6)
    top = TT.top_terms(vectors, vocabulary, ["g"], 4, signed=True).collect()
    assert len(top) == 2 * 3 * 4 and all(r["weight"] > 0 for r in top if r["rank"] == 1)


def test_svd_of_low_rank(spark):
    occ = spark.createDataFrame([("g", d, w) for d in range(4) for w in ("p", "q")], "g string, doc long, token string")
    vocabulary, counts = TT.counts_with_ids(occ, ["g"], "doc", "token")
    values, vectors = TT.truncated_svd(counts, ["g"], 5)
    assert [r["value"] for r in values.collect()] == pytest.approx([math.sqrt(8)]) and vectors.count() == 2


def test_lda_finds_planted_topics(corpus):
    vocabulary, counts = TT.counts_with_ids(corpus, ["g"], "doc", "token", 2, 0.8)
    weights, mixtures = TT.lda(counts, ["g"], 2, 30, 1)
    sums = defaultdict(float)
    for r in weights.collect():
        sums[r["g"], r["topic"]] += r["weight"]
    assert len(sums) == 4 and all(v == pytest.approx(1) for v in sums.values())
    for g in ("x", "y"):
        found = {}
        for r in TT.top_terms(weights.where(f"g = '{g}'"), vocabulary, ["g"], 6).collect():
            found.setdefault(r["topic"], set()).add(r["token"])
        assert sorted(map(sorted, found.values())) == [[f"{g}{v}{i}" for i in range(6)] for v in "ab"]
    per, most = defaultdict(float), defaultdict(dict)
    for r in mixtures.collect():
        per[r["g"], r["doc"]] += r["weight"]
        most[r["g"], r["doc"]][r["topic"]] = r["weight"]
    assert len(per) == 80 and all(v == pytest.approx(1) for v in per.values())
    assert all(max(m.values()) > 0.9 for m in most.values())


def by_definition(docs, words, window):
    spans = [set(d[i:i + window]) for d in docs if d for i in range(max(len(d) - window, 0) + 1)]
    p = lambda *w: sum(all(x in s for x in w) for s in spans) / len(spans)
    npmi = lambda a, b: math.log((p(a, b) + TT.EPSILON) / (p(a) * p(b))) / -math.log(p(a, b) + TT.EPSILON)
    v = np.array([[npmi(a, b) for b in words] for a in words])
    return np.mean([x @ v.sum(axis=0) / np.linalg.norm(x) / np.linalg.norm(v.sum(axis=0)) for x in v])


def test_coherence(spark):
    r = random.Random(2)
    docs = [r.choices("abcdefghijkl", [9, 5, 4, 3, 2, 2, 1, 1, 1, 1, 1, 1], k=r.choice([0, 3, 8, 9, 40, 100])) for _ in range(25)] + [["z"] * 30, ["a", "z"]]
    tokens = spark.createDataFrame([("g", i, d) for i, d in enumerate(docs)], "g string, doc long, toks array<string>").repartition(3)
    topics = {0: "abc", 1: "adkz", 2: "fghz"}
    top = spark.createDataFrame([("g", t, w) for t, ws in topics.items() for w in ws], "g string, topic int, token string")
    got = {r["topic"]: r["coherence"] for r in TT.coherence(tokens, ["g"], "doc", top, window=8).collect()}
    assert got == {t: pytest.approx(by_definition(docs, list(ws), 8)) for t, ws in topics.items()}


def test_tfidf_analyses_texts_once_and_joins_group_sizes_by_broadcast(spark):
    docs = spark.createDataFrame([("g", 1, "apple pear apple"), ("g", 2, "pear plum"), ("h", 3, "plum")], "g string, doc long, text string")
    top = TP.tfidf_top(docs, ["g"], "doc", "text", [], 1, 5)
    plan = top._jdf.queryExecution().toString()
    assert "regexp_extract_all" not in plan  # terms and document numbers come from one analysis
    physical = plan[plan.index("== Physical Plan =="):]
    assert "BroadcastHashJoin [g#" in physical
    assert {(r["g"], r["term"]) for r in top.collect()} == {("g", "apple"), ("g", "pear"), ("g", "plum"), ("h", "plum")}


@pytest.fixture
def odd_counts(spark):
    """Counts with a document of no id, a repeated row, a row without a corpus, and a term of the nameless document only."""
    r = random.Random(5)
    rows = [("g", d, t, r.randint(1, 4)) for d in range(30) for t in r.sample(range(40), 9)]
    rows += [("g", None, 3, 2), ("g", None, 99, 1), rows[0], (None, 1, 2, 5)] + [("h", d, 100 + t, 1 + t % 3) for d in range(6) for t in range(d, d + 4)]
    return spark.createDataFrame(rows, "g string, doc long, term long, n long").repartition(3)


@pytest.fixture
def tables(monkeypatch):
    """The tables that the operators write."""
    made = []
    monkeypatch.setattr(TT, "written", lambda df, real=TT.written: made.append(df.columns) or real(df))
    return made


def plain_lda(rows, k, rounds):
    """The updates row by row: (document, term, count, shares)."""
    rows = [(d, t, n, [x / sum(g) for x in g]) for d, t, n, g in rows]
    size = len({t for _, t, _, _ in rows})
    for i in range(rounds):
        docs, terms, whole = defaultdict(lambda: [0.0] * k), defaultdict(lambda: [0.0] * k), [0.0] * k
        for d, t, n, g in rows:
            for j in range(k):
                docs[d][j] += n * g[j]
                terms[t][j] += n * g[j]
                whole[j] += n * g[j]
        new = []
        for d, t, n, g in rows:
            if d is None:
                continue
            w = [max(docs[d][j] - n * g[j] + 1 / k, 1e-12) * max(terms[t][j] - n * g[j] + 1 / k, 1e-12) / max(whole[j] - n * g[j] + size / k, 1e-12) for j in range(k)]
            new.append((d, t, n, [x / sum(w) for x in w]))
        rows = new
    sums = defaultdict(float)
    for _, t, n, g in rows:
        for j in range(k):
            sums[j, t] += n * g[j]
    whole = [sum(v for (j, _), v in sums.items() if j == i) + size / k for i in range(k)]
    return {(j, t): (v + 1 / k) / whole[j] for (j, t), v in sums.items()}


@pytest.mark.parametrize("k", [2, 5])  # lda_topics, lda_topics_legacy
def test_lda_equals_plain_updates_and_writes_no_round(odd_counts, tables, monkeypatch, k):
    monkeypatch.setattr(CB, "PART", 20)  # documents of one corpus in many parts
    weights, mixtures = TT.lda(odd_counts, ["g"], k, 7, 42)
    got = {(r["g"], r["topic"], r["term"]): r["weight"] for r in weights.collect()}
    assert len(tables) <= 1  # neither the rows nor their terms are written in a round
    drawn = [(F.pmod(F.xxhash64("g", "doc", "term", F.lit(42), F.lit(i)), F.lit(1 << 20)) / float(1 << 20) + 0.1) for i in range(k)]
    rows = odd_counts.select("g", "doc", "term", "n", F.array(*drawn).alias("x")).collect()
    want = {(g, *at): w for g in "gh" for at, w in plain_lda([(r["doc"], r["term"], r["n"], r["x"]) for r in rows if r["g"] == g], k, 7).items()}
    assert got == {at: pytest.approx(w, rel=1e-9) for at, w in want.items()}
    assert ("g", 0, 3) in got and ("g", 0, 99) not in got
    assert {(r["g"], r["doc"]) for r in mixtures.collect()} == {*(("g", d) for d in range(30)), *(("h", d) for d in range(6))}


def test_svd_of_many_parts_writes_no_round(odd_counts, tables, monkeypatch):
    monkeypatch.setattr(CB, "PART", 20)
    values, vectors = TT.truncated_svd(odd_counts.where("doc IS NOT NULL"), ["g"], 2)
    got = {(r["g"], r["topic"]): r["value"] for r in values.collect()}
    assert vectors.where("topic = 0 AND g = 'g'").count() == 40 and len(tables) <= 1
    rows = odd_counts.where("doc IS NOT NULL").collect()
    for g in "gh":
        m = np.zeros((30, 120))
        for r in rows:
            if r["g"] == g:
                m[r["doc"], r["term"]] += r["n"]
        assert [got[g, i] for i in range(2)] == pytest.approx(np.linalg.svd(m, compute_uv=False)[:2], rel=1e-6)


def test_blocks_hold_whole_documents(monkeypatch):
    monkeypatch.setattr(CB, "BLOCK", 4)
    docs = [None, None, 1, 1, 1, 1, 1, 1, 2, 3, 3, 3, 4]
    rows = pa.table({"__c": pa.array([0] * 12 + [1], pa.int32()), "doc": docs, "term": [*range(13)], "n": [1.0] * 13, "x0": [2.0] * 13})
    blocks = [CB.pickle.loads(b["block"][0].as_py()) for b in CB._packed(rows.to_batches(max_chunksize=3))]
    assert [(c, d and d.to_pylist()) for c, d, *_ in blocks] in ([(0, None), (0, [1]), (0, [2, 3]), (1, [4])], [(0, None), (0, [1, 2]), (0, [3]), (1, [4])],
                                                                [(0, None), (0, [1]), (0, [2]), (0, [3]), (1, [4])], [(0, None), (0, [1, 2, 3]), (1, [4])])
    assert [t for _, _, _, terms, at, _, _ in blocks for t in terms[at]] == [*range(13)] and all(b[2][0] == 0 for b in blocks)
