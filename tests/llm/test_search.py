"""op12: against scoring every document for every item."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.llm import op12_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def by_brute_force(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    out = Counter()
    for item, text in set(items):
        asked = Counter(terms(text))
        found = []
        for (i, c), n in zip(counted, sizes):
            m = 75 + (25 * n * n_docs) // max(total, 1)
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t, q in asked.items() if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0))
        for rank, (score, null, i) in enumerate(sorted(found)[:k], 1):
            out[(item, rank, None if null else i, -score)] += 1
    return out


def both(spark, docs, items, k=20):
    got = op12_search.search(docs, items, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert Counter(map(tuple, got.collect())) == by_brute_force(rows, [(r["item_id"], r["text"]) for r in items.collect()], k)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string, rank string, score string")


ITEMS = [(1, "one two Three three fourteen"), (2, "lorem ipsum; LOREM"), (3, None), (4, ""), (5, "漢字 ünïcode ÜNÏCODE"), (None, "sixteen x"),
         (6, "no such words here"), (7, "another text under the same id 12345"), (7, "another text under the same id 12345"), (8, "x, y!")]


@pytest.mark.parametrize("table", ["odd", "nothing"])
def test_odd_tables(request, spark, table):
    both(spark, request.getfixturevalue(table), items_of(spark, [(*r, "a", "b", "c") for r in ITEMS]))
    both(spark, request.getfixturevalue(table), items_of(spark, []))


def test_whole_small_table(spark, sample):
    both(spark, sample, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))


def test_blocks_chunks_and_waves(spark, sample, monkeypatch):
    """Several passes, several chunks in a task, ties at the last rank."""
    monkeypatch.setattr(op12_search, "BLOCK_BYTES", 2000)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = sample.unionByName(sample.withColumn("doc_id", F.col("doc_id") + 100000)).repartition(2)
    both(spark, docs, items, k=3)


def test_order_of_visits_prunes():
    """Strata below the k-th score are not visited, and results stay whole."""
    import numpy as np
    rng = np.random.default_rng(7)
    asked = op12_search.Questions(["a b c", "d d a"])
    asked.weigh(400, {t: int(10 + t) for t in range(4)})
    docs = 400
    m = rng.integers(75, 600, docs)
    doc, term = np.nonzero(rng.random((docs, 4)) < 0.5)
    tf = rng.integers(1, 9, len(doc))
    strata = op12_search.Strata(np.arange(docs), m, doc, term, tf, asked)
    visited = []
    visit = strata.visit
    strata.visit = lambda s, *a: visited.append(len(s)) or visit(s, *a)
    best = op12_search.Best(2, 5)
    best.take(strata, asked)
    assert sum(visited) < 2 * strata.count
    for item, q in enumerate([{0: 1, 1: 1, 2: 1}, {3: 2, 0: 1}]):
        score = np.zeros(docs, np.int64)
        for d, t, f in zip(doc, term, tf):
            place = {"a": 0, "b": 1, "c": 2, "d": 3}[asked.vocabulary[int(t)].as_py()]
            score[d] += q.get(place, 0) * asked.weights[t] * ((10 ** 9 * f) // (1000 * f + 12 * m[d]))
        want = sorted(((-s, d) for d, s in enumerate(score) if s > 0))[:5]
        assert [(-s, d) for s, d in zip(best.scores[item], best.docs[item])] == want
