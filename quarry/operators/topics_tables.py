"""Topic models as tables (M5-M8): the vocabulary and the topic weights are keyed
frames; the rounds go over blocks of counts (``countblocks``). What reaches the
driver are matrices of topics x topics. Several corpora (one per value of
``keys``, at least one column) are fitted side by side."""

from __future__ import annotations

import pickle
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.countblocks import (added, blocks_of, corpora, looked_up, per_document, per_term, places, rows_of, summed,
                                          to_slices)
from quarry.operators.ranks import with_rank
from quarry.operators.topics import vocab_pruned
from quarry.session import written

#: Rounds between reliable checkpoints.
SAVED = 5


def _total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _like(n: int, name: str) -> list[str]:
    return [f"{name}{i}" for i in range(n)]


def counts_with_ids(occurrences: DataFrame, keys: list[str], doc: str, token: str, no_below: int = 1, no_above: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(vocabulary ``(keys, token, term)``, counts ``(keys, doc, term, n)``) of
    the tokens in at least ``no_below`` documents and at most the share
    ``no_above`` of them; term ids are ranks over the whole vocabulary."""
    tokens = occurrences.groupBy(*keys, F.col(doc).alias("doc"), F.col(token).alias("token")).agg(F.count(F.lit(1)).alias("n"))
    tokens = written(tokens)
    kept = vocab_pruned(tokens, keys, "doc", no_below, no_above).select(*keys, "token")
    vocabulary = written(with_rank(kept, *keys, "token", name="term"))
    return vocabulary, written(tokens.join(vocabulary, [*keys, "token"]).select(*keys, "doc", "term", "n"))


# ---------------------------------------------------------------- LSA


def _orthonormal(gram: np.ndarray) -> np.ndarray:
    """The matrix that makes vectors of this Gram matrix orthonormal; directions
    that they do not have become zero."""
    values, vectors = np.linalg.eigh(gram)
    keep = values > max(values[-1], 0.0) * 1e-14
    return vectors @ np.diag(np.where(keep, 1.0 / np.sqrt(np.where(keep, values, 1.0)), 0.0))


def truncated_svd(counts: DataFrame, keys: list[str], k: int = 5, extra: int = 8, rounds: int = 25, tolerance: float = 1e-8) -> tuple[DataFrame, DataFrame]:
    """M5: the ``k`` greatest singular values ``(keys, topic, value)`` and right
    singular vectors ``(keys, topic, term, weight)`` of the document-term
    counts, by block power iteration: vectors over the terms are carried to the
    documents and back by joins and sums, and made orthonormal by their Gram
    matrix, until no value moves by more than ``tolerance`` of the greatest, or for
    ``rounds`` rounds. A matrix
    of lower rank has fewer topics."""
    width = k + extra
    cols = _like(width, "v")
    numbers, _, rows = corpora(counts, keys)
    blocks = blocks_of(counts, keys, numbers, rows).persist(StorageLevel.MEMORY_AND_DISK)
    parts = blocks.getNumPartitions()

    def asked(p, its):  # the terms that a part will ask for; rows without a document count for the values
        kept: dict[int, list] = {}
        for _, (c, _, _, terms, *_) in its:
            kept.setdefault(c, []).append(terms)
        for c, found in kept.items():
            terms = np.unique(np.concatenate(found))
            for s, (_, _, t, _) in to_slices(c, terms, terms[None, :], parts, p):
                yield s, (c, t, p)
    routes = blocks.mapPartitionsWithIndex(asked).partitionBy(parts, int).persist(StorageLevel.MEMORY_AND_DISK)

    def started(batches):
        for b in batches:
            c, terms, drawn = b.column(0).to_numpy(), b.column(1).to_numpy(), np.stack([x.to_numpy() for x in b.columns[2:]])
            for one in np.unique(c):
                yield pa.RecordBatch.from_pydict({"vectors": pa.array([pickle.dumps((int(one), terms[c == one], drawn[:, c == one]))], pa.binary())})

    def met(its):  # vectors of a slice's terms by corpus; sums without terms go on as they are
        kept: dict[int, list] = {}
        for s, (p, c, terms, x) in its:
            if terms is None:
                yield s, (c, None, x)
            else:
                kept.setdefault(c, []).append((p, s, terms, x))
        for c, found in kept.items():
            found.sort(key=lambda m: m[0])
            yield found[0][1], (c, *added([m[2:] for m in found]))

    def products(its):
        for _, (c, terms, x) in its:
            yield ((c, 0), x) if terms is None else ((c, 1), x @ x.T)  # 0: of the documents, 1: of the terms

    def sent(by):
        def run(its):  # first the vectors of the slice, then who asks for them
            kept: dict[int, tuple] = {}
            for _, (c, terms, x) in its:
                if terms is None:
                    continue
                if not isinstance(x, int):
                    kept[c] = terms, by[c].T @ x
                elif c in kept:
                    at, there = places(kept[c][0], terms)
                    yield x, (c, terms[there], kept[c][1][:, at[there]])
        return run

    def multiplied(p, its):  # first the vectors of the part's terms, then its blocks
        vectors: dict[int, list] = {}
        ready, back, inner = None, {}, {}
        for _, (c, *m) in its:
            if len(m) == 2:
                vectors.setdefault(c, []).append(tuple(m))
                continue
            ready = looked_up(vectors) if ready is None else ready
            if c not in ready:
                continue
            docs, starts, terms, at, n, _ = m
            place, there = places(ready[c][0], terms)
            y, of = per_document(starts, n * (ready[c][1][:, place] * there)[:, at])
            inner[c] = inner.get(c, 0.0) + y @ y.T
            if docs is not None:
                back.setdefault(c, []).append((terms, per_term(at, n * y[:, of], len(terms))))
        for c, found in back.items():
            yield from to_slices(c, *added(found), parts, p)
        for c, m in inner.items():
            yield p, (p, c, None, m)
    start = counts.where("term IS NOT NULL").join(F.broadcast(numbers), keys).select("__c", "term").distinct()
    drawn = start.select("__c", "term", *[(F.pmod(F.xxhash64("term", F.lit(i)), F.lit(1 << 20)) / float(1 << 20) - 0.5).alias(c) for i, c in enumerate(cols)])
    vectors = (drawn.mapInArrow(started, "vectors binary").rdd.flatMap(lambda r: to_slices(*(m := pickle.loads(r[0])), parts, int(m[1][0])))
               .partitionBy(parts, int).mapPartitions(met, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK))
    by = {c: _orthonormal(m) for (c, _), m in summed(vectors.mapPartitions(products)).items()}
    before: dict[int, np.ndarray] = {}
    inner: dict[int, np.ndarray] = {}
    for i in range(rounds):
        come = vectors.union(routes).mapPartitions(sent(by)).partitionBy(parts, int)
        new = (come.union(blocks).mapPartitionsWithIndex(multiplied).partitionBy(parts, int)
               .mapPartitions(met, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK))
        if i % SAVED == SAVED - 1:
            new.checkpoint()
        found = summed(new.mapPartitions(products))
        inner = {c: m for (c, kind), m in found.items() if kind == 0}
        values = {c: np.sqrt(np.maximum(np.linalg.eigvalsh(m)[::-1][:k], 0)) for c, m in inner.items()}
        if before.keys() == values.keys() and all(np.abs(values[c] - before[c]).max() <= tolerance * values[c].max() for c in values):
            break
        before = values
        vectors.unpersist()
        vectors, by = new, {c: _orthonormal(m) for (c, kind), m in found.items() if kind == 1}
    turned = {c: by[c] @ np.linalg.eigh(m)[1][:, ::-1] for c, m in inner.items() if c in by}
    final = vectors.filter(lambda m: m[1][1] is not None and m[1][0] in turned).mapValues(lambda m: (m[0], m[1], turned[m[0]].T @ m[2]))
    final = written(rows_of(final, counts, k, cols[:k])).join(F.broadcast(numbers.drop("terms")), "__c")
    for kept in (blocks, routes, vectors, new):
        kept.unpersist()
    found = [(c, j, float(s)) for c, values in before.items() for j, s in enumerate(values) if s > 1e-7 * values.max()]  # roots of sums: exact to about 1e-8
    singular = counts.sparkSession.createDataFrame(found, "__c int, topic int, value double").join(F.broadcast(numbers), "__c").select(*keys, "topic", "value")
    stacked = F.array(*[F.struct(F.lit(i).alias("topic"), F.col(cols[i]).alias("weight")) for i in range(k)])
    long = final.select(*keys, "term", F.explode(stacked).alias("s")).select(*keys, "s.topic", "term", "s.weight")
    return singular, long.join(F.broadcast(singular.drop("value")), [*keys, "topic"])


def top_terms(weights: DataFrame, vocabulary: DataFrame, keys: list[str], n: int = 8, signed: bool = False) -> DataFrame:
    """``(keys, topic, rank, token, weight)``: the ``n`` terms of greatest
    (absolute) weight in each topic, ties by token; ``signed``: the greatest is
    made positive."""
    named = weights.join(vocabulary, [*keys, "term"])
    order = Window.partitionBy(*keys, "topic").orderBy(F.abs("weight").desc(), "token")
    top = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    if signed:
        first = F.first("weight").over(Window.partitionBy(*keys, "topic").orderBy("rank"))
        top = top.withColumn("weight", F.col("weight") * F.when(first < 0, -1.0).otherwise(1.0))
    return top.select(*keys, "topic", "rank", "token", "weight")


# ---------------------------------------------------------------- LDA


def lda(counts: DataFrame, keys: list[str], k: int, rounds: int = 15, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """M6 / M7: latent Dirichlet allocation with priors 1 / k, by collapsed
    variational updates: every (document, term) row has its share of each topic,
    renewed from the sums over its document, its term and the topic, without its
    own part. Returns topic-term weights ``(keys, topic, term, weight)`` and
    document mixtures ``(keys, doc, topic, weight)``; both sum to 1 over the
    terms of a topic and the topics of a document."""
    d, t = _like(k, "d"), _like(k, "t")
    prior = 1.0 / k
    numbers, size, rows = corpora(counts, keys)
    raw = [F.pmod(F.xxhash64(*keys, "doc", "term", F.lit(seed), F.lit(i)), F.lit(1 << 20)).cast("int") for i in range(k)]
    blocks = blocks_of(counts, keys, numbers, rows, raw)
    parts = blocks.getNumPartitions()

    def shared(new):
        return new / reduce(np.add, new)

    def sums(p, its):  # a part's sums over each of its terms
        kept: dict[int, list] = {}
        for _, (c, _, _, terms, at, n, g) in its:
            kept.setdefault(c, []).append((terms, per_term(at, n * g, len(terms))))
        for c, found in kept.items():
            yield from to_slices(c, *added(found), parts, p)

    def met(s, its):  # sums over a slice's terms: back to the parts that have them, and over all terms
        kept: dict[int, list] = {}
        for _, (p, c, terms, x) in its:
            kept.setdefault(c, []).append((p, terms, x))
        for c, found in kept.items():
            found.sort(key=lambda m: m[0])
            terms, x = added([m[1:] for m in found])
            yield s, (c, None, x.sum(axis=1))
            for p, some, _ in found:
                yield p, (c, some, x[:, places(terms, some)[0]])

    def renewed(topics):
        def run(its):  # first the sums of the part's terms, then its blocks
            came: dict[int, list] = {}
            ready = None
            for p, (c, *m) in its:
                if len(m) == 2:
                    if m[0] is not None:
                        came.setdefault(c, []).append(tuple(m))
                    continue
                ready = looked_up(came) if ready is None else ready
                docs, starts, terms, at, n, g = m
                if docs is None:  # rows without a document count in the first sums only
                    continue
                own = n * g
                of_docs, of = per_document(starts, own)
                of_terms = ready[c][1][:, places(ready[c][0], terms)[0]]
                new = (np.maximum(of_docs[:, of] - own + prior, 1e-12) * np.maximum(of_terms[:, at] - own + prior, 1e-12)
                       / np.maximum(topics[c][:, None] - own + prior * size[c], 1e-12))
                yield p, (c, docs, starts, terms, at, n, shared(new))
        return run

    def in_documents(its):
        for _, (c, docs, starts, _, _, n, g) in its:
            yield from zip([c] * len(starts), [None] if docs is None else docs.to_pylist(), *per_document(starts, n * g)[0].tolist())
    state = blocks.mapValues(lambda m: (*m[:-1], shared(m[-1] / float(1 << 20) + 0.1))).persist(StorageLevel.MEMORY_AND_DISK)
    for i in range(rounds):
        come = state.mapPartitionsWithIndex(sums).partitionBy(parts, int).mapPartitionsWithIndex(met).partitionBy(parts, int)
        topics = summed(come.filter(lambda m: m[1][1] is None).map(lambda m: (m[1][0], m[1][2])))
        if i:
            before.unpersist()  # the state has been made from it
        before, state = state, come.union(state).mapPartitions(renewed(topics), preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
        if i % SAVED == SAVED - 1 and i + 1 < rounds:
            state.checkpoint()

    def whole_sums(s, its):
        kept: dict[int, list] = {}
        for _, (p, c, terms, x) in its:
            kept.setdefault(c, []).append((p, terms, x))
        for c, found in kept.items():
            found.sort(key=lambda m: m[0])
            yield s, (c, *added([m[1:] for m in found]))
    last = state.mapPartitionsWithIndex(sums).partitionBy(parts, int).mapPartitionsWithIndex(whole_sums)
    terms = written(rows_of(last, counts, k, t)).join(F.broadcast(numbers), "__c")
    if rounds:
        before.unpersist()  # the last state stays for the mixtures

    def shares(frame, by, names, over):
        stacked = F.array(*[F.struct(F.lit(i).alias("topic"), F.col(c).alias("w")) for i, c in enumerate(names)])
        return frame.select(*by, *over, F.explode(stacked).alias("x")).select(*by, *over, "x.topic", "x.w")
    terms = shares(terms, [*keys, "term"], t, ["terms"])
    whole = terms.groupBy(*keys, "topic").agg((F.sum("w") + prior * F.first("terms")).alias("whole"))
    topic_terms = terms.join(F.broadcast(whole), [*keys, "topic"]).select(*keys, "topic", "term", ((F.col("w") + prior) / F.col("whole")).alias("weight"))
    schema = T.StructType([T.StructField("__c", T.IntegerType()), counts.schema["doc"], *[T.StructField(c, T.DoubleType()) for c in d]])
    docs = counts.sparkSession.createDataFrame(state.mapPartitions(in_documents), schema, verifySchema=False).join(F.broadcast(numbers), "__c")
    total = _total([F.col(c) for c in d]) + 1.0  # k priors of 1 / k
    mixtures = shares(docs.select(*keys, "doc", *[((F.col(c) + prior) / total).alias(c) for c in d]), [*keys, "doc"], d, [])
    return topic_terms, mixtures.withColumnRenamed("w", "weight")


# ---------------------------------------------------------------- coherence

#: Fixed values of the published measure: words in a window, and what is added to a joint share.
WINDOW, EPSILON = 110, 1e-12


def window_counts(tokens: DataFrame, keys: list[str], doc: str, words: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(windows ``(keys, windows)``, ``(keys, w1, w2, both)``): how many sliding
    windows of ``window`` tokens there are, and how many hold both words, for
    all ordered pairs of the listed ``words`` ``(keys, token)``, a word with
    itself too. ``tokens``: ``(keys, doc, toks array)``; a document of fewer
    tokens is one window. A word's windows in a document are a few runs of
    starts; runs are cut into blocks of the window's length, where each word has
    two pieces at most, and pieces of one block are compared."""
    n = F.size("toks")
    starts = F.greatest(n - window, F.lit(0)) + 1
    size = tokens.where(n > 0).groupBy(*keys).agg(F.sum(starts).cast("long").alias("windows"))
    placed = (tokens.select(*keys, F.col(doc).alias("doc"), n.alias("len"), F.posexplode_outer("toks").alias("at", "token")).where("token IS NOT NULL")
              .join(F.broadcast(words.select(*keys, "token").distinct()), [*keys, "token"]))
    last = F.greatest(F.col("len") - window, F.lit(0))
    runs = placed.select(*keys, "doc", "token", F.greatest(F.col("at") - window + 1, F.lit(0)).alias("low"), F.least(F.col("at"), last).alias("high"))
    order = Window.partitionBy(*keys, "doc", "token").orderBy("low", "high")
    reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("new", F.coalesce((F.col("low") > reach + 1).cast("int"), F.lit(1)))
    runs = runs.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy(*keys, "doc", "token", "run").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    pieces = runs.select(*keys, "doc", "token", "low", "high", F.explode(F.expr(f"sequence(low div {window}, high div {window})")).alias("block"))
    pieces = written(pieces.select(*keys, "doc", "block", "token", F.greatest("low", F.col("block") * window).alias("low"),
                                   F.least("high", (F.col("block") + 1) * window - 1).alias("high")))
    a, b = (pieces.select(*keys, "doc", "block", F.col("token").alias(f"w{i}"), F.col("low").alias(f"l{i}"), F.col("high").alias(f"h{i}")) for i in (1, 2))
    shared = F.least("h1", "h2") - F.greatest("l1", "l2") + 1
    return size, a.join(b, [*keys, "doc", "block"]).where(shared > 0).groupBy(*keys, "w1", "w2").agg(F.sum(shared).cast("long").alias("both"))


def coherence(tokens: DataFrame, keys: list[str], doc: str, topics: DataFrame, window: int = WINDOW) -> DataFrame:
    """M8: ``(keys, topic, coherence)`` of topics given by their top words
    ``(keys, topic, token)``: every word's vector of normalised pointwise mutual
    information with all words of the topic, pairs that share no window
    included, its cosine with the sum of those vectors, and the mean of the
    cosines (the c_v measure)."""
    size, both = window_counts(tokens, keys, doc, topics, window)
    # words of a topic with each other: bounded by the top words
    pairs = topics.select(*keys, "topic", F.col("token").alias("w1")).join(topics.select(*keys, "topic", F.col("token").alias("w2")), [*keys, "topic"])
    alone = both.where("w1 = w2").select(*keys, F.col("w1").alias("w"), F.col("both").alias("n"))
    full = (pairs.join(both, [*keys, "w1", "w2"], "left").join(alone.select(*keys, F.col("w").alias("w1"), F.col("n").alias("n1")), [*keys, "w1"], "left")
            .join(alone.select(*keys, F.col("w").alias("w2"), F.col("n").alias("n2")), [*keys, "w2"], "left"))
    full = full.join(F.broadcast(size), keys)
    joint = F.coalesce("both", F.lit(0)) / F.col("windows") + EPSILON
    npmi = F.ln(joint / (F.col("n1") / F.col("windows") * (F.col("n2") / F.col("windows")))) / -F.ln(joint)
    vectors = written(full.where("n1 > 0 AND n2 > 0").select(*keys, "topic", "w1", "w2", npmi.alias("x")))
    whole = vectors.groupBy(*keys, "topic", "w2").agg(F.sum("x").alias("y"))
    each = vectors.join(whole, [*keys, "topic", "w2"]).groupBy(*keys, "topic", "w1").agg(
        (F.sum(F.col("x") * F.col("y")) / F.sqrt(F.sum(F.col("x") * F.col("x")) * F.sum(F.col("y") * F.col("y")))).alias("cosine"))
    return each.groupBy(*keys, "topic").agg(F.avg("cosine").alias("coherence"))
