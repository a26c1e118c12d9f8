"""Hashed maximum-entropy language model.

Words fall into classes: frequent words are classes of their own, the others
share classes by their first letters. P(word | history) = P(class | history) *
P(word | class), two softmaxes. The class softmax has hashed indicator features
of the last class (bigram), the last two together (trigram) and the one before
the last (skip); it is trained by distributed full-batch gradient updates. The
word softmax has one feature per word, for which the maximum-entropy solution
is the smoothed relative frequency within the class, taken from exact counts
of the whole training corpus."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import NO_ID, codes_of, per_slice, slices, words_of, written

SLICE = 8 << 20
BUCKET_BYTES = 24 << 20
FREQUENT, SHAPES = 128, 127
#: Classes: FREQUENT words, SHAPES, the end; one more context for the begin.
CLASSES = FREQUENT + SHAPES + 1
END, BEGIN = CLASSES - 1, CLASSES
HASHED = 1 << 12
SHARDS, STEPS, RATE, PRIOR = 8, 10, 0.1, 20.0
#: Rows of the weights whose gradients go in one message.
ROWS = 256


def keyed(docs: DataFrame, training: Column, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("version"),
                       training.alias("training"), text.alias("text"))


def hashed_words(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(np.asarray(words.to_pylist(), dtype=object), categorize=False) if len(words) else np.zeros(0, np.uint64)


# -- counts -------------------------------------------------------------------

BLOBS = "bucket long, part long, n int, docs int, words binary, postings binary, head binary"


def sent_words(buckets: int):
    """mapInArrow over keyed rows: per slice and bucket its distinct words with
    their documents; one head row per slice lists the documents."""
    schema = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("n", pa.int32()), ("docs", pa.int32()),
                        ("words", pa.binary()), ("postings", pa.binary()), ("head", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        part = TaskContext.get().partitionId() << 24
        for batch in batches:
            for s in slices(batch, "text", SLICE):
                part += 1
                counts, flat = words_of(s.column(3), lower=True)
                codes, words = codes_of(flat)
                doc = np.repeat(np.arange(s.num_rows), counts)
                pair, n = np.unique(codes * s.num_rows + doc, return_counts=True)  # by word, then document
                word, doc = pair // s.num_rows, pair % s.num_rows
                bucket = (hashed_words(words) % np.uint64(buckets)).astype(np.int64)
                training = np.asarray(pc.fill_null(s.column(2), False).cast(pa.uint8()))
                known = np.asarray(pc.is_valid(s.column(0)).cast(pa.uint8()))
                ids = np.asarray(pc.fill_null(s.column(0), NO_ID), dtype=np.int64)
                head = squeeze(b"".join(x.tobytes() for x in (ids, np.asarray(s.column(1), dtype=np.int64), counts, training, known)))
                rows = [(part % buckets, part, 0, s.num_rows, None, None, head)]
                flags = np.packbits(training).tobytes()
                text = words.cast(pa.binary())
                order = np.argsort(bucket[word], kind="stable") if len(word) else np.zeros(0, np.int64)
                bounds = np.flatnonzero(np.diff(bucket[word][order], prepend=-1)) if len(word) else []
                for a, b in zip(bounds, [*bounds[1:], len(order)]):
                    o = order[a:b]
                    first = np.flatnonzero(np.diff(word[o], prepend=-1))
                    body = np.concatenate([np.diff(first, append=len(o)), doc[o], n[o]]).astype(np.uint32)
                    rows.append((int(bucket[word[o[0]]]), part, len(first), s.num_rows,
                                 squeeze(b"\n".join(text.take(pa.array(word[o][first])).to_pylist())), squeeze(flags + body.tobytes()), None))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return run


COUNTED = "kind string, part long, word string, n long, total long, body binary"


def counted(table: pa.Table) -> pa.Table:
    """applyInArrow over a bucket: exact training counts of its words. Rows:
    ``word`` (the most frequent ones), ``shape`` (tokens and words per shape),
    ``docs`` (per slice: known tokens and sum of log10(count + 1) per document),
    ``head`` (passed on)."""
    out: list[tuple] = []
    asked = []
    for part, n, docs, words, postings, head in zip(*(table.column(c).to_pylist() for c in ("part", "n", "docs", "words", "postings", "head"))):
        if head is not None:
            out.append(("head", part, None, docs, 0, head))
            continue
        raw = zstandard.decompress(postings)
        flags = -(-docs // 8)
        training = np.unpackbits(np.frombuffer(raw, np.uint8, flags))[:docs].astype(bool)
        body = np.frombuffer(raw[flags:], np.uint32)
        per_word, rest = body[:n], body[n:]
        asked.append((part, zstandard.decompress(words).split(b"\n"), per_word, rest[:len(rest) // 2], rest[len(rest) // 2:], training))
    if asked:
        code, distinct = pd.factorize(np.array([w for a in asked for w in a[1]], dtype=object))
        total = np.zeros(len(distinct), np.int64)
        at, mine = 0, []
        for part, words, per_word, doc, n, training in asked:
            word = np.repeat(code[at:at + len(words)], per_word)
            at += len(words)
            np.add.at(total, word, n * training[doc])
            mine.append((part, word, doc.astype(np.int64), n.astype(np.int64)))
        for part, word, doc, n in mine:
            c = total[word]
            log = np.bincount(doc, weights=n * np.log10(c + 1.0))
            known = np.bincount(doc, weights=n * (c > 0)).astype(np.uint32)
            has = np.flatnonzero(np.bincount(doc))
            out.append(("docs", part, None, len(has), 0, zstandard.compress(has.astype(np.uint32).tobytes() + known[has].tobytes() + log[has].tobytes())))
        shape = shapes(pa.array(distinct.tolist(), pa.binary()).cast(pa.string()))
        tokens, kinds = np.bincount(shape, weights=total, minlength=SHAPES), np.bincount(shape, weights=total > 0, minlength=SHAPES)
        out += [("shape", k, None, int(kinds[k]), int(tokens[k]), None) for k in range(SHAPES) if tokens[k]]
        edge = np.partition(total, -min(FREQUENT, len(total)))[-min(FREQUENT, len(total))]
        top = sorted((-int(total[i]), distinct[i]) for i in np.flatnonzero(total >= max(edge, 1)))[:FREQUENT]
        out += [("word", 0, w.decode(), -n, 0, None) for n, w in top]
    schema = pa.schema([("kind", pa.string()), ("part", pa.int64()), ("word", pa.string()), ("n", pa.int64()), ("total", pa.int64()), ("body", pa.binary())])
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)


def per_document(table: pa.Table) -> pa.Table:
    """applyInArrow over the rows of a slice: documents with their sums."""
    docs, head = 0, b""
    for kind, n, body in zip(*(table.column(c).to_pylist() for c in ("kind", "n", "body"))):
        if kind == "head":
            docs, head = n, zstandard.decompress(body)
    known, log = np.zeros(docs, np.int64), np.zeros(docs)
    for kind, n, body in sorted(zip(*(table.column(c).to_pylist() for c in ("kind", "n", "body")))):  # one order of adding
        if kind == "docs":
            raw = zstandard.decompress(body)
            at = np.frombuffer(raw, np.uint32, n)
            known[at] += np.frombuffer(raw, np.uint32, n, 4 * n)
            log[at] += np.frombuffer(raw, np.float64, n, 8 * n)
    ids, version, tokens = (np.frombuffer(head, np.int64, docs, 8 * docs * k) for k in range(3))
    training, valid = (np.frombuffer(head, np.uint8, docs, 24 * docs + docs * k).astype(bool) for k in range(2))
    return pa.table({"doc_id": pa.array(ids, mask=~valid), "version": version, "training": training, "n_words": tokens, "n_known": known, "log_counts": log})


# -- classes ------------------------------------------------------------------

def shapes(words: pa.Array) -> np.ndarray:
    """Shape of each word: its first two characters, hashed."""
    begin = pc.utf8_slice_codeunits(words, 0, 2).dictionary_encode()
    return (hashed_words(begin.dictionary) % np.uint64(SHAPES)).astype(np.int64)[np.asarray(begin.indices, dtype=np.int64)] if len(words) else np.zeros(0, np.int64)


@dataclass
class Classes:
    frequent: list[str]

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, class, class before, class before that) of every token,
        the end of each text included."""
        counts, flat = words_of(texts, lower=True)
        codes, words = codes_of(flat)
        known = np.asarray(pc.fill_null(pc.index_in(words, pa.array(self.frequent, pa.string())), -1), dtype=np.int64)
        by_word = np.where(known >= 0, known, FREQUENT + shapes(words))
        size = counts + 1
        ends = np.cumsum(size) - 1
        token = np.full(int(size.sum()), END, np.int64)
        inner = np.ones(len(token), bool)
        inner[ends] = False
        token[inner] = by_word[codes] if len(codes) else []
        doc = np.repeat(np.arange(len(size)), size)
        first = ends - size + 1
        one = np.concatenate(([BEGIN], token[:-1]))
        one[first] = BEGIN
        two = np.concatenate(([BEGIN], one[:-1]))
        two[first] = BEGIN
        return doc, token, one, two


# -- class model --------------------------------------------------------------

def rows_of(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The hashed features of a history as rows of the weights: bias, bigram,
    skip, trigram."""
    pair = (one * 1_000_003 + two * 8_191 + 12_289) * 2_654_435_761 % (1 << 32) >> 20
    base = 1 + 2 * (CLASSES + 1)
    return np.stack([np.zeros_like(one), 1 + one, 2 + CLASSES + two, base + pair % HASHED], axis=1)


N_ROWS = 1 + 2 * (CLASSES + 1) + HASHED


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def gradient(weights: np.ndarray, code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient of the summed log loss over counted (history, class) events."""
    history, at = np.unique(code // CLASSES, return_inverse=True)
    features = rows_of(history // (CLASSES + 1), history % (CLASSES + 1))
    grad, loss = np.zeros_like(weights, dtype=np.float64), 0.0
    order = np.argsort(at, kind="stable")
    at, klass, n = at[order], (code % CLASSES)[order], n[order]
    for a in range(0, len(history), 2048):
        lo, hi = np.searchsorted(at, (a, a + 2048))
        f = features[a:a + 2048]
        seen = np.zeros((len(f), CLASSES))
        seen[at[lo:hi] - a, klass[lo:hi]] = n[lo:hi]
        log_p = log_softmax(weights[f].sum(axis=1))
        loss -= (seen * log_p).sum()
        residual = np.exp(log_p) * seen.sum(axis=1, keepdims=True) - seen
        for k in range(f.shape[1]):
            np.add.at(grad, f[:, k], residual)
    return grad, loss


def started(seen: np.ndarray) -> np.ndarray:
    """Weights to start from, given summed class pairs (last or before last x
    context x class): class frequencies, and what each context says about them,
    as if the two were independent."""
    total = seen[0].sum(axis=0) + 1.0
    total /= total.sum()
    weights = np.zeros((N_ROWS, CLASSES), np.float32)
    weights[0] = np.log(total)
    for base, pair, share in ((1, seen[0], 0.8), (2 + CLASSES, seen[1], 0.6)):
        pair = pair + PRIOR * total
        weights[base:base + CLASSES + 1] = share * np.log(pair / pair.sum(axis=1, keepdims=True) / total)
    return weights


def train_classes(rows: DataFrame, classes: Classes) -> np.ndarray:
    """Class weights from all training rows (column text). Their events are
    counted once (at most (CLASSES + 1)^2 * CLASSES rows); every step then sums
    shard gradients, a matrix of fixed size each, into one update."""
    def events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch, "text", 4 << 20):
                _, token, one, two = classes.of(s.column(0))
                code, n = np.unique((one * (CLASSES + 1) + two) * CLASSES + token, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["code", "n"])
    # by the last class: a shard then meets few rows of the weights
    shard = F.pmod(F.floor(F.col("code") / (CLASSES * (CLASSES + 1))), F.lit(SHARDS))

    def blob(table: pa.Table) -> pa.Table:
        code, n = (np.asarray(table.column(c).combine_chunks(), dtype=np.int64) for c in ("code", "n"))
        o = np.argsort(code)
        return pa.table({"events": pa.array([zstandard.compress(code[o].tobytes() + n[o].tobytes())], pa.binary())})
    shards = written(rows.select("text").mapInArrow(events, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
                     .select(shard.alias("shard"), "code", "n").groupBy("shard").applyInArrow(blob, "events binary").repartition(SHARDS))

    def unpack(data: bytes) -> np.ndarray:
        return np.frombuffer(zstandard.decompress(data), np.int64).reshape(2, -1)

    def summed(fn, shape: tuple[int, int], kind=np.float32) -> np.ndarray:
        """Sum over the shards of matrices ``fn(code, n)``. A task sends the rows
        that are not zero, a block at a time, each row as its greatest value and
        shares of it."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            for b in batches:
                for data in b.column(0).to_pylist():
                    part = fn(*unpack(data))
                    held = part if held is None else held + part
            if held is not None:
                at = np.flatnonzero(held.any(axis=1))
                for i in range(0, len(at), ROWS):
                    some = held[at[i:i + ROWS]]
                    most = np.abs(some).max(axis=1)
                    body = [at[i:i + ROWS].astype(np.int32).tobytes(), most.tobytes(), zstandard.compress((some / most[:, None]).astype(kind).tobytes())]
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in body], names=["at", "most", "v"])
        total = np.zeros(shape)
        for r in shards.mapInArrow(run, "at binary, most binary, v binary").collect():
            at = np.frombuffer(r["at"], np.int32)
            total[at] += np.frombuffer(zstandard.decompress(r["v"]), kind).reshape(len(at), -1) * np.frombuffer(r["most"], np.float64)[:, None]
        return total

    # first estimates need class pairs only: (last, class) and (before last, class)
    def pairs(code, n):
        klass, one, two = code % CLASSES, code // CLASSES // (CLASSES + 1), code // CLASSES % (CLASSES + 1)
        size = (CLASSES + 1) * CLASSES
        return np.concatenate([np.bincount(c * CLASSES + klass, weights=n, minlength=size) for c in (one, two)]).reshape(-1, CLASSES)
    seen = summed(pairs, (2 * (CLASSES + 1), CLASSES)).reshape(2, CLASSES + 1, CLASSES)
    weights = started(seen)
    total, memory = max(seen[0].sum(), 1.0), np.zeros(weights.shape)
    for _ in range(STEPS):
        grad = summed(lambda code, n, w=weights: gradient(w, code, n)[0], weights.shape, np.float16) / total
        memory += grad * grad
        weights = (weights - RATE * grad / (np.sqrt(memory) + 1e-9)).astype(np.float32)
    return weights


# -- the operator -------------------------------------------------------------

def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ``training``, ``n_tokens`` (words and one end),
    ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score``
    (add-one unigram) and ``score``, both log10 probabilities of the text.
    ``training`` says which rows to learn from (null: not). A null text is
    empty: its end alone is scored. Repeated rows count as often as they occur."""
    rows = keyed(docs, training, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-int(size) // BUCKET_BYTES))
    counts = written(rows.mapInArrow(sent_words(buckets), BLOBS).groupBy("bucket").applyInArrow(counted, COUNTED))
    frequent = [(r["word"], r["n"]) for r in counts.where("kind = 'word'").orderBy(F.desc("n"), "word").limit(FREQUENT).collect()]
    kinds, tokens = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.where("kind = 'shape'").groupBy("part").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():  # SHAPES rows
        kinds[FREQUENT + r["part"]], tokens[FREQUENT + r["part"]] = r["n"], r["total"]
    own = shapes(pa.array([w for w, _ in frequent], pa.string()))
    for k, (_, n) in enumerate(frequent):  # a frequent word leaves its shape
        kinds[k], tokens[k] = 1, n
        kinds[FREQUENT + own[k]] -= 1
        tokens[FREQUENT + own[k]] -= n
    sums = written(counts.where("kind in ('docs', 'head')").groupBy("part").applyInArrow(
        per_document, "doc_id long, version long, training boolean, n_words long, n_known long, log_counts double"))
    ends = sums.where("training").count()
    kinds[END], tokens[END] = int(ends > 0), ends
    n_train, n_kinds = int(tokens.sum()), int(kinds.sum())
    classes = Classes([w for w, _ in frequent])
    weights = train_classes(rows.where("training"), classes)
    within = np.log10(tokens + kinds + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norm = np.full((CLASSES + 1) ** 2, np.nan)  # log normalisers of the histories met so far

        def one_slice(s: pa.RecordBatch) -> pa.RecordBatch:
            doc, token, one, two = classes.of(s.column(2))
            history = one * (CLASSES + 1) + two
            new = np.unique(history[np.isnan(norm[history])])
            for a in range(0, len(new), 2048):
                h = new[a:a + 2048]
                z = weights[rows_of(h // (CLASSES + 1), h % (CLASSES + 1))].sum(axis=1)
                top = z.max(axis=1)
                norm[h] = top + np.log(np.exp(z - top[:, None]).sum(axis=1))
            log_p = weights[rows_of(one, two), token[:, None]].sum(axis=1, dtype=np.float64) - norm[history]
            total = np.bincount(doc, weights=log_p / np.log(10) - within[token], minlength=s.num_rows)
            return pa.RecordBatch.from_arrays([s.column(0), s.column(1), s.column(3), pa.array(total)], names=["doc_id", "version", "training", "classes"])
        yield from per_slice(one_slice)(batches)
    by_class = rows.select("doc_id", "version", "text", "training").mapInArrow(run, "doc_id long, version long, training boolean, classes double")
    once = sums.groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.col("version").alias("_version")).agg(
        F.max("n_words").alias("n_words"), F.max("n_known").alias("n_known"), F.max("log_counts").alias("log_counts"))
    known = F.col("log_counts") + float(np.log10(ends + 1))
    n_tokens = F.col("n_words") + 1
    return (by_class.withColumn("_id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("_version", F.col("version"))
            .join(once, ["_id", "_version"])
            .select("doc_id", F.coalesce("training", F.lit(False)).alias("training"), n_tokens.alias("n_tokens"),
                    (F.col("n_known") + int(ends > 0)).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
                    (known - n_tokens * float(np.log10(n_train + n_kinds + 1))).alias("base_score"), (known + F.col("classes")).alias("score")))
