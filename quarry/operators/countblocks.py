"""Counts of terms in documents as blocks, for models that go over them round
after round (M5-M7).

A document's rows lie in one block, the blocks of many documents in one part of
an RDD and stay there. Vectors of terms lie in slices, by term. What travels in
a round is one vector for each term of a part, to the terms' slices and back,
never the rows: a frequent term travels once a part and a word of one document
once. Parts and slices have the same number and partitioner, so the vectors that
come back meet the blocks without moving these."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import ensure_checkpoint_dir

#: Rows in a block (more if one document has more), and in a part.
BLOCK, PART = 1 << 17, 1 << 21


def corpora(counts: DataFrame, keys: list[str]) -> tuple[DataFrame, dict[int, int], int]:
    """(``(keys, __c, terms)``: the corpora by number, with their distinct
    terms; the same terms by number; rows). One row a corpus."""
    found = (counts.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
             .groupBy(*keys).agg(F.count_distinct("term").alias("terms"), F.count(F.lit(1)).alias("rows")).collect())
    schema = T.StructType([*counts.select(*keys).schema.fields, T.StructField("__c", T.IntegerType()), T.StructField("terms", T.LongType())])
    frame = counts.sparkSession.createDataFrame([(*(r[k] for k in keys), i, r["terms"]) for i, r in enumerate(found)], schema)
    return frame, {i: r["terms"] for i, r in enumerate(found)}, sum(r["rows"] for r in found)


def blocks_of(counts: DataFrame, keys: list[str], numbers: DataFrame, rows: int, x: list[Column] = ()) -> RDD:
    """``(part, (corpus, documents, starts, terms, at, n, x))``: the documents
    (None: the rows without one), where their rows start, the distinct terms,
    each row's place among them and count, and the columns ``x``, one row each."""
    sc = counts.sparkSession.sparkContext
    ensure_checkpoint_dir(counts.sparkSession)  # the models save their rounds there
    parts = max(sc.defaultParallelism, -(-rows // PART))
    flat = counts.where("term IS NOT NULL").join(F.broadcast(numbers.drop("terms")), keys).repartition(parts, "__c", "doc")
    flat = flat.sortWithinPartitions("__c", "doc", "term")  # equal sums whatever order the rows came in
    flat = flat.select("__c", "doc", "term", F.col("n").cast("double").alias("n"), *[e.alias(f"x{i}") for i, e in enumerate(x)])
    packed = flat.mapInArrow(_packed, "block binary").rdd
    return (packed.mapPartitionsWithIndex(lambda p, its: ((p, pickle.loads(r[0])) for r in its))
            .partitionBy(parts, int))


def _starts(rows: pa.Table) -> np.ndarray:
    """Where another corpus or document starts."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for name in ("__c", "doc"):
        a = rows[name].combine_chunks()
        gone = np.asarray(a.is_null())
        differ = pc.fill_null(pc.not_equal(a.slice(0, max(len(a) - 1, 0)), a.slice(1)), False)
        new[1:] |= np.asarray(differ) | (gone[1:] != gone[:-1])
    return np.flatnonzero(new)


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept, full = [], BLOCK
    for b in batches:
        kept.append(b)
        if sum(k.num_rows for k in kept) >= full:
            rows = pa.Table.from_batches(kept).combine_chunks()
            if at := int(_starts(rows)[-1]):  # the last document may go on in the next batch
                yield from _cut(rows.slice(0, at))
            kept = rows.slice(at).to_batches()
            full = max(BLOCK, 2 * (rows.num_rows - at))
    if any(k.num_rows for k in kept):
        yield from _cut(pa.Table.from_batches(kept))


def _cut(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """A block for each corpus, and one for its rows without a document."""
    starts = _starts(rows)
    docs, c = rows["doc"].combine_chunks().take(pa.array(starts)), rows["__c"].to_numpy()[starts]
    gone = np.asarray(docs.is_null())
    cuts = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (gone[1:] != gone[:-1])])
    for a, b in zip(cuts, [*cuts[1:], len(starts)]):
        low, high = starts[a], starts[b] if b < len(starts) else rows.num_rows
        part = rows.slice(low, high - low)
        terms, at = np.unique(part["term"].to_numpy(), return_inverse=True)
        x = [part[name].to_numpy() for name in part.column_names[4:]]
        block = (int(c[a]), None if gone[a] else docs.take(pa.array(np.arange(a, b))), starts[a:b] - low, terms, at.astype(np.int32),
                 part["n"].to_numpy(), np.stack(x) if x else None)
        yield pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps(block)], pa.binary())})


def per_document(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums of the rows of each document, each row's document)."""
    return np.add.reduceat(rows, starts, axis=1), np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, rows.shape[1]]))


def per_term(at: np.ndarray, rows: np.ndarray, terms: int) -> np.ndarray:
    return np.stack([np.bincount(at, weights=r, minlength=terms) for r in rows])


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(terms, vectors) added up by term, terms ascending."""
    terms, at = np.unique(np.concatenate([t for t, _ in parts]), return_inverse=True)
    return terms, per_term(at, np.concatenate([v for _, v in parts], axis=1), len(terms))


def to_slices(c: int, terms: np.ndarray, vectors: np.ndarray, slices: int, *more) -> Iterator[tuple]:
    """``(slice, (*more, corpus, terms, vectors))`` for each slice that has one of the terms."""
    of = terms % slices
    order = np.argsort(of, kind="stable")
    bounds = np.searchsorted(of[order], np.arange(slices + 1))
    for s in np.flatnonzero(np.diff(bounds)):
        at = order[bounds[s]:bounds[s + 1]]
        yield int(s), (*more, c, terms[at], vectors[:, at])


def looked_up(vectors: dict[int, list[tuple]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By corpus: all terms that came, ascending, and their vectors."""
    out = {}
    for c, parts in vectors.items():
        terms = np.concatenate([t for t, _ in parts])
        order = np.argsort(terms)
        out[c] = terms[order], np.concatenate([v for _, v in parts], axis=1)[:, order]
    return out


def places(terms: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each wanted term among ascending terms, whether it is there)."""
    at = np.minimum(np.searchsorted(terms, wanted), max(len(terms) - 1, 0))
    return at, (terms[at] == wanted) if len(terms) else np.zeros(len(wanted), bool)


def summed(parts: RDD) -> dict:
    """``(key, array)`` added up by key: a few numbers a corpus."""
    return parts.reduceByKey(lambda a, b: a + b).collectAsMap()


def rows_of(vectors: RDD, frame: DataFrame, width: int, names: list[str]) -> DataFrame:
    """``(__c, term, names)`` from ``(slice, (corpus, terms, vectors))``."""
    fields = [T.StructField("__c", T.IntegerType()), T.StructField("term", frame.schema["term"].dataType)]
    rows = vectors.flatMap(lambda m: ((m[1][0], *r) for r in zip(m[1][1].tolist(), *m[1][2][:width].tolist())))
    return frame.sparkSession.createDataFrame(rows, T.StructType([*fields, *[T.StructField(n, T.DoubleType()) for n in names]]), verifySchema=False)
