"""Ranked lexical search on a length-stratified index.

The length normaliser m of a score is a whole number, so documents fall into
strata of equal m. The index has, for each stratum and term, the postings by
falling tf: inside a stratum a term's impact depends on tf alone, is computed
once for each tf, and the first posting bounds all others. The sum of those
firsts over an item's terms bounds the stratum; strata are visited in the order
of their bounds until the bound is below the item's k-th score.

Documents are read once for each block of items. Only terms that the block asks
for get postings; lengths are counted over all terms of all documents. No key of
a shuffle is a term, so a term in every document makes no heavy task."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import NO_ID, codes_of, id_text, slices, words_of, written

#: Item text that one pass over the documents may hold; a longer item is a block of its own.
BLOCK_BYTES = 4 << 20
#: Postings that a task indexes at a time.
CHUNK = 2_000_000
SLICE = 2 << 20


def _letters() -> np.ndarray:
    """Byte to byte: letters and digits of ASCII in lower case, bytes of other
    characters as they are, everything else a space."""
    out = np.arange(256, dtype=np.uint8)
    for b in range(0x80):
        c = chr(b)
        out[b] = ord(c.lower()) if c.isalnum() else 0x20
    return out


LETTERS = _letters()


def terms_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(terms of each text, all terms in order); a null text has none."""
    texts = pc.fill_null(texts, "")
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    found = LETTERS[np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]] if data is not None else np.zeros(0, np.uint8)
    return words_of(pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends - ends[0]), pa.py_buffer(found)))


def index(docs: DataFrame, vocabulary: pa.Array, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, ``n`` (all its terms) and, for the terms of the
    vocabulary that it holds, their places there (``terms``) and ``tfs``."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])
    width = max(len(vocabulary), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                counts, flat = terms_of(part.column(1))
                codes, distinct = codes_of(flat)
                place = np.asarray(pc.fill_null(pc.index_in(distinct, value_set=vocabulary), -1), dtype=np.int64)[codes]
                doc = np.repeat(np.arange(len(counts)), counts)[place >= 0]
                held, tf = np.unique(doc * width + place[place >= 0], return_counts=True)
                ends = pa.array(np.append(0, np.cumsum(np.bincount(held // width, minlength=len(counts)))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts), pa.ListArray.from_arrays(ends, pa.array((held % width).astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32)))], schema=schema)
    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


class Questions:
    """The items of a block as rows of (term, how often), terms as places in one vocabulary."""

    def __init__(self, texts: list[str | None]):
        counts, flat = terms_of(pa.array(texts, pa.string()))
        codes, self.vocabulary = codes_of(flat)
        self.width = max(len(self.vocabulary), 1)
        item = np.repeat(np.arange(len(counts)), counts)
        pairs, self.times = np.unique(item * self.width + codes, return_counts=True)
        self.item, self.term = pairs // self.width, pairs % self.width
        self.ends = np.searchsorted(self.item, np.arange(len(texts) + 1))
        self.items = len(texts)
        by_term = np.argsort(self.term, kind="stable")
        self.by_term, self.term_ends = by_term, np.searchsorted(self.term[by_term], np.arange(self.width + 1))
        self.weights = np.zeros(self.width, np.int64)

    def weigh(self, n_docs: int, frequencies: dict[int, int]) -> None:
        for term, df in frequencies.items():
            self.weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class Strata:
    """A chunk of documents as a length-stratified index."""

    def __init__(self, doc_ids: np.ndarray, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, asked: Questions):
        self.doc_ids, self.width = doc_ids, asked.width
        levels, stratum = np.unique(m, return_inverse=True)
        self.count = len(levels)
        key = stratum[doc] * self.width + term
        order = np.lexsort((-tf, key))
        key, tf, self.doc = key[order], tf[order].astype(np.int64), doc[order]
        at = key // self.width
        # one impact for every tf of a stratum
        most = int(tf.max(initial=0)) + 1
        pair, of = np.unique(at * most + tf, return_inverse=True)
        tfs, ms = pair % most, levels[pair // most]
        self.impact = asked.weights[key % self.width] * ((1_000_000_000 * tfs) // (1000 * tfs + 12 * ms))[of]
        self.keys, self.first = np.unique(key, return_index=True)
        self.sizes = np.diff(np.append(self.first, len(key)))
        self.scores = np.zeros(len(doc_ids), np.int64)

    def bounds(self, asked: Questions) -> np.ndarray:
        """Items x strata: no document of the stratum scores higher."""
        out = np.zeros(asked.items * self.count, np.int64)
        term = self.keys % self.width
        many = np.diff(asked.term_ends)[term]
        who = asked.by_term[spans(asked.term_ends[term], many)]
        np.add.at(out, asked.item[who] * self.count + np.repeat(self.keys // self.width, many),
                  asked.times[who] * np.repeat(self.impact[self.first], many))
        return out.reshape(asked.items, self.count)

    def visit(self, strata: np.ndarray, terms: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all documents in the strata that hold a term."""
        key = (strata[:, None] * self.width + terms).ravel()
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        held = np.flatnonzero(self.keys[at] == key)
        at = at[held]
        where = spans(self.first[at], self.sizes[at])
        docs = self.doc[where]
        np.add.at(self.scores, docs, self.impact[where] * np.repeat(times[held % len(terms)], self.sizes[at]))
        docs = np.unique(docs)
        found = self.scores[docs]
        self.scores[docs] = 0
        return docs, found


class Best:
    """The k best documents of every item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.docs = [np.zeros(0, np.int64)] * items
        self.scores = [np.zeros(0, np.int64)] * items

    def least(self, item: int) -> int:
        """Scores below this cannot enter (equal ones can, by their id)."""
        return int(self.scores[item][-1]) if len(self.scores[item]) == self.k else 1

    def add(self, item: int, docs: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least(item)
        docs, scores = np.append(self.docs[item], docs[good]), np.append(self.scores[item], scores[good])
        order = np.lexsort((docs, -scores))[:self.k]
        self.docs[item], self.scores[item] = docs[order], scores[order]

    def take(self, strata: Strata, asked: Questions) -> None:
        bounds = strata.bounds(asked)
        for item in range(asked.items):
            a, b = asked.ends[item], asked.ends[item + 1]
            terms, times = asked.term[a:b], asked.times[a:b]
            order = np.argsort(-bounds[item], kind="stable")
            bound = bounds[item][order]
            at, wave = 0, 4
            while at < len(order) and bound[at] >= self.least(item):
                end = min(at + wave, int(np.searchsorted(-bound, -self.least(item), side="right")))
                docs, scores = strata.visit(order[at:end], terms, times)
                self.add(item, strata.doc_ids[docs], scores)
                at, wave = end, 2 * wave


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += len(batch.column(2).flatten())
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def rank_block(indexed: DataFrame, asked: Questions, k: int) -> DataFrame:
    """The k best documents of every item: (item, doc_id, score), item by place."""
    totals = indexed.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    frequencies = indexed.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    asked.weigh(totals["docs"], {r["term"]: r["df"] for r in frequencies.collect()})  # one row a term of the block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(asked.items, k)
        for held in _chunks(batches):
            ids, m, lists, tfs = (pa.concat_arrays([b.column(i) for b in held]) for i in range(4))
            doc = np.repeat(np.arange(len(ids)), np.asarray(pc.list_value_length(lists), dtype=np.int64))
            best.take(Strata(np.asarray(pc.fill_null(ids, NO_ID)), np.asarray(m), doc, np.asarray(lists.flatten(), dtype=np.int64),
                             np.asarray(tfs.flatten()), asked), asked)
        item = np.repeat(np.arange(asked.items), [len(d) for d in best.docs])
        docs = np.concatenate([*best.docs, np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(docs, pa.int64(), mask=docs == NO_ID),
                                          pa.array(np.concatenate([*best.scores, np.zeros(0, np.int64)]))], names=["item", "doc_id", "score"])
    m = F.expr(f"75 + (25 * n * {totals['docs']}L) div {max(totals['terms'] or 0, 1)}L")
    stratified = indexed.where(F.size("terms") > 0).select("doc_id", m.alias("m"), "terms", "tfs")
    # neighbouring strata share a task, and a stratum of many documents is dealt to several
    dealt = stratified.repartitionByRange("m", F.xxhash64("doc_id"))
    found = dealt.mapInArrow(run, "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Rows (item_id, rank, doc_id, score): for each item its k documents of the
    highest scores above 0, equal scores by ascending id, a null id last. Each
    row of ``docs`` is a document, repeated ones too; equal rows of ``items``
    are one item. Null or empty texts have no terms: such an item has no rows,
    such a document is in none and does not count. Empty tables give no rows."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where("text is not null").distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    kind = asked.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind)])
    out = spark.createDataFrame([], T.StructType([schema["item_id"], T.StructField("rank", T.IntegerType()),
                                                  T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()  # about BLOCK_BYTES
        block = Questions([r["text"] for r in rows])
        ranked = rank_block(written(index(docs, block.vocabulary, id_col, text_col)), block, k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], schema)
        found = ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = found if blocks == 1 else out.unionByName(found)
    return out
