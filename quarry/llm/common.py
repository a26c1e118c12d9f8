"""Helpers shared by the operators of this folder.

Text reaches Python in Arrow batches. ``per_slice`` cuts every batch into
slices of bounded text size (one document is never cut), so that numpy
temporaries stay small whatever the batch or document sizes are."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir, table

#: Rank given to a document without an id: after every real id.
NO_ID = (1 << 63) - 1
SLICE_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two input columns, under fixed names: other columns of the
    caller, whatever they are called, never meet the operator's own."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def text_version(text_col: str):
    """Hash of the text: tells rows with the same id and different texts apart."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def per_slice(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
              size_col: str = "text", max_bytes: int = SLICE_BYTES):
    """A mapInArrow function that applies ``fn`` to slices of at most
    ``max_bytes`` of ``size_col`` (a longer single row is a slice of its own)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, size_col, max_bytes):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out
    return run


def slices(batch: pa.RecordBatch, size_col: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(size_col))), 0)
    ends = np.cumsum(np.asarray(size, dtype=np.int64))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def words_of(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text: (number of words of each
    text, all words in order). A null text has none."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    flat = lists.flatten()
    counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    empty = np.asarray(pc.equal(pc.binary_length(flat), 0))
    if empty.any():
        owner = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(owner[~empty], minlength=len(counts)).astype(np.int64)
        flat = flat.filter(pa.array(~empty))
    return counts, flat


def codes_of(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Dense integer code of every word and the dictionary of distinct words."""
    d = flat.dictionary_encode()
    if isinstance(d, pa.ChunkedArray):
        d = d.combine_chunks()
    return np.asarray(d.indices, dtype=np.int64), d.dictionary


def same_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names for pairs of names (Karp-Miller-Rosenberg): equal pairs get the
    same dense integer. Exact; no hashing of contents."""
    import pandas as pd
    if len(left) == 0:
        return np.zeros(0, np.int64)
    return pd.factorize(left * (int(right.max()) + 1) + right)[0].astype(np.int64)


def gram_names(codes: np.ndarray, n: int) -> np.ndarray:
    """Name of the n-gram that starts at each position (positions whose n-gram
    would run over the end of ``codes`` are left out)."""
    width, names = 1, codes
    parts = None
    at = 0
    rest = n
    while rest:
        if rest & 1:
            if parts is None:
                parts, at = names, width
            else:
                m = min(len(parts), len(names) - at)
                if m <= 0:
                    return np.zeros(0, np.int64)
                parts, at = same_names(parts[:m], names[at:at + m]), at + width
        rest >>= 1
        if rest:
            m = len(names) - width
            if m <= 0:
                return np.zeros(0, np.int64)
            names, width = same_names(names[:m], names[width:]), 2 * width
    return parts


def covered(starts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Boolean mask of the positions inside any run [s, s + length)."""
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + length, total), -1)
    return np.cumsum(edge[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal true runs of a mask."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder the session names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def crc_mod(column, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (a null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def written(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared checkpoint folder: cuts
    lineage, and later plans know its real size."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """With a broadcast hint if the frame has at most ``rows`` rows, as counted
    now; larger frames are left to the shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
