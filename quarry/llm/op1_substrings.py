"""Substring dedup by prefix-partitioned suffix trees.

Every position has the hash of a variable-length prefix of its suffix: the
shortest run of words that holds ``PREFIX_BYTES`` bytes, at most
``PREFIX_WORDS`` words, so common short words make longer prefixes. Suffixes
that start with one prefix are one group. A suffix is not shipped for each of
its words: of the suffixes inside a window of ``window`` words, the one with the
smallest hash places the window, so equal windows always meet and neighbouring
ones travel together (see ``segments``). A group that is too large is split by
the longest prefix of use, the whole window. A group's suffix tree (see
``suffix_tree``) has the repeats as its inner nodes of ``window`` words or more:
a suffix loses as many words as its deepest such node with a leaf of a smaller
document has."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import codes_of, words_of
from quarry.llm.segments import Method, Units, applied, mixed, unit_mask, with_spans
from quarry.llm.suffix_tree import leaves, shared_with_smaller

WINDOW = 13
PREFIX_WORDS = 5
PREFIX_BYTES = 16


def word_units(texts: pa.Array) -> Units:
    counts, flat = words_of(texts)
    codes, distinct = codes_of(flat)
    if not len(codes):
        return Units(counts, np.zeros(0, np.uint64))
    hashes = pd.util.hash_array(np.asarray(distinct.to_pylist(), dtype=object), categorize=False)[codes]
    size = np.asarray(pc.binary_length(flat), dtype=np.int64)
    prefix, held = mixed(hashes), size.copy()
    for k in range(1, PREFIX_WORDS):  # the prefix of a word near the end of the slice is shorter; no window starts there
        more = held[:len(held) - k] < PREFIX_BYTES
        prefix[:len(held) - k] = np.where(more, mixed(prefix[:len(held) - k] * np.uint64(31) + hashes[k:]), prefix[:len(held) - k])
        held[:len(held) - k] += np.where(more, size[k:], PREFIX_BYTES)
    return Units(counts, prefix, size + 1)


def word_groups(texts: list[bytes], windows: np.ndarray) -> np.ndarray:
    if not texts:
        return np.zeros(0, np.uint64)
    u = word_units(pa.array(texts, pa.binary()).cast(pa.string()))
    begin = np.cumsum(u.counts) - u.counts
    return np.minimum.reduceat(u.prefix_hash, np.stack([begin, begin + u.counts - PREFIX_WORDS + 1], axis=1).ravel())[::2]


def cut_words(text: str, starts: list[int], ends: list[int]) -> list[bytes]:
    words = text.encode().split()
    return [b" ".join(words[a:b]) + b"\n" for a, b in zip(starts, ends)]


def smaller_has_window(texts: list[bytes], windows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Mask over all windows of the segments: a smaller document has the window.
    The suffixes are those that begin a window; a deep node of d words marks the
    windows inside its words."""
    counts, flat = words_of(pa.array(texts, pa.binary()).cast(pa.string()))
    total = int(windows.sum())
    at = np.repeat(np.cumsum(counts) - counts - (np.cumsum(windows) - windows), windows) + np.arange(total)
    order, common = leaves(codes_of(flat)[0], counts, at)
    deep = np.zeros(total, np.int64)
    deep[order] = shared_with_smaller(np.repeat(ids, windows)[order], common, WINDOW)
    hit = np.flatnonzero(deep)
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + deep[hit] - WINDOW + 1, -1)
    return np.cumsum(edge[:-1]) > 0


WORDS = Method(WINDOW, PREFIX_WORDS, word_units, cut_words, word_groups, smaller_has_window, most_windows=32)


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every input row as struct ``row`` plus ``kept`` (the words left, joined by
    one space), ``n_words`` and ``n_removed``. A word goes if a 13-word window
    over it also starts in a document with a smaller id. A null text has no
    words. Rows without an id come after all others: they lose words, and take
    none from each other. Rows with the same id never take from each other."""
    def keep(text: bytes, spans: np.ndarray | None) -> tuple[str, int, int]:
        words = text.split()
        if spans is None:
            return b" ".join(words).decode(), len(words), 0
        gone = unit_mask(spans, len(words))
        return b" ".join([w for w, g in zip(words, gone.tolist()) if not g]).decode(), len(words), int(gone.sum())

    return applied(with_spans(docs, WORDS, id_col, text_col), text_col, keep,
                   [("kept", "string", pa.string()), ("n_words", "long", pa.int64()), ("n_removed", "long", pa.int64())])


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The rows with ``text_col`` replaced by the words left (a null text stays
    null) and ``length_col``, if there is one, by its length; other columns
    unchanged. A text of which nothing is left stays as an empty one."""
    done = remove_repeated(docs, id_col, text_col)
    row = F.col("row")
    columns = []
    for f in docs.schema.fields:
        if f.name == text_col:
            value = F.when(row[text_col].isNotNull(), F.col("kept"))
        elif f.name == length_col:
            value = F.when(row[text_col].isNotNull(), F.length("kept")).otherwise(row[f.name]).cast(f.dataType)
        else:
            value = row[f.name]
        columns.append(value.alias(f.name))
    return done.select(*columns)
