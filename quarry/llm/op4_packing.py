"""Best-fit packing by exact-complement hashing.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens.
How many pieces have each length is a table of at most ``capacity`` rows,
whatever the corpus size, so the packing itself is planned on lengths: single,
pair and triple sums of available lengths that exactly fill the gap of a
length are consumed in multiples under their availability counts, the rest is
filled best-fit. The plan says which ranks of a length go to which sequences;
ranks are dealt by salted windows, so a length held by a third of all pieces
does not meet in one task."""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed, codes_of, id_text, slices, words_of

CAPACITY = 4096
END_ID = 1
SALTS = 256
#: Distinct words whose ids a worker keeps between slices.
CACHE_WORDS = 200_000
#: A run of these after a plain letter is split off by the tokenizer itself, so
#: word and marks can be encoded, and cached, apart.
MARKS, PLAIN_END = ".,!?", "[a-zß-öø-ÿ]$"
PLAIN = re.compile("[a-zß-öø-ÿ]+")


class WordEncoder:
    """Ids of white-space separated words with a tokenizer that never joins
    across white space; the ids of a text are those of its words in order.
    Words are encoded once per Python worker while the cache holds them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread; threads of its own would also split its heap
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # a word of plain lower-case letters is unchanged by the normaliser and not split
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.ids = [np.zeros(0, np.uint32)]
        self.sizes: list[np.ndarray] = [np.zeros(1, np.int64)]

    def add(self, words: list[str]) -> None:
        """Encodes words that are not known yet."""
        plain = [w for w in words if PLAIN.fullmatch(w)]
        for at in range(0, len(plain), 4096):
            some = plain[at:at + 4096]
            for e in self.plain.encode_batch_fast([some[i:i + 64] for i in range(0, len(some), 64)],
                                                  is_pretokenized=True, add_special_tokens=False):
                ids = np.asarray(e.ids, dtype=np.uint32)
                self.ids.append(ids)
                self.sizes.append(np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1))
        other = [w for w in words if not PLAIN.fullmatch(w)]
        for at in range(0, len(other), 64):
            some = other[at:at + 64]
            e = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            self.ids.append(np.asarray(e.ids, dtype=np.uint32))
            self.sizes.append(np.bincount(np.asarray(e.word_ids, dtype=np.int64), minlength=len(some)))
        self.known.update(zip(plain + other, range(len(self.known), len(self.known) + len(words))))

    def encode(self, flat: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all ids in order)."""
        special = pc.match_substring(flat, "<|")  # the strings of special tokens are matched before lower-casing
        lower = pc.ascii_lower(flat)
        codes, distinct = codes_of(pc.if_else(special, flat, lower) if pc.any(special).as_py() else lower)
        stem = pc.utf8_rtrim(distinct, MARKS)
        plain = pc.match_substring_regex(stem, PLAIN_END)
        tail = pc.extract_regex(distinct, f"(?P<marks>[{MARKS}]*)$").field(0)
        stem_code, stems = codes_of(pc.if_else(plain, stem, distinct))
        tail_code, tails = codes_of(pc.if_else(plain, tail, ""))
        stems, tails = stems.to_pylist(), tails.to_pylist()
        if len(self.known) > CACHE_WORDS:
            self.clear()
        self.add([w for w in dict.fromkeys(stems + tails) if w not in self.known])
        pool, sizes = np.concatenate(self.ids), np.concatenate(self.sizes)
        self.ids, self.sizes = [pool], [sizes]
        starts = np.cumsum(sizes) - sizes
        known = self.known
        first = np.fromiter((known[w] for w in stems), np.int64, len(stems))[stem_code]
        second = np.fromiter((known[w] for w in tails), np.int64, len(tails))[tail_code]
        parts = np.stack([first[codes], second[codes]], axis=1)
        return sizes[parts].sum(axis=1), pool[spread(starts, sizes, parts.ravel())]


def spread(starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Indices starts[w] .. starts[w] + sizes[w] of every w in ``which``, in order."""
    n = sizes[which]
    before = np.cumsum(n) - n
    return np.repeat(starts[which] - before, n) + np.arange(int(n.sum()))


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> WordEncoder:
    """One encoder per Python worker: Spark reuses workers for many tasks."""
    return WordEncoder(path)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of every row; a null or empty text is the end id alone."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_path)
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                counts, flat = words_of(part.column(1))
                sizes, ids = encoder.encode(flat)
                ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum(counts)] if len(counts) else []
                out, begin = [], 0
                for doc_id, end in zip(part.column(0).to_pylist(), ends):
                    own = np.append(ids[begin:end], np.uint32(END_ID)).astype("<u4")
                    begin = end
                    for k, start in enumerate(range(0, len(own), capacity)):
                        piece = own[start:start + capacity]
                        out.append((doc_id, k, start, len(piece), zlib.crc32(piece.tobytes())))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    return id_text(docs, id_col, text_col).mapInArrow(run, PIECES)


def exact_fill(gap: int, left: np.ndarray) -> list[int] | None:
    """Up to three available lengths whose sum is ``gap``: the single of that
    sum, else the pair, else the triple, with the longest first."""
    if gap <= 0:
        return None
    if left[gap] > 0:
        return [gap]

    def pair(total: int, most: int) -> list[int] | None:
        low = (total + 1) // 2
        top = min(total - 1, most)
        if low > top:
            return None
        longer = left[low:top + 1]
        shorter = left[total - top:total - low + 1][::-1]
        fits = (longer > 0) & (shorter > 0)
        if 2 * low == total and left[low] < 2:
            fits[0] = False
        at = np.flatnonzero(fits)
        return [low + int(at[-1]), total - low - int(at[-1])] if len(at) else None

    if found := pair(gap, gap):
        return found
    lengths = np.flatnonzero(left[:max(gap - 1, 0)] > 0)
    for a in lengths[lengths * 3 >= gap][::-1].tolist():
        left[a] -= 1
        found = pair(gap - a, a)
        left[a] += 1
        if found:
            return [a, *found]
    return None


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, Counter]]:
    """[(how many sequences, pieces of each length in one such sequence)].
    ``counts[l]`` pieces of length l; every piece is used exactly once."""
    left = counts.astype(np.int64).copy()
    made: list[tuple[int, Counter]] = []

    def use(lengths: list[int]) -> None:
        need = Counter(lengths)
        times = min(int(left[n]) // m for n, m in need.items())
        for n, m in need.items():
            left[n] -= times * m
        made.append((times, need))

    def filled(first: int) -> list[int] | None:
        left[first] -= 1
        found = exact_fill(capacity - first, left)
        left[first] += 1
        return [first, *found] if found else None

    for length in range(capacity, 0, -1):
        if length == capacity and left[length]:
            use([length])
        while left[length] and (chosen := filled(length)):
            use(chosen)
    while left.any():  # best fit of what no exact complement took
        chosen, gap = [], capacity
        trial = left.copy()
        while gap:
            rest = exact_fill(gap, trial) if chosen else None
            at = np.flatnonzero(trial[:gap + 1] > 0)
            if rest is None and not len(at):
                break
            for n in rest or [int(at[-1])]:
                chosen.append(n)
                trial[n] -= 1
                gap -= n
        use(chosen)
    return made


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Piece rows with ``sequence_id`` and ``offset``. Every piece of every row
    is placed (repeated rows as often as they occur); an empty table packs into
    nothing. Sequences hold at most ``capacity`` tokens without gaps."""
    rows = checkpointed(pieces(docs, tokenizer_path, capacity, id_col, text_col))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)))
    cells = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = cells.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    totals = cells.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, np.int64)
    for r in totals:
        counts[r["length"]] = r["n"]
    given, parts, sequence = Counter(), [], 0
    for times, need in plan(counts, capacity):
        offset = 0
        for n, m in sorted(need.items(), reverse=True):
            parts.append((n, given[n], sequence, m, offset))
            given[n] += times * m
            offset += n * m
        sequence += times
    parts.sort()
    length, first, seq, each, offset = (np.array(c, dtype=np.int64) for c in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 5
    keys = (length << 48) + first

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, rank = (np.asarray(b.column(i), dtype=np.int64) for i in (3, 5))
            at = np.searchsorted(keys, (n << 48) + rank, side="right") - 1
            k = rank - first[at]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq[at] + k // each[at]), pa.array(offset[at] + k % each[at] * n)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (salted.withColumn("at", F.row_number().over(order)).join(firsts, ["length", "salt"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("at") - 1).alias("rank")))
    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")
