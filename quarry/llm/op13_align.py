"""Cross-tokenizer alignment by interval coalescing.

The tokens of two vocabularies cut the same bytes in two ways. All tokens are
sorted by their start, the running maximum of their ends is accumulated, and a
group ends where the next start reaches that maximum: there both sides have a
boundary. Inside the groups every A token is expanded to the B tokens whose
bytes it overlaps; pairs that end together are links.

Neither vocabulary has a token that goes on with white space after another
character, so a text is cut before blanks that follow a visible character,
distinct segments are encoded and aligned once, and a text is its segments in
order. Texts with white space beyond ASCII stay whole."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import codes_of, id_text, slices, written
from quarry.llm.op11_bpe import MergeRounds, byte_letters, spans

#: Distinct segments that a Python worker keeps between slices, and encodes at a time.
CACHE_SEGMENTS, LEARN = 150_000, 20_000
SLICE = 1 << 20
#: Links that a task looks up or counts at a time (a longer document is taken alone).
LINKS = 400_000
#: Rows of the table of pair counts that a pass over the links holds: whole B ids,
#: each of which has at most as many rows as there are A ids.
PAIRS = 2_000_000
#: White space other than ASCII, as the A pattern knows it.
WIDE_BLANKS = "[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
BLANK = "\u2581"  # B's letter for a space
#: Segments of these characters are split by the pattern below, which is the fixed pattern of byte-level vocabularies
#: for them, with a mark after each segment; all others are encoded by A's library.
PLAIN, MARK = r"\A[ -~\n]*\z", "\x1e"
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9\x1e]+|\s+(?![^\s\x1e])|\s+|\x1e", re.ASCII)


def _lengths(tokens: list[bytes]) -> np.ndarray:
    return np.array([len(t) for t in tokens], dtype=np.int64)


class Side:
    """The bytes of every id of one vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = _lengths(tokens)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def same(self, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the tokens of each segment give its bytes (``data``, ``sizes``)."""
        segment = np.repeat(np.arange(len(counts)), counts)
        good = np.bincount(segment, weights=self.sizes[ids], minlength=len(counts)) == sizes
        fits = good[segment]
        mine = self.data[spans(self.starts[ids[fits]], self.sizes[ids[fits]])]
        theirs = data[np.repeat(good, sizes)]
        wrong = np.repeat(np.arange(len(counts)), np.where(good, sizes, 0))[mine != theirs]
        good[wrong] = False
        return good


def coalesce(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For byte lengths of A and B tokens over the same bytes: (group of each A
    token, of each B token, A places and B places of all overlapping pairs)."""
    a_end, b_end = np.cumsum(a_sizes), np.cumsum(b_sizes)
    start, end = np.concatenate((a_end - a_sizes, b_end - b_sizes)), np.concatenate((a_end, b_end))
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    group = np.zeros(len(order), np.int64)
    group[order[1:]] = np.cumsum(start[order][1:] >= reach[:-1])
    first = np.searchsorted(b_end, a_end - a_sizes, side="right")
    many = np.searchsorted(b_end - b_sizes, a_end, side="left") - first
    return group[:len(a_sizes)], group[len(a_sizes):], np.repeat(np.arange(len(a_sizes)), many), spans(first, many)


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=b_path)
        raw = {c: b for b, c in enumerate(byte_letters())}
        names = {i: t for t, i in self.a.get_vocab().items()}
        self.a_side = Side([bytes(raw[c] for c in names.get(i, "") if c in raw) for i in range(max(names) + 1)])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_side = Side([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)])
        self.blank = self.b.piece_to_id(BLANK)
        with open(a_path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rounds = MergeRounds(np.array([(ids[x], ids[y], ids[x + y]) for x, y in pairs], dtype=np.int64), max(ids.values()) + 1)
        self.letters = np.array([ids[c] for c in byte_letters()], dtype=np.int64)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.good = np.zeros(0, bool)
        self.counts = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups, links
        self.links = np.zeros((0, 2), np.int32)
        self.shown = pa.array([], pa.string())

    def b_ids(self, segments: list[str]) -> list[list[int]]:
        """B itself puts a blank before a text: it replaces a segment's own, or
        goes again where the segment starts with another character."""
        found = self.b.encode([s[1:] if s[0] == " " else s for s in segments], num_threads=1)
        return [[self.blank] if s == " " else ids if s[0] == " " else ids[1:] for s, ids in zip(segments, found)]

    def a_ids(self, plain: list[str], others: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all segments in order, ids of each): merge rounds for the plain ones."""
        codes, distinct = codes_of(pa.array(PIECES.findall("".join(s + MARK for s in plain)), pa.string()))
        raw = [p.encode() for p in distinct.to_pylist()]
        ids, sizes = self.rounds.merge(self.letters[np.frombuffer(b"".join(raw), np.uint8)], _lengths(raw))
        marks = np.asarray(pc.equal(distinct, MARK))
        starts, sizes = np.cumsum(sizes) - sizes, np.where(marks, 0, sizes)
        segment = np.cumsum(marks[codes]) - marks[codes]
        n = sizes[codes]
        more = [e.ids for e in self.a.encode_batch_fast(others, add_special_tokens=False)]
        return (np.concatenate((ids[spans(starts[codes], n)], np.fromiter(chain.from_iterable(more), np.int64))),
                np.concatenate((np.bincount(segment, weights=n, minlength=len(plain)).astype(np.int64)[:len(plain)], _lengths(more))))

    def learn(self, new: list[str]) -> None:
        plain = np.asarray(pc.match_substring_regex(pa.array(new, pa.string()), PLAIN)).tolist()
        plain, others = [s for s, p in zip(new, plain) if p], [s for s, p in zip(new, plain) if not p]
        a, na = self.a_ids(plain, others)
        new = plain + others
        b = self.b_ids(new)
        b, nb = np.fromiter(chain.from_iterable(b), np.int64), _lengths(b)
        raw = [s.encode() for s in new]
        data, sizes = np.frombuffer(b"".join(raw), np.uint8), _lengths(raw)
        good = self.a_side.same(a, na, data, sizes) & self.b_side.same(b, nb, data, sizes)
        a, b = a[np.repeat(good, na)], b[np.repeat(good, nb)]
        na, nb = np.where(good, na, 0), np.where(good, nb, 0)
        a_sizes, b_sizes = self.a_side.sizes[a], self.b_side.sizes[b]
        ga, gb, i, j = coalesce(a_sizes, b_sizes)
        together = np.cumsum(a_sizes)[i] == np.cumsum(b_sizes)[j]
        i, j = i[together], j[together]
        segment = np.repeat(np.arange(len(new)), na)
        groups = int(ga[-1]) + 1 if len(ga) else 0
        owner = np.zeros(groups, np.int64)
        owner[ga] = segment
        per = [np.bincount(x, minlength=len(new)) for x in (owner, segment[i])]

        def listed(ids: np.ndarray, of: np.ndarray) -> pa.Array:
            ends = np.append(0, np.cumsum(np.bincount(of, minlength=groups))).astype(np.int32)
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids).cast(pa.string())), ",")
        shown = pc.binary_join_element_wise(listed(a, ga), listed(b, gb), "|")
        ends = np.append(0, np.cumsum(per[0])).astype(np.int32)
        shown = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), shown), ";")
        self.known.update(zip(new, range(len(self.good), len(self.good) + len(new))))
        self.good = np.concatenate((self.good, good))
        self.counts = np.concatenate((self.counts, np.stack([na, nb, *per], axis=1)))
        self.links = np.concatenate((self.links, np.stack([a[i], b[j]], axis=1).astype(np.int32)))
        self.shown = pa.concat_arrays([self.shown, shown])

    def align(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """(texts x A tokens, B tokens, groups, links; groups as text; links of all texts in order)."""
        owner, flat = segments(texts)
        codes, distinct = codes_of(flat)
        if len(self.known) > CACHE_SEGMENTS:
            self.clear()
        distinct = distinct.to_pylist()
        new = [s for s in distinct if s not in self.known]
        for k in range(0, len(new), LEARN):
            self.learn(new[k:k + LEARN])
        at = np.fromiter((self.known[s] for s in distinct), np.int64, len(distinct))[codes]
        whole = np.ones(len(texts), bool)
        whole[owner[~self.good[at]]] = False  # one segment differs: the text has no tokens
        at, owner = at[whole[owner]], owner[whole[owner]]
        counts = np.stack([np.bincount(owner, weights=c, minlength=len(texts)).astype(np.int64) for c in self.counts[at].T], axis=1)
        ends = np.append(0, np.cumsum(np.bincount(owner, minlength=len(texts)))).astype(np.int32)
        shown = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), self.shown.take(pa.array(at))), ";")
        n = self.counts[:, 3]
        return counts, shown, self.links[spans((np.cumsum(n) - n)[at], n[at])]


def segments(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(text of each segment, segments in order) of a space and each text, cut
    before a blank or line feed that follows a visible character. Null and
    empty texts have none."""
    size = pc.fill_null(pc.binary_length(texts), 0)
    which = np.flatnonzero(np.asarray(size) > 0)
    texts = texts.take(pa.array(which))
    if not len(which):
        return which, pa.array([], pa.string())
    whole = np.asarray(pc.match_substring_regex(texts, WIDE_BLANKS))
    spaced = pc.binary_join_element_wise(pa.scalar(" "), texts, "")
    _, ends, data = spaced.buffers()
    ends = np.frombuffer(ends, np.int32)[spaced.offset:spaced.offset + len(spaced) + 1]
    data = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    seen = (data[:-1] > 0x20) & (data[:-1] != 0x7F)
    cut = np.flatnonzero(((data[1:] == 0x20) | (data[1:] == 0x0A)) & seen) + 1
    text = np.searchsorted(ends, cut, side="right") - 1
    cut = cut[~whole[text]]
    begins = np.zeros(len(data), bool)
    begins[ends[:-1]] = begins[cut] = True
    starts = np.flatnonzero(begins)
    flat = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, ends[-1]).astype(np.int32)), pa.py_buffer(data))
    return which[np.searchsorted(ends, starts, side="right") - 1], flat


@lru_cache(maxsize=1)
def worker_aligner(a_path: str, b_path: str) -> Aligner:
    """One per Python worker: Spark reuses workers for many tasks."""
    return Aligner(a_path, b_path)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ``n_a``, ``n_b``, ``n_groups``, ``groups`` (decimal ids,
    ``a1,a2|b1;a3|b2,b3``) and the links in order as ``link_a``, ``link_b``. A
    text that is null or empty, or that one of the vocabularies does not give
    back, has zeros, no links and empty ``groups``. Repeated rows and ids give
    a row each; an empty table gives none; other columns are not looked at."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                        ("groups", pa.string()), ("link_a", pa.list_(pa.int32())), ("link_b", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_aligner(a_path, b_path)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                counts, shown, links = aligner.align(part.column(1))
                ends = pa.array(np.append(0, np.cumsum(counts[:, 3])).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c) for c in counts[:, :3].T), shown,
                     *(pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(c))) for c in links.T)], schema=schema)
    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, groups string, link_a array<int>, link_b array<int>")


def _link_slices(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Batches cut to at most ``LINKS`` links in the list column ``at``, or one row."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(batch.column(at)), 0), dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + LINKS, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def pair_counts(linked: DataFrame) -> DataFrame:
    """How many links hold each pair: (a, b, n). Tasks count their own pairs first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(sums)],
                                              names=["a", "b", "n"])
        for batch in _link_slices(batches, 0):
            a, b = (np.asarray(batch.column(i).flatten(), dtype=np.int64) for i in (0, 1))
            new, n = np.unique(a << 32 | b, return_counts=True)
            keys, of = np.unique(np.concatenate((keys, new)), return_inverse=True)
            sums = np.bincount(of, weights=np.concatenate((sums, n)), minlength=len(keys)).astype(np.int64)
            if len(keys) > PAIRS:
                yield out()
                keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield out()
    found = linked.select("link_a", "link_b").mapInArrow(run, "a int, b int, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def with_counts(linked: DataFrame) -> DataFrame:
    """The rows of ``linked`` (``link_a``, ``link_b``; a table that is read more
    than once) with ``n_links``, ``n_best`` (links whose pair is as frequent as
    any pair of its B id) and ``count_sum`` (frequencies of the pairs over the
    links) in place of the links. Null lists have no links."""
    rest = [c for c in linked.columns if c not in ("link_a", "link_b", "n_links", "n_best", "count_sum")]
    counts = written(pair_counts(linked))
    frame = linked.select(*rest, "link_a", "link_b", *(F.lit(0).cast("long").alias(c) for c in ("n_best", "count_sum")))
    for k, (low, high) in enumerate(blocks(counts)):
        frame = frame if k == 0 else written(frame)
        some = counts.where(F.col("b").between(low, high)).toArrow()
        a, b, n = (some.column(c).to_numpy() for c in ("a", "b", "n"))
        key = b.astype(np.int64) << 32 | a
        order = np.argsort(key)
        key, b, n = key[order], b[order], n[order]
        if len(b):
            first = np.flatnonzero(np.diff(b, prepend=-1))
            best = n == np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(b))))
            frame = _add(frame, len(rest), frame.sparkSession.sparkContext.broadcast((key, n, best)))
    return frame.select(*rest, F.coalesce(F.size("link_a"), F.lit(0)).cast("long").alias("n_links"), "n_best", "count_sum")


def blocks(counts: DataFrame) -> list[tuple[int, int]]:
    """Ranges of B ids with at most ``PAIRS`` rows, or one id."""
    sizes = sorted((r["b"], r["pairs"]) for r in counts.groupBy("b").agg(F.count(F.lit(1)).alias("pairs")).collect())  # at most the B ids
    out: list[tuple[int, int]] = []
    held = 0
    for b, pairs in sizes:
        if out and held + pairs <= PAIRS:
            out[-1], held = (out[-1][0], b), held + pairs
        else:
            out.append((b, b))
            held = pairs
    return out


def _add(frame: DataFrame, at: int, table) -> DataFrame:
    names = frame.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, best = table.value
        for batch in _link_slices(batches, at):
            lists = batch.column(at)
            a, b = (np.asarray(batch.column(i).flatten(), dtype=np.int64) for i in (at, at + 1))
            row = np.repeat(np.arange(batch.num_rows), np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64))
            pair, of = np.unique(b << 32 | a, return_inverse=True)
            place = np.minimum(np.searchsorted(key, pair), len(key) - 1)
            here = key[place] == pair
            columns = list(batch.columns)
            for i, value in ((at + 2, best), (at + 3, n)):
                more = np.zeros(batch.num_rows, np.int64)
                np.add.at(more, row, np.where(here, value[place], 0)[of].astype(np.int64))
                columns[i] = pa.array(np.asarray(columns[i]) + more)
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return frame.mapInArrow(run, frame.schema)
