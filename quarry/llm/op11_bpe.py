"""BPE encoding and decoding in batched merge rounds.

The symbols of many words lie in one flat array. A round looks the ranks of all
neighbouring pairs up by binary search over the sorted pair keys and joins, in
every word at once, each pair that no merge yet to come can touch before it.
Words are independent of each other, so texts are cut at white space, distinct
pieces are encoded once, and a text's ids are those of its pieces in order."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quarry.llm.common import codes_of, id_text, slices, words_of

#: Distinct pieces whose ids a Python worker keeps between slices.
CACHE_PIECES = 200_000
SLICE = 2 << 20
CUT = "\n"  # stands between the pieces of two words; never part of a word


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies show for each byte: the byte's own
    character where it is printable, else the next one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 0x100
    for b in range(256):
        letters.append(chr(b if b in shown else spare))
        spare += b not in shown
    return letters


class MergeRounds:
    """The merges of a vocabulary as sorted keys, applied to flat symbol arrays."""

    def __init__(self, merges: np.ndarray, size: int):
        """``merges``: rows (left id, right id, joined id) in order of rank."""
        self.size, self.none = size, len(merges)
        keys = merges[:, 0] * size + merges[:, 1]
        self.rank = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank]
        self.joined = np.append(merges[:, 2], -1)
        first_use = np.full(size, self.none, np.int64)
        for side in (0, 1):
            np.minimum.at(first_use, merges[:, side], np.arange(self.none))
        #: lowest rank of any pair that the symbol joined at a rank can be part of
        self.opens = np.append(first_use[merges[:, 2]], self.none)
        self.ordered = bool((self.opens[:-1] > np.arange(self.none)).all())

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair (``none`` if it is no merge)."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), self.none - 1)
        return np.where(self.keys[at] == key, self.rank[at], self.none)

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each word) for words given as consecutive symbols;
        ``sizes`` (each at least 1) says how many each word has."""
        own = np.repeat(np.arange(len(sizes)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            rank = np.full(len(symbols), self.none, np.int64)  # of the pair that starts at each symbol
            inside = np.flatnonzero(own[:-1] == own[1:])
            rank[inside] = self.ranks(symbols[inside], symbols[inside + 1])
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            many = np.diff(np.append(starts, len(own)))
            lowest = np.minimum.reduceat(rank, starts)
            open_ = np.repeat(lowest < self.none, many)
            if not open_.all():
                done.append((symbols[~open_], own[~open_]))
                symbols, own, rank = symbols[open_], own[open_], rank[open_]
                if not len(symbols):
                    break
                starts = np.flatnonzero(np.diff(own, prepend=-1))
                many = np.diff(np.append(starts, len(own)))
            taken = self.chosen(rank, starts, many)
            symbols = symbols.copy()
            symbols[taken] = self.joined[rank[taken]]
            keep = np.ones(len(symbols), bool)
            keep[taken + 1] = False
            symbols, own = symbols[keep], own[keep]
        if not done:
            return symbols, np.zeros(len(sizes), np.int64)
        ids, own = (np.concatenate(x) for x in zip(*done))
        return ids[np.argsort(own, kind="stable")], np.bincount(own, minlength=len(sizes))

    def chosen(self, rank: np.ndarray, starts: np.ndarray, many: np.ndarray) -> np.ndarray:
        """Positions of the pairs to join now. A word's lowest pair always is
        one. Others below ``limit`` go with it where no neighbour is lower:
        symbols that this round makes only open pairs from ``limit`` on."""
        limit = np.repeat(np.minimum.reduceat(self.opens[rank] if self.ordered else rank + 1, starts), many)
        first = np.flatnonzero(np.diff(rank, prepend=-1))  # runs of equal rank: the same symbol again and again
        length = np.diff(np.append(first, len(rank)))
        of = rank[first]
        before, after = np.append(self.none, of[:-1]), np.append(of[1:], self.none)
        run = np.repeat((of < before) & (of < after), length)
        odd = (np.arange(len(rank)) - np.repeat(first, length)) & 1
        taken = np.flatnonzero(run & (odd == 0) & (rank < limit))
        if not self.ordered:  # one at a time where a joined symbol may open a lower pair
            word = np.searchsorted(starts, taken, side="right")
            taken = taken[np.diff(word, prepend=-1) > 0]
        return taken


class Codec:
    """Encoder and decoder of one tokenizer file: BPE over byte letters, with the
    file's own normaliser and splitting pattern, an optional mark at word ends,
    and no decoder (tokens are joined by a space)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        if model["type"] != "BPE" or model["byte_fallback"] or spec["decoder"] or split["type"] != "Split":
            raise ValueError(f"not a vocabulary of words over byte letters without a decoder: {path}")
        library = Tokenizer.from_file(path)
        self.normal, self.split = library.normalizer.normalize_str, library.pre_tokenizer[0].pre_tokenize_str
        vocabulary, end = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max(vocabulary.values(), default=0) + 1
        self.rounds = MergeRounds(np.array([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs], dtype=np.int64), size)
        self.inner = np.array([vocabulary[c] for c in byte_letters()], dtype=np.int64)
        self.last = np.array([vocabulary[c + end] for c in byte_letters()], dtype=np.int64)
        names = {i: t for t, i in [*vocabulary.items(), *specials.items()]}
        self.tokens = pa.array([names.get(i) for i in range(max(names) + 1)], pa.string())
        self.specials = specials
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
        # for ASCII words, where the file's classes of letters, digits and others are these
        self.ascii = re.compile(split["pattern"]["Regex"].replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9") + "|" + CUT, re.ASCII)
        self.clear()

    def clear(self) -> None:
        self.known = {CUT: -1}
        self.others: dict[str, list[str]] = {}  # pieces of words that are not plain ASCII
        self.pool, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)
        for name, i in self.specials.items():
            self.known[name] = len(self.sizes)
            self.pool, self.sizes = np.append(self.pool, np.int32(i)), np.append(self.sizes, 1)

    def pieces(self, words: pa.Array) -> tuple[np.ndarray, list[str]]:
        """(order in which the words were taken, their pieces in that order with
        ``CUT`` after each word)."""
        plain = pc.string_is_ascii(words)
        if self.special:
            plain = pc.and_(plain, pc.invert(pc.match_substring_regex(words, self.special.pattern)))
        mask = np.asarray(plain)
        out = self.ascii.findall((CUT.join(words.filter(plain).to_pylist()) + CUT).lower()) if mask.any() else []
        for word in words.filter(pc.invert(plain)).to_pylist():
            found = self.others.get(word)
            if found is None:
                found = self.others[word] = []
                for k, part in enumerate(self.special.split(word) if self.special else [word]):
                    found += [part] if k & 1 else [p for p, _ in self.split(self.normal(part))] if part else []
                found.append(CUT)
            out += found
        return np.argsort(~mask, kind="stable"), out

    def learn(self, new: list[str]) -> None:
        raw = [p.encode() for p in new]
        sizes = np.array([len(p) for p in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[data[ends]]
        ids, sizes = self.rounds.merge(symbols, sizes)
        self.known.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new))))
        self.pool, self.sizes = np.concatenate((self.pool, ids.astype(np.int32))), np.concatenate((self.sizes, sizes))

    def word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, ids of each word)."""
        if len(self.known) + len(self.others) > CACHE_PIECES:
            self.clear()
        order, parts = self.pieces(words)
        if new := [p for p in dict.fromkeys(parts) if p not in self.known]:
            self.learn(new)
        known = self.known
        at = np.fromiter((known[p] for p in parts), np.int64, len(parts))
        word = order[np.cumsum(at < 0)[at >= 0]]
        at = at[at >= 0]
        starts = np.cumsum(self.sizes) - self.sizes
        sizes = np.bincount(word, weights=self.sizes[at], minlength=len(words)).astype(np.int64)
        back = np.argsort(word, kind="stable")
        at = at[back]
        return self.pool[spans(starts[at], self.sizes[at])], sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, ids of each text); null is empty."""
        counts, flat = words_of(texts)
        codes, distinct = codes_of(flat)
        ids, sizes = self.word_ids(distinct)
        starts = np.cumsum(sizes) - sizes
        text = np.repeat(np.arange(len(counts)), counts)
        totals = np.bincount(text, weights=sizes[codes], minlength=len(counts)).astype(np.int64)
        return ids[spans(starts[codes], sizes[codes])], totals

    def decode(self, ids: pa.Array, offsets: np.ndarray) -> pa.Array:
        """Texts of consecutive id runs; ids outside the vocabulary are left out."""
        ids = pa.array(ids)
        bad = np.asarray(pc.fill_null(pc.or_(pc.less(ids, 0), pc.greater_equal(ids, len(self.tokens))), True))
        tokens = self.tokens.take(pc.if_else(pa.array(bad), 0, ids))
        bad |= np.asarray(tokens.is_null())
        if bad.any():
            offsets = np.append(0, np.cumsum(~bad))[offsets]
            tokens = tokens.filter(pa.array(~bad))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), tokens), " ")


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All indices start .. start + size, span after span."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


@lru_cache(maxsize=1)
def worker_codec(path: str) -> Codec:
    """One per Python worker: Spark reuses workers for many tasks."""
    return Codec(path)


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(sizes))


def encode(docs: DataFrame, tokenizer_path: str, decoded: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and ``ids`` (array of int); with ``decoded``
    also the text that those ids decode to. A null or empty text has no ids and
    decodes to the empty text; repeated rows and ids, null ids among them, give
    a row each; an empty table gives none; other columns are not looked at."""
    fields = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))] + [("decoded", pa.string())] * decoded
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
                          + [T.StructField("decoded", T.StringType())] * decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(tokenizer_path)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids, sizes = codec.encode(part.column(1))
                at = _offsets(sizes)
                columns = [part.column(0), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids, pa.int32()))]
                if decoded:
                    columns.append(codec.decode(ids, at))
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))
    return id_text(docs, id_col, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids") -> DataFrame:
    """The rows of ``encoded`` with a last column ``decoded`` (null for null ids;
    null elements and ids outside the vocabulary are left out). A column of
    that name is replaced."""
    rest = [c for c in encoded.columns if c != "decoded"]
    frame = encoded.select(*rest)
    at = rest.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(tokenizer_path)
        for batch in batches:
            if batch.num_rows:
                lists = batch.column(at)
                sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)
                texts = codec.decode(lists.flatten(), _offsets(sizes))
                texts = pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*rest, "decoded"])
    return frame.mapInArrow(run, T.StructType([*frame.schema.fields, T.StructField("decoded", T.StringType())]))
