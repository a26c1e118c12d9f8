"""Suffix-array dedup on a run-length index.

Byte segments that share a group (see ``segments``) are indexed by their
run-compressed Burrows-Wheeler transform with suffix-array samples at run ends.
Segments stream through it right to left; at a byte that the current row does
not continue with, the row jumps to the nearest run of that byte whose sampled
suffix shares more with the match so far. Rows whose suffixes agree on the
first ``window`` bytes carry the smallest document id among them, so a match of
that length says at once whether a smaller document has the window."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quarry.llm.segments import Method, Units, applied, mixed, unit_mask, with_spans

WINDOW = 50
PREFIX = 24
_TABLE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def byte_units(texts: pa.Array) -> Units:
    texts = pc.fill_null(texts, "").cast(pa.binary())
    counts = np.asarray(pc.binary_length(texts), dtype=np.int64)
    data = b"".join(texts.to_pylist())
    return Units(counts, gram_hash(np.frombuffer(data, np.uint8), PREFIX))


def byte_groups(texts: list[bytes], windows: np.ndarray) -> np.ndarray:
    size = windows + WINDOW - 1
    low = gram_hash(np.frombuffer(b"".join(texts), np.uint8), PREFIX)
    begin = np.cumsum(size) - size
    return np.minimum.reduceat(low, np.stack([begin, begin + size - PREFIX + 1], axis=1).ravel())[::2] if len(texts) else low


def cut_bytes(text: str, starts: list[int], ends: list[int]) -> list[bytes]:
    data = text.encode()
    return [data[a:b] for a, b in zip(starts, ends)]


def gram_hash(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n bytes from each position; positions nearer to the end keep
    a hash of fewer bytes."""
    h, width = _TABLE[data], 1
    while width < n:
        step = min(width, n - width)  # the last step may overlap
        if len(h) > step:
            h[:-step] = h[:-step] * np.uint64(0xD6E8FEB86659FD93) + (h[step:] ^ (h[step:] >> np.uint64(32)))
        width += step
    return mixed(h)


class RunLengthIndex:
    """Index over texts (bytes), each closed by its own end mark. ``labels`` is
    one number per text; ``least`` gives the smallest label over all texts that
    hold the ``window`` bytes a row starts with. ``window`` is 8 or more (the
    first sort covers 7 bytes)."""

    def __init__(self, texts: list[bytes], labels: np.ndarray, window: int = WINDOW):
        self.window = window
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        ends = np.cumsum(size)
        self.begin = ends - size
        raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        mark = np.zeros(len(raw), bool)
        mark[ends - 1] = True
        self.text = np.where(mark, 0, raw.astype(np.int16) + 1)  # 0: end mark
        n = len(raw)
        sa, lcp_breaks = self._suffixes(mark, size)
        previous = self.text[sa - 1]
        change = np.flatnonzero(np.diff(previous, prepend=-1))
        self.start, self.symbol = change, previous[change]
        self.run_of = np.repeat(np.arange(len(change), dtype=np.int32), np.diff(np.append(change, n)))  # rank support
        length = np.diff(np.append(change, n))
        counts = np.bincount(previous, minlength=258)
        first = np.cumsum(counts) - counts
        order = np.argsort(self.symbol, kind="stable")  # runs of a symbol, in row order
        inside = np.cumsum(length[order]) - length[order]
        group = np.searchsorted(self.symbol[order], np.arange(258))
        base = np.append(inside, n)[np.minimum(group, len(order))]
        self.lf = np.empty(len(order), np.int64)
        self.lf[order] = first[self.symbol[order]] + inside - base[self.symbol[order]]
        self.by_symbol, self.group = order, np.append(group, len(order))
        self.first_sample, self.last_sample = sa[change], sa[change + length - 1]
        # rows that agree on ``window`` bytes: runs of rows, each with its least label
        class_start = np.flatnonzero(lcp_breaks)
        self.class_of = np.repeat(np.arange(len(class_start), dtype=np.int32), np.diff(np.append(class_start, n)))
        owner = np.asarray(labels, dtype=np.int64)[np.searchsorted(ends, sa, side="right")]
        self.least = np.minimum.reduceat(owner, class_start)
        self.rows = n

    def _suffixes(self, mark: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(suffix array, mask of the rows that differ from the row above within
        ``window`` bytes). Sorts by 7 bytes, then doubles the depth for the
        suffixes that still tie. End marks sort by text, below every byte."""
        n = len(mark)
        text = self.text.astype(np.int64)
        left = np.repeat(np.cumsum(size), size) - 1 - np.arange(n)  # bytes before the end mark
        key = np.zeros(n, np.int64)
        for k in range(7):
            part = np.zeros(n, np.int64)
            part[:max(n - k, 0)] = text[k:]
            part[left < k] = 0
            key = (key << 9) | part
        sa = np.argsort(key)
        sorted_key = key[sa]
        short = np.flatnonzero(left[sa] < 7)  # equal short suffixes go by text
        sa[short] = sa[short][np.argsort(np.unique(sorted_key[short], return_inverse=True)[1] * n + sa[short])]
        # a suffix of under 7 bytes ends in a mark; those tie only with shorter ones, and text order settles them
        new = np.empty(n, bool)
        new[0] = True
        new[1:] = (sorted_key[1:] != sorted_key[:-1]) | (left[sa[1:]] < 7)
        breaks = new.copy()
        depth = 7
        rank = np.empty(n, np.int64)
        rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        while True:
            alone = new & np.append(new[1:], True)
            rows = np.flatnonzero(~alone)
            if not len(rows):
                break
            at = sa[rows]
            # suffixes still tied at this depth are longer than it: what follows exists in the same text
            following = rank[at + depth]
            order = np.argsort(rank[at] * (n + 1) + following)
            sa[rows] = at = at[order]
            follow, head = following[order], rank[at]
            fresh = np.empty(len(rows), bool)
            fresh[0] = True
            fresh[1:] = (follow[1:] != follow[:-1]) | (head[1:] != head[:-1])
            if depth < self.window <= 2 * depth:  # decide agreement on the first ``window`` bytes
                self._mark_breaks(breaks, new, rows, at, rank, fresh, depth)
            elif 2 * depth < self.window:
                breaks[rows] |= fresh
            new[rows] |= fresh
            starts = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            rank = rank.copy()
            rank[sa[rows]] = starts[rows]
            depth *= 2
        return sa, breaks

    def _mark_breaks(self, breaks, new, rows, at, rank, fresh, depth) -> None:
        """Tied suffixes agree on ``window`` bytes if what starts at
        ``window - depth`` agrees on ``depth`` bytes as well (same rank)."""
        place = at + (self.window - depth)
        tail = rank[np.minimum(place, len(rank) - 1)]
        differ = np.ones(len(rows), bool)
        differ[1:] = (tail[1:] != tail[:-1]) | (rank[at[1:]] != rank[at[:-1]])
        breaks[rows] |= differ

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at a and b share, up to ``window``."""
        out = np.zeros(len(a), np.int64)
        on = np.arange(len(a))
        for k in range(self.window):
            x, y = a[on] + k, b[on] + k
            fine = (x < self.rows) & (y < self.rows)
            on, x, y = on[fine], x[fine], y[fine]
            same = (self.text[x] == self.text[y]) & (self.text[x] != 0)
            on = on[same]
            if not len(on):
                break
            out[on] += 1
        return out

    def matches(self, queries: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Matching statistics, streamed from the right in all queries at once:
        per query and position the longest match with any indexed text (counted
        up to ``window``), and the least label of a full match (else the largest
        integer)."""
        size = np.fromiter(map(len, queries), np.int64, len(queries))
        data = np.frombuffer(b"".join(queries), np.uint8).astype(np.int16) + 1
        ends = np.cumsum(size)
        length = np.zeros(len(data), np.int64)
        label = np.full(len(data), np.iinfo(np.int64).max)
        order = np.argsort(-size, kind="stable")
        row = np.zeros(len(queries), np.int64)
        pos = np.zeros(len(queries), np.int64)  # a text position of the match: the suffix of ``row``
        have = np.zeros(len(queries), np.int64)
        pos[:] = self.first_sample[0]
        for step in range(int(size.max()) if len(size) else 0):
            live = order[:np.searchsorted(-size[order], -step, side="left")]
            at = ends[live] - 1 - step
            c, q = data[at], row[live]
            run = self.run_of[q]
            stay = self.symbol[run] == c
            where, got = pos[live], np.minimum(have[live] + 1, self.window)
            jump = np.flatnonzero(~stay)
            if len(jump):
                self._jump(jump, c, q, run, where, have[live], got)
            known = got > 0
            q = np.where(known, self.lf[run] + q - self.start[run], q)
            where = np.where(known, where - 1, where)
            row[live], pos[live], have[live] = q, where, got
            length[at] = got
            full = got >= self.window
            label[at[full]] = self.least[self.class_of[q[full]]]
        cut = ends[:-1]
        return np.split(length, cut), np.split(label, cut)

    def _jump(self, jump, c, q, run, where, have, got) -> None:
        """Moves each row in ``jump`` to the neighbouring run of its byte whose
        sampled suffix shares most with the match so far; no such run: length 0."""
        byte = c[jump].astype(np.int64)
        low, high = self.group[byte], self.group[byte + 1]
        # position of the current run among the runs of the byte
        after = low + _rank_in(self.by_symbol, low, high, run[jump])
        best = np.full(len(jump), -1, np.int64)
        to_row, to_run, to_pos = q[jump].copy(), run[jump].copy(), where[jump].copy()
        for side in (-1, 0):
            k = after + side
            fine = (k >= low) & (k < high)
            r = self.by_symbol[np.clip(k, 0, len(self.by_symbol) - 1)]
            sample = self.last_sample[r] if side else self.first_sample[r]
            shared = np.where(fine, self._shared(np.where(fine, sample, 0), where[jump]), -1)
            shared = np.where(fine, np.minimum(shared, have[jump]), -1)
            better = shared > best
            end = np.append(self.start[1:], self.rows)[r] - 1
            to_row = np.where(better, end if side else self.start[r], to_row)
            to_run, to_pos, best = np.where(better, r, to_run), np.where(better, sample, to_pos), np.maximum(best, shared)
        q[jump], run[jump], where[jump] = to_row, to_run, to_pos
        got[jump] = np.where(best >= 0, np.minimum(best + 1, self.window), 0)


def _rank_in(values: np.ndarray, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many of values[low:high] (each ascending) are below x."""
    a, b = low.copy(), high.copy()
    while (a < b).any():
        mid = (a + b) // 2
        less = (a < b) & (values[np.minimum(mid, len(values) - 1)] < x)
        a, b = np.where(less, mid + 1, a), np.where((a < b) & ~less, mid, b)
    return a - low


def occur_again(texts: list[bytes], windows: np.ndarray) -> np.ndarray:
    """Mask over all windows of the texts that leaves out windows alone of their
    hash. Equal windows have equal hashes and always stay; a few others stay as
    well: the hash picks a cell of a table, three times, from other bits."""
    h = gram_hash(np.frombuffer(b"".join(texts), np.uint8), WINDOW)
    begin = np.cumsum(windows) - windows
    at = np.arange(int(windows.sum())) + np.repeat((np.arange(len(texts))) * (WINDOW - 1), windows)
    h, left = h[at], np.arange(len(at))
    bits = max(int(len(h)).bit_length() + 1, 8)
    for k in range(3):
        cell = ((h[left] >> np.uint64(k * (64 - bits) // 2)) & np.uint64((1 << bits) - 1)).astype(np.int64)
        left = left[np.bincount(cell, minlength=1 << bits)[cell] > 1]
    mask = np.zeros(len(h), bool)
    mask[left] = True
    # windows between two such are taken along, so that texts are cut where they share nothing
    own = np.repeat(np.arange(len(texts)), windows)
    near = np.flatnonzero((np.diff(left) > 1) & (np.diff(left) <= WINDOW) & (own[left[1:]] == own[left[:-1]])) if len(left) else left
    edge = np.zeros(len(h) + 1, np.int32)
    edge[left[near] + 1] += 1
    edge[left[near + 1]] -= 1
    return mask | (np.cumsum(edge[:-1]) > 0)


def smaller_has_window(texts: list[bytes], windows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Mask over all windows of the segments. Equal segments are one, under their
    smallest id; stretches whose windows occur again are indexed and streamed."""
    d = pa.array(texts, pa.binary()).dictionary_encode()
    which, distinct = np.asarray(d.indices, dtype=np.int64), d.dictionary.to_pylist()
    low = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(low, which, ids)
    n = np.fromiter(map(len, distinct), np.int64, len(distinct)) - WINDOW + 1
    begin = np.cumsum(n) - n
    least = np.repeat(low, n)
    again = occur_again(distinct, n)
    own = np.repeat(np.arange(len(distinct)), n)
    joint = again & np.append(False, again[:-1] & (own[1:] == own[:-1]))
    first = np.flatnonzero(again & ~joint)
    if len(first):
        count = np.diff(np.append(np.flatnonzero((again & ~joint)[again]), int(again.sum())))
        place = first - begin[own[first]]
        pieces = [distinct[t][p:p + k + WINDOW - 1] for t, p, k in zip(own[first].tolist(), place.tolist(), count.tolist())]
        _, label = RunLengthIndex(pieces, low[own[first]]).matches(pieces)
        least[again] = np.concatenate([x[:k] for x, k in zip(label, count.tolist())])
    base = np.cumsum(windows) - windows
    at = np.repeat(begin[which] - base, windows) + np.arange(int(windows.sum()))
    return np.repeat(ids, windows) > least[at]


BYTES = Method(WINDOW, PREFIX, byte_units, cut_bytes, byte_groups, smaller_has_window, slice_bytes=2 << 20)


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every input row as struct ``row`` plus ``kept`` (binary: the UTF-8 bytes
    left), ``n_bytes``, ``n_removed`` and ``n_spans``. A byte goes if a 50-byte
    string over it also starts in a document with a smaller id. A null text is
    empty. Rows without an id come after all others; rows with the same id
    never take from each other."""
    def keep(data: bytes, spans: np.ndarray | None) -> tuple[bytes, int, int, int]:
        if spans is None:
            return data, len(data), 0, 0
        gone = unit_mask(spans, len(data))
        return (np.frombuffer(data, np.uint8)[~gone].tobytes(), len(data), int(gone.sum()),
                int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))

    return applied(with_spans(docs, BYTES, id_col, text_col), text_col, keep,
                   [("kept", "binary", pa.binary()), ("n_bytes", "long", pa.int64()), ("n_removed", "long", pa.int64()), ("n_spans", "long", pa.int64())])
