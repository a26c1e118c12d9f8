"""Bringing equal content together, for the repeat finders.

Both finders ask, for every window of ``window`` units (words or bytes) of a
document, whether the same window starts in a document with a smaller id. The
plan is shared:

1. Every unit position has a *prefix* hash (``prefix`` units at most). The
   smallest hash inside a window names its group, so equal windows always have
   one group, and neighbouring windows mostly share a group: a segment.
2. Only the names of segments are shuffled first, by hash bucket: a segment
   whose group no other document has cannot hold a repeat and is done. A slice
   settles by itself what it holds twice and sends one name for it, so a
   passage in a third of all documents reaches its bucket once per slice.
3. The remaining segments are cut from their documents and meet by bucket.
   Before that, a slice decides what it can: a window that a smaller document
   of the slice has is final and, if its whole segment is, not shipped.
4. ``resolve`` decides the windows of a bucket; spans go back by document.

The number of buckets follows the corpus size, so a bucket fits in a task. A
group of more than PART bytes (the buckets of names sum them) would not: its
segments are cut into single windows, which go to buckets of their own by the
hash of the whole window. Equal windows still meet, and of equal windows a slice
ships one, so neither a group nor a window can outgrow a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import NO_ID, runs, slices

SLICE = 8 << 20
FLUSH = 32 << 20
BUCKET_BYTES = 8 << 20
#: Bytes of segments that are resolved at a time; larger groups are split by whole windows.
PART = 1 << 20
#: Bytes of segments are counted in steps of so many.
STEP = 16
#: Buckets of single windows for each bucket of segments (a window is shipped whole, so they take more room).
SPREAD = 8
#: Single windows that are cut out at a time.
AT_ONCE = 1 << 18
#: A slice decides itself the groups of which it holds so many segments.
LOCAL = 6
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * ODD
    return h ^ (h >> np.uint64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``values[i:i + width]`` for every full i."""
    out, have = values, 1
    while 2 * have <= width:
        out, have = np.minimum(out[:-have], out[have:]), 2 * have
    if have < width:
        out = np.minimum(out[:len(out) - (width - have)], out[width - have:])
    return out


@dataclass
class Units:
    """The units of a slice of documents: ``counts`` per document, the prefix
    hash at each unit and its bytes (None: one each)."""
    counts: np.ndarray
    prefix_hash: np.ndarray
    size: np.ndarray | None = None


@dataclass(frozen=True)
class Method:
    window: int
    prefix: int
    units: Callable[[pa.Array], Units]
    #: (text, starts, ends) -> the bytes of units start .. end - 1
    cut: Callable[[str, list[int], list[int]], list[bytes]]
    #: (segment bytes, windows of each) -> group hash of each: its smallest prefix hash
    groups: Callable[[list[bytes], np.ndarray], np.ndarray]
    #: (segment bytes, windows of each, ids) -> mask over all windows: a smaller id has it
    resolve: Callable[[list[bytes], np.ndarray, np.ndarray], np.ndarray]
    most_windows: int = 64
    #: bytes of text that are hashed at a time
    slice_bytes: int = 8 << 20


def segments_of(u: Units, m: Method) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first unit in the slice, windows, group hash) per segment:
    neighbouring windows of a document with the same smallest prefix hash."""
    total, first = int(u.counts.sum()), np.cumsum(u.counts) - u.counts
    if total < m.window:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    doc = np.repeat(np.arange(len(u.counts), dtype=np.int32), u.counts)
    low = sliding_min(u.prefix_hash[:total - m.prefix + 1], m.window - m.prefix + 1)
    n = total - m.window + 1
    low = low[:n]
    inside = doc[:n] == doc[m.window - 1:]
    at = np.flatnonzero(inside)
    if not len(at):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    group, owner = low[at], doc[at]
    new = np.concatenate(([True], (group[1:] != group[:-1]) | (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])))
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(at)))
    pieces = -(-size // m.most_windows)  # long runs (periodic text) are cut into several segments
    k = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(begin, pieces) + k * m.most_windows
    size = np.minimum(np.repeat(size, pieces) - k * m.most_windows, m.most_windows)
    return owner[begin].astype(np.int64), at[begin], size, group[begin]


def spans_of(mask: np.ndarray, windows: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first unit, end unit) of each run of marked windows."""
    ends = np.cumsum(windows)
    room = np.zeros(len(mask) + len(windows), bool)  # one unmarked place after each segment
    place = np.arange(len(mask)) + np.repeat(np.arange(len(windows)), windows)
    room[place] = mask
    a, b = runs(room)
    segment = np.searchsorted(ends + np.arange(len(windows)), a, side="right")
    base = (ends - windows + np.arange(len(windows)))[segment]
    return segment, starts[segment] + a - base, starts[segment] + (b - 1 - base) + window


def shared(tags: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Mask of the rows whose tag occurs with two ids or more."""
    codes, distinct = pd.factorize(tags)
    low = np.full(len(distinct), np.iinfo(np.int64).max)
    high = np.full(len(distinct), np.iinfo(np.int64).min)
    np.minimum.at(low, codes, ids)
    np.maximum.at(high, codes, ids)
    return (low < high)[codes]


def packed(arrays: list[np.ndarray]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.tobytes() for a in arrays))


def unpacked(data: bytes, n: int, kinds: list) -> list[np.ndarray]:
    raw, out, at = zstandard.decompress(data), [], 0
    for k in kinds:
        out.append(np.frombuffer(raw, k, n, at))
        at += n * np.dtype(k).itemsize
    return out


#: Kinds of blobs and their columns. NAMED: segments of one bucket (steps of id, version, start, windows, name, STEPs of bytes).
#: SEEN: (id, name, STEPs of bytes) of segments that their slice has found twice. FOUND: those segments (id, version, start,
#: windows, name, bucket). SPANS: settled spans (id, version, start, end).
NAMED, SEEN, FOUND, SPANS, BODY = range(5)
KINDS = {NAMED: [np.int64, np.int64, np.int32, np.int16, np.uint32, np.uint16], SEEN: [np.int64, np.uint32, np.uint32],
         FOUND: [np.int64, np.int64, np.int32, np.int16, np.uint32, np.int32], SPANS: [np.int64, np.int64, np.int32, np.int32],
         BODY: [np.int64, np.int64, np.int32, np.int16, np.uint16]}
#: In start * 2^16 + windows of a segment: its group is too large.
MARK = 1 << 15
BLOBS = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("n", pa.int64()), ("meta", pa.binary()), ("body", pa.binary())])
BLOBS_DDL = "bucket long, kind int, n long, meta binary, body binary"


def in_parts(m: Method, texts: list[bytes], windows: np.ndarray, ids: np.ndarray, key: np.ndarray) -> np.ndarray:
    """``resolve`` over segments in parts of whole groups (equal ``key``), each
    of about PART bytes, so that an index stays small."""
    order = np.argsort(key, kind="stable")
    size = np.cumsum(np.fromiter((len(texts[i]) for i in order.tolist()), np.int64, len(order)))
    fresh = np.flatnonzero(np.diff(key[order], prepend=-1))  # where groups begin
    before = np.concatenate(([0], size))[fresh] // PART
    cuts = fresh[np.diff(before, prepend=-1) > 0]
    out = np.zeros(int(windows.sum()), bool)
    base = np.cumsum(windows) - windows
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
        o = order[a:b]
        mask = m.resolve([texts[i] for i in o.tolist()], windows[o], ids[o])
        n = windows[o]
        out[np.repeat(base[o] - (np.cumsum(n) - n), n) + np.arange(len(mask))] = mask
    return out


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    bounds = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for a, b in zip(bounds, np.append(bounds[1:], len(order))):
        yield int(bucket[order[a]]), order[a:b]


def each_document(doc: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    at = np.flatnonzero(np.diff(doc, prepend=-1))
    return list(zip(at.tolist(), [*at[1:].tolist(), len(doc)]))


def in_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), BLOBS)], schema=BLOBS)
    for r in rows:
        held.append(r)
        size += len(r[3]) + len(r[4] or b"")
        if size > FLUSH // 8:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def named(m: Method, buckets: int):
    """mapInArrow over (_id, _version, text): names of the segments."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for part in slices(batch, "text", m.slice_bytes):
                ids, version = (np.asarray(part.column(i), dtype=np.int64) for i in (0, 1))
                u = m.units(part.column(2))
                doc, at, windows, group = segments_of(u, m)
                if not len(doc):
                    continue
                group = mixed(group)
                bucket, name = (group % np.uint64(buckets)).astype(np.int64), (group >> np.uint64(32)).astype(np.uint32)
                start = at - (np.cumsum(u.counts) - u.counts)[doc]
                own, ver = ids[doc], version[doc]
                key = (bucket << 32) + name.astype(np.int64)
                length = windows + m.window - 1
                if u.size is not None:
                    ends = np.concatenate(([0], np.cumsum(u.size)))
                    length = ends[at + length] - ends[at]
                steps = -(-length // STEP)
                twice = shared(key, own)
                if twice.any():
                    t = np.flatnonzero(twice)
                    place = (int(abs(int(ids[0]))) * 31 + len(doc)) % buckets
                    yield place, FOUND, len(t), packed([own[t], ver[t], start[t].astype(np.int32), windows[t].astype(np.int16), name[t], bucket[t].astype(np.int32)]), None
                    _, first, which = np.unique(key[t], return_index=True, return_inverse=True)
                    held = np.bincount(which, weights=steps[t])
                    first = t[first]
                    for b, o in by_bucket(bucket[first]):
                        held_here = np.minimum(held[o], 0xFFFFFFFF).astype(np.uint32)
                        o = first[o]
                        yield b, SEEN, len(o), packed([own[o], name[o], held_here]), None
                once = np.flatnonzero(~twice)
                for b, o in by_bucket(bucket[once]):
                    o = once[o]
                    yield b, NAMED, len(o), packed([np.diff(own[o], prepend=0), ver[o], start[o].astype(np.int32), windows[o].astype(np.int16), name[o],
                                                    np.minimum(steps[o], 0xFFFF).astype(np.uint16)]), None
    return lambda batches: in_batches(rows(batches))


def met(table: pa.Table) -> pa.Table:
    """applyInArrow over a bucket of names: the segments that another document
    may share (SEEN names stand for two documents at least), and their groups."""
    out, ids, names, full = [], [], [], []
    for bucket, kind, n, meta in zip(*(table.column(c).to_pylist() for c in ("bucket", "kind", "n", "meta"))):
        cols = unpacked(meta, n, KINDS[kind])
        if kind == FOUND:
            out.append([*cols[:4], (cols[5].astype(np.int64) << 32) + cols[4]])
        elif kind == SEEN:  # two entries: the group is shared whatever else holds it
            ids += [cols[0], np.full(n, -1)]
            names += [cols[1], cols[1]]
            full += [None, None]
        else:
            cols[0] = np.cumsum(cols[0])
            ids.append(cols[0])
            names.append(cols[1 + 3])
            full.append([*cols[:4], (bucket << 32) + cols[4].astype(np.int64)])
    if ids:
        mask = shared(np.concatenate(names), np.concatenate(ids))
        at = 0
        for i, cols in zip(ids, full):
            if cols is not None:
                o = np.flatnonzero(mask[at:at + len(i)])
                out.append([c[o] for c in cols])
            at += len(i)
    cols = [np.concatenate(c).astype(np.int64) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5
    return pa.table({"_id": cols[0], "_version": cols[1], "at": (cols[2] << 16) + cols[3], "key": cols[4]})


def large(table: pa.Table) -> pa.Table:
    """applyInArrow over a bucket of names: its groups of more than PART bytes."""
    names, steps, bucket = [np.zeros(0, np.uint32)], [np.zeros(0)], 0
    for bucket, kind, n, meta in zip(*(table.column(c).to_pylist() for c in ("bucket", "kind", "n", "meta"))):
        if kind != FOUND:
            cols = unpacked(meta, n, KINDS[kind])
            names.append(cols[1 if kind == SEEN else 4])
            steps.append(cols[-1].astype(np.float64))
    code, distinct = pd.factorize(np.concatenate(names))
    held = np.bincount(code, weights=np.concatenate(steps), minlength=len(distinct))
    return pa.table({"_large": (bucket << 32) + distinct[held * STEP > PART].astype(np.int64)})


def keys_of(m: Method, texts: list[bytes], windows: np.ndarray, buckets: int) -> np.ndarray:
    """bucket * 2^32 + name of each segment."""
    group = mixed(m.groups(texts, windows))
    return ((group % np.uint64(buckets)).astype(np.int64) << 32) + (group >> np.uint64(32)).astype(np.int64)


def whole_keys(texts: list[bytes], buckets: int) -> np.ndarray:
    """bucket * 2^32 + name of each single window; these buckets follow those of the segments."""
    h = mixed(pd.util.hash_array(np.fromiter(texts, object, len(texts)), categorize=False))
    return ((buckets + (h % np.uint64(SPREAD * buckets))).astype(np.int64) << 32) + (h >> np.uint64(32)).astype(np.int64)


def smaller_has(texts: list[bytes], ids: np.ndarray) -> np.ndarray:
    """Mask of the single windows that a smaller id has as well."""
    d = np.asarray(pa.array(texts, pa.binary()).dictionary_encode().indices, dtype=np.int64)
    least = np.full(int(d.max()) + 1 if len(d) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, d, ids)
    return ids > least[d]


def cut_out(m: Method, buckets: int, text_col: str):
    """mapInArrow over (row, _id, _version, segments): segment bodies (of large
    groups, marked in their windows, each window by itself), one blob per bucket
    and flush, and the spans that a slice settles."""
    def flush(held: list) -> Iterator[tuple]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        ids, version, start, windows, key = (np.concatenate(c) for c in zip(*(h[:5] for h in held)))
        texts = [t for h in held for t in h[5]]
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        # a word segment may be any length: those over 64 KiB travel with their size in parts
        high, size = size >> 16, (size & 0xFFFF).astype(np.uint16)
        for b, o in by_bucket((key >> 32) * 65536 + high):
            yield b >> 16, BODY, len(o) | (b & 0xFFFF) << 40, packed([np.diff(ids[o], prepend=0), version[o], start[o].astype(np.int32), windows[o].astype(np.int16), size[o]]), squeeze(b"".join([texts[i] for i in o]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held, size, number = [], 0, 0
        for batch in batches:
            text = batch.column(0).field(text_col)
            batch = pa.RecordBatch.from_arrays([text, *batch.columns[1:]], names=["text", "_id", "_version", "segments"])
            for part in slices(batch, "text", SLICE):
                n = np.diff(np.asarray(part.column(3).offsets))
                at = np.asarray(part.column(3).flatten(), dtype=np.int64)
                doc = np.repeat(np.arange(part.num_rows), n)
                start, windows, split = at >> 16, at & 0x7FFF, (at & MARK) > 0
                ids, version = (np.asarray(part.column(i), dtype=np.int64)[doc] for i in (1, 2))
                text = part.column(0).to_pylist()

                def cut(o: np.ndarray, first: np.ndarray, k: np.ndarray) -> list[bytes]:
                    """k windows from unit ``first`` of each of the segments o"""
                    out = []
                    for a, b in each_document(doc[o]):
                        out += m.cut(text[doc[o[a]]] or "", first[a:b].tolist(), (first[a:b] + k[a:b] + m.window - 1).tolist())
                    return out
                found = []
                all_split = np.flatnonzero(split)
                rounds = np.cumsum(windows[all_split]) // AT_ONCE
                for o in np.split(all_split, np.flatnonzero(np.diff(rounds)) + 1) if len(all_split) else []:
                    k = windows[o]
                    own = np.repeat(o, k)
                    place = start[own] + np.arange(len(own)) - np.repeat(np.cumsum(k) - k, k)
                    texts = cut(own, place, np.ones_like(own))
                    mask = smaller_has(texts, ids[own])
                    s, a, b = spans_of(mask, k, start[o], m.window)
                    found.append((o[s], a, b))
                    go = np.flatnonzero(~mask)
                    texts = [texts[i] for i in go.tolist()]
                    held.append((ids[own[go]], version[own[go]], place[go], np.ones_like(go), whole_keys(texts, buckets), texts))
                    size += sum(map(len, texts))
                    if size > FLUSH:
                        yield from flush(held)
                        held, size = [], 0
                o = np.flatnonzero(~split)
                ids_, start_, windows_ = ids[o], start[o], windows[o]
                texts = cut(o, start_, windows_)
                key = keys_of(m, texts, windows_, buckets)
                settled = np.zeros(len(o), bool)
                _, which, times = np.unique(key, return_inverse=True, return_counts=True)
                twice = np.flatnonzero(times[which] >= LOCAL)
                if len(twice):
                    mask = in_parts(m, [texts[i] for i in twice.tolist()], windows_[twice], ids_[twice], key[twice])
                    ends = np.cumsum(windows_[twice])
                    settled[twice] = np.add.reduceat(mask.astype(np.int64), ends - windows_[twice]) == windows_[twice]
                    s, a, b = spans_of(mask, windows_[twice], start_[twice], m.window)
                    found.append((o[twice[s]], a, b))
                own, a, b = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
                if len(own):
                    number += 1
                    yield (int(ids[own[0]]) + number) % buckets, SPANS, len(own), packed([ids[own], version[own], a.astype(np.int32), b.astype(np.int32)]), None
                go = np.flatnonzero(~settled)
                held.append((ids_[go], version[o[go]], start_[go], windows_[go], key[go], [texts[i] for i in go.tolist()]))
                size += sum(map(len, held[-1][5]))
                if size > FLUSH:
                    yield from flush(held)
                    held, size = [], 0
        if size:
            yield from flush(held)
    return lambda batches: in_batches(rows(batches))


def settle(m: Method, buckets: int):
    """applyInArrow over a bucket of bodies: the spans of its removed windows."""
    def run(table: pa.Table) -> pa.Table:
        out, metas, texts, bucket = [], [], [], 0
        for bucket, kind, n, meta, body in zip(*(table.column(c).to_pylist() for c in ("bucket", "kind", "n", "meta", "body"))):
            n, high = n & 0xFFFFFFFF, n >> 40
            cols = unpacked(meta, n, KINDS[kind])
            if kind == SPANS:
                out.append(cols)
                continue
            metas.append([np.cumsum(cols[0]), *cols[1:4]])
            size = cols[4].astype(np.int64) + (high << 16)
            raw, ends = zstandard.decompress(body), np.cumsum(size)
            texts += [raw[a:b] for a, b in zip((ends - size).tolist(), ends.tolist())]
        if metas:
            ids, version, start, windows = (np.concatenate(c) for c in zip(*metas))
            if bucket >= buckets:  # single windows
                gone = smaller_has(texts, ids)
                out.append([ids[gone], version[gone], start[gone], start[gone] + m.window])
                twice = ()
            else:
                key = keys_of(m, texts, windows.astype(np.int64), buckets)
                twice = np.flatnonzero(shared(key, ids))
            if len(twice):
                windows = windows[twice].astype(np.int64)
                mask = in_parts(m, [texts[i] for i in twice.tolist()], windows, ids[twice], key[twice])
                s, a, b = spans_of(mask, windows, start[twice].astype(np.int64), m.window)
                out.append([ids[twice][s], version[twice][s], a, b])
        cols = [np.concatenate(c).astype(np.int64) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
        return pa.table({"_id": cols[0], "_version": cols[1], "span": (cols[2] << 32) + cols[3]})
    return run


def with_spans(docs: DataFrame, m: Method, id_col: str, text_col: str) -> DataFrame:
    """Every input row as struct ``row`` plus ``_spans`` array<long: start * 2^32
    + end> (null: none). ``_version`` tells rows with the same id and different
    texts apart; it is 0 where all ids are unique."""
    rank = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    again = docs.groupBy(rank.alias("i")).count().where("count > 1").limit(1).count()
    version = F.xxhash64(text) if again else F.coalesce(F.pmod(rank, F.lit(1)), F.lit(0).cast("long"))  # a literal would drop out of the join keys; never null, or the joins' sides differ
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(64, -(-int(size) // BUCKET_BYTES))
    names = docs.select(rank.alias("_id"), version.alias("_version"), text.alias("text")).mapInArrow(named(m, buckets), BLOBS_DDL)
    # one entry for PART bytes of names at most; both sides read one exchange of the names
    too_large = F.broadcast(names.groupBy("bucket").applyInArrow(large, "_large long"))
    at = F.col("at") + F.when(F.col("_large").isNotNull(), MARK).otherwise(0)
    wanted = (names.groupBy("bucket").applyInArrow(met, "_id long, _version long, at long, key long")
              .join(too_large, F.col("key") == F.col("_large"), "left")
              .groupBy("_id", "_version").agg(F.collect_list(at).alias("segments")))
    # both joins read this side whole, so that one exchange of the texts serves both
    rows = docs.select(F.struct("*").alias("row"), rank.alias("_id"), version.alias("_version"))
    bodies = rows.join(wanted, ["_id", "_version"]).select("row", "_id", "_version", "segments").mapInArrow(cut_out(m, buckets, text_col), BLOBS_DDL)
    spans = (bodies.groupBy("bucket").applyInArrow(settle(m, buckets), "_id long, _version long, span long")
             .groupBy("_id", "_version").agg(F.collect_list("span").alias("_spans")))
    return rows.join(spans, ["_id", "_version"], "left").select("row", "_spans")


def applied(rows: DataFrame, text_col: str, fn: Callable, fields: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    """``row`` plus the columns ``fn(text bytes, spans or None)`` gives per row."""
    schema = T.StructType([rows.schema["row"], *(T.StructField(n, T._parse_datatype_string(t)) for n, t, _ in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, spans = batch.columns
            n = np.diff(np.asarray(spans.offsets))
            flat, ends = np.asarray(spans.flatten(), dtype=np.int64), np.cumsum(n)
            text = pc.fill_null(row.field(text_col).cast(pa.string()), "").cast(pa.binary())
            for at in range(0, batch.num_rows, 1024):
                some = [fn(t, flat[e - k:e] if k else None) for t, e, k in zip(text[at:at + 1024].to_pylist(), ends[at:at + 1024].tolist(), n[at:at + 1024].tolist())]
                yield pa.RecordBatch.from_arrays([row[at:at + 1024], *(pa.array(c, t) for c, (_, _, t) in zip(zip(*some), fields))],
                                                 names=["row", *(f[0] for f in fields)])
    return rows.mapInArrow(run, schema)


def unit_mask(spans: np.ndarray, total: int) -> np.ndarray:
    """Units inside any span (true: removed)."""
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, spans >> 32, 1)
    np.add.at(edge, spans & 0xFFFFFFFF, -1)
    return np.cumsum(edge[:-1]) > 0
