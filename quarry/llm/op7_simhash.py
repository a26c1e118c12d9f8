"""SimHash near-dedup by multi-index hashing.

A 64-bit fingerprint is cut into ``segments`` parts with one table each. Two
fingerprints within ``distance`` bits agree up to ``distance // segments`` bits
in some part, so each fingerprint looks up the small Hamming ball around each
of its parts, and what meets in a table is verified on all 64 bits. Equal
fingerprints are one node; a table entry with very many of them is split into
blocks whose pairs are separate tasks, and a task reports one spanning star per
connected set, not its pairs."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import NO_ID, id_text, per_slice, text_version, words_of, written

SHINGLE = 4
SEED = 42
DISTANCE = 4
SEGMENTS = 3
BLOCK = 2048
#: Shingles whose bits are counted at once.
GRAMS = 1 << 14


def simhash(counts: np.ndarray, flat: pa.Array, shingle: int) -> np.ndarray:
    """Fingerprint of each document: bits set in over half of the hashes of its
    word shingles (repeats included); 0 without words."""
    words = flat.cast(pa.binary()).to_pylist()
    data = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    first = np.cumsum(counts) - counts
    grams = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    base = np.cumsum(grams) - grams
    at = np.repeat(first - base, grams) + np.arange(int(grams.sum()))
    last = at + np.repeat(np.minimum(counts, shingle), grams) - 1
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(counts), np.uint64)
    has = np.flatnonzero(grams)
    first = base[has]
    ones = np.zeros((len(has), 64), np.int64)
    for low in range(0, len(at), GRAMS):  # a block's bits take 64 counters each
        a, b = starts[at[low:low + GRAMS]].tolist(), ends[last[low:low + GRAMS]].tolist()
        hashes = np.fromiter((digest(data[i:j], SEED) for i, j in zip(a, b)), np.uint64, len(a))
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64)
        lo, hi = np.searchsorted(first, low, side="right") - 1, np.searchsorted(first, low + len(a), side="left")
        ones[lo:hi] += np.add.reduceat(bits, np.maximum(first[lo:hi] - low, 0), axis=0, dtype=np.int64)
    if len(has):
        out[has] = np.packbits(2 * ones > grams[has, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ``version`` (hash of the text) and ``fp`` (the 64 bits as a signed
    long) of every row."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = simhash(*words_of(batch.column(1), lower=True), shingle)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fp.view(np.int64))], names=["doc_id", "version", "fp"])
    return (id_text(docs, id_col, text_col).withColumn("version", text_version("text"))
            .mapInArrow(per_slice(run), "doc_id long, version long, fp long"))


def entries(fp: np.ndarray, distance: int, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(table key, row of ``fp``, looked up) for every table entry and look-up.
    Of two parts that differ the larger value looks up the smaller, so a ball
    needs only its members below the centre."""
    keys, rows, looked = [], [], []
    low = 0
    for s in range(segments):
        bits = (64 - low) // (segments - s)
        part = (fp >> np.uint64(low)) & np.uint64((1 << bits) - 1)
        low += bits
        keys.append(part)
        rows.append(np.arange(len(fp)))
        looked.append(np.zeros(len(fp), bool))
        for radius in range(1, distance // segments + 1):
            for flips in combinations(range(bits), radius):
                near = part ^ np.uint64(sum(1 << f for f in flips))
                below = np.flatnonzero(near < part)
                keys.append(near[below])
                rows.append(below)
                looked.append(np.ones(len(below), bool))
        for k in range(len(keys)):
            if keys[k].dtype == np.uint64:
                keys[k] = keys[k].astype(np.int64) * segments + s
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(looked)


def join_sets(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the sets of a and b in a fully compressed parent array."""
    while True:
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def stars(group: np.ndarray, fp: np.ndarray, looked: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, root) of the sets linked inside each run of equal ``group``."""
    parent = np.arange(len(fp))
    at, step = np.arange(len(fp)), 0
    while True:
        step += 1
        at = at[at + step < len(fp)]
        at = at[group[at] == group[at + step]]
        if not len(at):
            break
        near = at[(np.bitwise_count(fp[at] ^ fp[at + step]) <= distance) & ~(looked[at] & looked[at + step])]
        if len(near):
            parent = join_sets(parent, near, near + step)
    member = np.flatnonzero(parent != np.arange(len(fp)))
    member = member[fp[member] != fp[parent[member]]]
    return fp[member], fp[parent[member]]


def links(fps: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """Edges (u > v) whose connected sets are those of all pairs of different
    fingerprints (column ``fp``) within ``distance`` bits."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                fp = np.asarray(b.column(0)[i:i + 4096], dtype=np.int64)
                key, row, looked = entries(fp.view(np.uint64), distance, segments)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row]), pa.array(looked)], names=["key", "fp", "looked"])
    rows = fps.select("fp").mapInArrow(spread, "key long, fp long, looked boolean")
    heavy = written(rows.groupBy("key").count().where(F.col("count") > block)
                    .select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (rows.join(heavy, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .select("key", "fp", "looked", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp", "looked"))
    met = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def edges(cols: list[np.ndarray], group: np.ndarray) -> pa.RecordBatch:
            u, v = stars(group, cols[3].view(np.uint64), cols[4], distance)
            u, v = u.view(np.int64), v.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])
        for b in batches:
            cols = [np.asarray(c) for c in b.columns]
            if held is not None:
                cols = [np.concatenate(c) for c in zip(held, cols)]
            new = np.zeros(len(cols[0]), bool)
            new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
            cut = np.flatnonzero(new)
            if not len(cut):
                held = cols
                continue
            whole = cut[-1]
            yield edges([c[:whole] for c in cols], np.cumsum(new)[:whole])
            held = [c[whole:] for c in cols]
        if held is not None:
            yield edges(held, np.zeros(len(held[0]), np.int64))
    return met.mapInArrow(find, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u > v), root the smallest node
    it is connected with. Alternates large and small stars until nothing
    changes; each step is one aggregate and one equi-join."""
    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    e = written(edges)
    seen = state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        e = written(joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = state(e)
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, segments: int = SEGMENTS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ``version`` (hash of the text), ``fingerprint`` (16 hex digits)
    and ``component_id`` of every row: the smallest id among all rows reachable over fingerprints at most
    ``distance`` bits apart. A null or wordless text has fingerprint 0, linked
    like any other. Rows without an id are linked, but never name a component
    (null if no row of it has an id). Repeated rows give repeated results."""
    rows = written(fingerprints(docs, shingle, id_col, text_col))
    nodes = written(rows.groupBy("fp").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("first")))
    roots = components(links(nodes, distance, segments))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(names, "root").select("fp", F.expr(f"nullif(component_id, {NO_ID})").alias("component_id"))
    return rows.join(named, "fp").select("doc_id", "version", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows, all columns unchanged, that stand for their component: the one
    with the component's id (with several texts under that id: one of them; of
    repeated rows: one). Rows without an id stay only where their whole
    component has none, one per text."""
    found = written(near_duplicates(docs, id_col=id_col, text_col=text_col, **options))
    chosen = (found.where("doc_id = component_id").groupBy("doc_id").agg(F.min("version").alias("version"))
              .unionByName(found.where("doc_id is null and component_id is null").select("doc_id", "version").distinct())
              .select(F.col("doc_id").alias("_id"), F.col("version").alias("_version")))
    again = found.groupBy("doc_id", "version").count().where("count > 1").limit(1).count()
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), text_version(text_col).alias("version"))
    kept = rows.join(chosen, F.col("id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version")), "left_semi")
    return (kept.dropDuplicates(["id", "version"]) if again else kept).select("row.*")
