"""op7 and op9 against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from quarry.llm import op7_simhash, op9_winnow

LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text):
    w = (text or "").encode().translate(LOW).split()
    grams = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    ones = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def components_of(fps, distance):
    parent = list(range(len(fps)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("table", ["odd", "nothing", "sample"])
def test_near_duplicates_match_brute_force(request, table):
    docs = request.getfixturevalue(table)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    fps = [fingerprint(t) for _, t in rows]
    roots = components_of(fps, 4)
    names = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            names[r] = min(names.get(r, i), i)
    want = sorted(str((i, f"{f:016x}", names.get(r))) for (i, _), f, r in zip(rows, fps, roots))
    got = op7_simhash.near_duplicates(docs).collect()
    assert sorted(str((r["doc_id"], r["fingerprint"], r["component_id"])) for r in got) == want


@pytest.mark.parametrize("segments", [2, 3])
def test_links_over_chains_hubs_and_blocks(spark, segments):
    random.seed(segments)
    base = [random.getrandbits(64) for _ in range(6)]
    fps = set(base) | {0, (1 << 64) - 1}
    for b in base[:2]:  # chains: each at most 4 bits from the one before
        x = b
        for _ in range(40):
            for bit in random.sample(range(64), 4):
                x ^= 1 << bit
            fps.add(x)
    for _ in range(150):  # a dense cloud around one fingerprint
        fps.add(base[3] ^ sum(1 << bit for bit in random.sample(range(64), random.randint(1, 3))))
    fps = sorted(fps)
    rows = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long").repartition(4)
    roots = op7_simhash.components(op7_simhash.links(rows, 4, segments, block=16)).collect()
    root = {r["node"]: r["root"] for r in roots}
    want = components_of(fps, 4)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    got = [root.get(s, s) for s in signed]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_one_of_each_keeps_columns_and_one_row(odd):
    out = op7_simhash.one_of_each(odd)
    assert out.columns == odd.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
    assert 1 in ids and 9 not in ids and 4 not in ids and 3 in ids  # 9 is 1 in capitals; 4 and 5 are empty like 3


WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contaminated(docs, items):
    windows = {}
    for i, t in items:
        w = WORD.findall((t or "").encode().translate(LOW))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for i, t in docs:
        w = WORD.findall((t or "").encode().translate(LOW))
        hit, names = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    names |= {str(x) for x in found if x is not None}
        out.append(str((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(),
                        bool(hit) and 20 * len(hit) >= len(w))))
    return sorted(out)


ITEMS = [(1, "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "dolor sit"), (2, "dolor sit"),
         (3, None), (4, "..."), (None, "amet lorem"), (5, "x one two three four five six seven eight nine ten eleven twelve"), (6, "12345")]


def digest(df):
    return sorted(str((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])) for r in df.collect())


@pytest.mark.parametrize("table", ["odd", "nothing"])
def test_contamination_matches_brute_force(spark, request, table):
    docs = request.getfixturevalue(table)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert digest(op9_winnow.decontaminate(docs, bench)) == contaminated(rows, ITEMS)
    assert digest(op9_winnow.decontaminate(docs, bench.limit(0))) == contaminated(rows, [])


def test_contamination_by_the_shuffle_join(spark, sample, monkeypatch):
    monkeypatch.setattr(op9_winnow, "SMALL_HASHES", 1)
    monkeypatch.setattr(op9_winnow, "SMALL_WINDOWS", 1)
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = contaminated([(r["doc_id"], r["text"]) for r in sample.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    assert digest(op9_winnow.decontaminate(sample, bench)) == want


def test_every_long_enough_span_shares_a_kept_hash(spark):
    random.seed(3)
    rows = []
    for k in range(60):
        span = [f"s{random.randint(0, 30)}" for _ in range(13)]
        for side in (0, 1):
            around = [f"{'ab'[side]}{random.randint(0, 10**9)}" for _ in range(20)]
            at = random.randint(0, 20)
            rows.append((k, side, around[:at] + span + around[at:]))
    kept = op9_winnow.with_kept(spark.createDataFrame(rows, "k int, side int, words array<string>")).collect()
    by = {(r["k"], r["side"]): set(r["kept"]) for r in kept}
    assert all(by[(k, 0)] & by[(k, 1)] for k in range(60))


def test_without_contaminated(spark, odd):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = op9_winnow.without_contaminated(odd, bench)
    bad = [r for r in op9_winnow.decontaminate(odd, bench).collect() if r["contaminated"]]
    assert out.columns == odd.columns and out.count() == odd.count() - len(bad) and bad


def test_fingerprints_count_bits_in_blocks(monkeypatch):
    import tracemalloc
    r = random.Random(5)
    texts = pa.array([" ".join(f"w{r.randrange(9999)}" for _ in range(n)) for n in (0, 1, 3, 4, 5, 40, 0, 200_000, 7)])
    counts, flat = op7_simhash.words_of(texts, lower=True)
    tracemalloc.start()
    got = op7_simhash.simhash(counts, flat, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20  # 64 counters a shingle would take 100 MiB
    monkeypatch.setattr(op7_simhash, "GRAMS", 5)
    small = pa.array([t.as_py() for t in texts if len(t.as_py()) < 2000])
    few = op7_simhash.simhash(*op7_simhash.words_of(small, lower=True), 4)
    assert few.tolist() == [f for f, t in zip(got.tolist(), texts) if len(t.as_py()) < 2000]
