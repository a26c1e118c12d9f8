"""op1 and op3 against brute force, the run-length index against brute force."""

import random
from dataclasses import replace

import numpy as np
import pytest

from quarry.llm import op1_substrings, op3_runs, segments, suffix_tree
from quarry.llm.common import gram_names, runs


def brute(rows, units, width):
    """{(id, text): (n, removed, kept units)}; windows of a smaller id remove."""
    far = 1 << 63
    first = {}
    for i, t in rows:
        u = units(t)
        for k in range(len(u) - width + 1):
            g = tuple(u[k:k + width])
            first[g] = min(first.get(g, far), far if i is None else i)
    out = {}
    for i, t in rows:
        u = units(t)
        gone = [False] * len(u)
        for k in range(len(u) - width + 1):
            if first[tuple(u[k:k + width])] < (far if i is None else i):
                gone[k:k + width] = [True] * width
        out[(i, t)] = (len(u), sum(gone), [x for x, g in zip(u, gone) if not g])
    return out


def word_list(t):
    return (t or "").encode().split()


@pytest.mark.parametrize("table", ["odd", "nothing", "sample"])
def test_words_match_brute_force(request, table):
    docs = request.getfixturevalue(table)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute(rows, word_list, 13)
    got = op1_substrings.remove_repeated(docs).collect()
    assert sorted(map(str, rows)) == sorted(str((r["row"]["doc_id"], r["row"]["text"])) for r in got)
    for r in got:
        n, removed, kept = want[(r["row"]["doc_id"], r["row"]["text"])]
        assert (r["n_words"], r["n_removed"], r["kept"].encode()) == (n, removed, b" ".join(kept))


@pytest.mark.parametrize("table", ["odd", "nothing", "sample"])
def test_bytes_match_brute_force(request, table):
    docs = request.getfixturevalue(table)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute(rows, lambda t: (t or "").encode(), 50)
    got = op3_runs.remove_repeated(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        n, removed, kept = want[(r["row"]["doc_id"], r["row"]["text"])]
        assert (r["n_bytes"], r["n_removed"], bytes(r["kept"])) == (n, removed, bytes(kept))


def test_cleaned_keeps_the_columns(odd):
    out = op1_substrings.cleaned(odd)
    assert out.dtypes == odd.dtypes and out.count() == odd.count()
    rows = {(r["doc_id"], r["source"]): r for r in out.collect()}
    assert rows[(2, "b")]["text"] == "x y" and rows[(2, "b")]["n_chars"] == 3
    assert rows[(3, None)]["text"] is None and rows[(1, "a")]["row"] == "r"


def test_run_length_index_streams_matching_statistics():
    random.seed(5)
    for _ in range(120):
        width = random.choice([8, 10, 14, 15, 20, 28, 29, 50])
        letters = random.choice([b"ab", b"abc\x00\xff", b"a"])
        base = bytes(random.choices(letters, k=120))
        texts = [base[(a := random.randint(0, 60)):a + random.randint(1, 60)] if random.random() < 0.6
                 else bytes(random.choices(letters, k=random.randint(0, 60))) for _ in range(random.randint(1, 6))]
        texts = list(dict.fromkeys(texts))
        labels = np.array([random.randint(0, 9) for _ in texts])
        queries = [*texts, bytes(random.choices(letters, k=40)), base[5:90] + b"zz" + base[:40]]
        lengths, least = op3_runs.RunLengthIndex(texts, labels, width).matches(queries)
        for q, got, label in zip(queries, lengths, least):
            for i in range(len(q)):
                k = 0
                while k < width and i + k < len(q) and any(q[i:i + k + 1] in t for t in texts):
                    k += 1
                assert got[i] == k
                full = [x for t, x in zip(texts, labels) if len(q) - i >= width and q[i:i + width] in t]
                assert label[i] == min(full, default=np.iinfo(np.int64).max)


def test_parts_and_cuts_do_not_change_the_result(monkeypatch, sample):
    want = {r["row"]["doc_id"]: (r["n_removed"], r["kept"]) for r in op3_runs.remove_repeated(sample).collect()}
    monkeypatch.setattr(segments, "PART", 300)
    monkeypatch.setattr(segments, "LOCAL", 2)
    monkeypatch.setattr(segments, "SLICE", 20_000)
    got = {r["row"]["doc_id"]: (r["n_removed"], r["kept"]) for r in op3_runs.remove_repeated(sample.repartition(7)).collect()}
    assert got == want


@pytest.mark.parametrize("method,phrase,units,width", [(op3_runs.BYTES, " which that table by phrase very ", lambda t: t.encode(), 50),
                                                       (op1_substrings.WORDS, " these dozen words are in every row of the whole table too ", word_list, 13)])
def test_a_phrase_in_most_rows_is_not_resolved_as_one_group(spark, method, phrase, units, width):
    rng = random.Random(3)

    def word():
        return "".join(rng.choices("abcdefghij", k=6))
    rows = [(i, phrase.join(" ".join(word() for _ in range(4)) for _ in range(4))) for i in range(15_000)]
    rows += [(15_000 + i, "x " + rows[i * 7][1][10:]) for i in range(300)]  # repeats over the phrase
    whole, most = method.resolve, 2 * segments.PART

    def resolve(texts, windows, ids):
        assert sum(map(len, texts)) <= most
        return whole(texts, windows, ids)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["row"]["doc_id"]: r["_spans"] or [] for r in segments.with_spans(docs, replace(method, resolve=resolve), "doc_id", "text").collect()}
    want = brute(rows, units, width)
    for i, t in rows:
        n, removed, _ = want[(i, t)]
        assert int(segments.unit_mask(np.array(got[i], np.int64), n).sum()) == removed
    assert sum(removed for _, removed, _ in want.values()) > 300


def test_gram_names_are_exact():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 8, 13):
        codes = rng.integers(0, 2, 200)
        names = gram_names(codes, n)
        grams = [tuple(codes[i:i + n]) for i in range(len(codes) - n + 1)]
        assert len(names) == len(grams) and len(set(zip(names, grams))) == len(set(grams)) == len(set(names))


def test_runs():
    a, b = runs(np.array([True, True, False, True]))
    assert a.tolist() == [0, 3] and b.tolist() == [2, 4]


def test_windows_that_occur_again():
    """Windows of small alphabets, equal texts and single windows against a dictionary of all windows."""
    import random

    import numpy as np
    from quarry.llm import op3_runs
    r = random.Random(0)
    for _ in range(40):
        base = ["".join(r.choices("ab ", k=r.randint(60, 300))) for _ in range(4)]
        texts = []
        for _ in range(r.randint(1, 25)):
            b = r.choice(base)
            a = r.randint(0, len(b) - 55)
            ends = ["".join(r.choices("abc", k=r.choice([0, 5, 80]))) for _ in range(2)]
            texts.append((ends[0] + b[a:a + r.randint(50, 300)] + ends[1]).encode())
        texts = [t for t in texts if len(t) >= 50] or [b"x" * 50]
        ids, windows = np.array([r.randint(0, 9) for _ in texts]), np.array([len(t) - 49 for t in texts])
        every = [t[k:k + 50] for t in texts for k in range(len(t) - 49)]
        least, often = {}, {}
        for w, i in zip(every, np.repeat(ids, windows).tolist()):
            least[w], often[w] = min(least.get(w, 99), i), often.get(w, 0) + 1
        again = op3_runs.occur_again(texts, windows)
        assert all(again[k] for k, w in enumerate(every) if often[w] > 1)
        assert op3_runs.smaller_has_window(texts, windows, ids).tolist() == [i > least[w] for w, i in zip(every, np.repeat(ids, windows).tolist())]


def word_sequences(seed, letters, longest):
    rng = random.Random(seed)
    return [[rng.randrange(letters) for _ in range(rng.randint(0, longest))] for _ in range(rng.randint(1, 12))]


@pytest.mark.parametrize("seed, letters, longest", [(s, k, n) for s in range(12) for k, n in ((1, 20), (2, 30), (5, 44))])
def test_suffix_tree_leaves_and_inner_nodes(seed, letters, longest):
    seqs = word_sequences(seed, letters, longest)
    counts = np.array([len(s) for s in seqs])
    words = np.array([w for s in seqs for w in s], dtype=np.int64)
    suffixes = [tuple(s[k:]) for s in seqs for k in range(len(s))]
    order, common = suffix_tree.leaves(words, counts, np.arange(len(words)))
    in_order = [suffixes[i] for i in order]
    assert in_order == sorted(suffixes)

    def shared(a, b):
        return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert common.tolist() == [shared(a, b) for a, b in zip(in_order, in_order[1:])]
    # an inner node: words that at least two suffixes begin with and not all of these go on with alike
    nodes = {(d, in_order[a][:d], b - a) for d, first, end in suffix_tree.inner_nodes(common, 2) for a, b in zip(first.tolist(), end.tolist())}
    want = set()
    for x in {s[:d] for s in suffixes for d in range(2, len(s) + 1)}:
        have = [s for s in suffixes if s[:len(x)] == x]
        if len(have) > 1 and len({s[len(x)] if len(s) > len(x) else ("end", i) for i, s in enumerate(have)}) > 1:
            want.add((len(x), x, len(have)))
    assert nodes == want


@pytest.mark.parametrize("seed", range(12))
def test_suffix_tree_depths_and_maximal_repeats(seed):
    seqs = word_sequences(seed, 3, 40)
    counts = np.array([len(s) for s in seqs])
    words = np.array([w for s in seqs for w in s], dtype=np.int64)
    places = [(i, k) for i, s in enumerate(seqs) for k in range(len(s))]
    order, common = suffix_tree.leaves(words, counts, np.arange(len(words)))
    ids = np.array([i % 4 for i, _ in places], dtype=np.int64)
    got = np.zeros(len(words), np.int64)
    got[order] = suffix_tree.shared_with_smaller(ids[order], common, 4)

    def depth(p, q):
        (i, a), (j, b) = places[p], places[q]
        x, y = seqs[i][a:], seqs[j][b:]
        return next((k for k, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))
    for p in range(len(words)):
        best = max([depth(p, q) for q in range(len(words)) if ids[q] < ids[p]], default=0)
        assert got[p] == (best if best >= 4 else 0)
    # maximal: no longer common string on either side
    found = {(n, tuple(at.tolist())) for n, at in suffix_tree.maximal_repeats(words, counts, 4)}
    where = {}
    for p, (i, k) in enumerate(places):
        for n in range(4, len(seqs[i]) - k + 1):
            where.setdefault(tuple(seqs[i][k:k + n]), []).append(p)
    want = set()
    for x, at in where.items():
        left = {seqs[places[p][0]][places[p][1] - 1] if places[p][1] else ("begin", p) for p in at}
        right = {seqs[places[p][0]][places[p][1] + len(x)] if places[p][1] + len(x) < len(seqs[places[p][0]]) else ("end", p) for p in at}
        if len(at) > 1 and len(left) > 1 and len(right) > 1:
            want.add((len(x), tuple(at)))
    assert found == want
