"""op11: against the tokenizers library, and the merge rounds against merging one pair at a time."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quarry.llm import op11_bpe, queries

PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.mark.parametrize("table", ["odd", "nothing", "sample"])
def test_ids_and_texts(request, spark, table, library):
    docs = request.getfixturevalue(table)
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want[(r["doc_id"], tuple(ids), library.decode(ids, skip_special_tokens=False))] += 1
    encoded = op11_bpe.encode(docs, PATH, decoded=True)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in encoded.collect()) == want
    again = op11_bpe.decode(op11_bpe.encode(docs, PATH), PATH)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in again.collect()) == want


def test_awkward_texts(library):
    texts = ["Don't I'LL it's 'tis x'", "A.B.. c,  ?! 12 3x4", "x<|endoftext|>Y <|ENDOFTEXT|> <|startoftext|><|endoftext|>", "<|endoftext|≯", "J̌ ́x ≠",
             "İstanbul ΑΣ. ŉ ﬁ① ½ Ⅷ", "\x00a\x01 a\x1cb\x1f", "a\xa0b　c d\x85e", "漢字かな交じり文が続くと一つの長い語になる", "-" * 999, "a" * 1000 + "!" * 7, "ab" * 500,
             "😀👍🏽 ‍﻿", "</w> a</w>", "".join(map(chr, range(1, 0x250))), "the " * 50, "", None]
    codec = op11_bpe.Codec(PATH)
    for _ in range(2):
        ids, sizes = codec.encode(pa.array(texts))
        at = np.append(0, np.cumsum(sizes))
        for k, t in enumerate(texts):
            assert ids[at[k]:at[k + 1]].tolist() == library.encode(t or "", add_special_tokens=False).ids, repr(t)
        want = [library.decode(ids[a:b].tolist(), skip_special_tokens=False) for a, b in zip(at, at[1:])]
        assert codec.decode(ids, at).to_pylist() == want


def one_at_a_time(symbols, ranks, joined):
    """Lowest rank first, leftmost first."""
    symbols = list(symbols)
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not found:
            return symbols
        rank, i = min(found)
        symbols[i:i + 2] = [joined[rank]]


@pytest.mark.parametrize("shuffled", [False, True])
def test_rounds_equal_single_merges(shuffled):
    rng = np.random.default_rng(4)
    for _ in range(30):
        size, merges, seen = 4, [], set()
        while len(merges) < 40:
            pair = tuple(int(x) for x in rng.integers(0, size, 2))
            if pair not in seen:
                seen.add(pair)
                merges.append((*pair, size))
                size += 1
        if shuffled:  # a joined symbol may then open a pair of a lower rank
            rng.shuffle(merges)
        table = op11_bpe.MergeRounds(np.array(merges), size)
        assert table.ordered or shuffled
        words = [rng.integers(0, 4, rng.integers(1, 40)) for _ in range(20)] + [np.zeros(33, np.int64)]
        ids, sizes = table.merge(np.concatenate(words), np.array([len(w) for w in words]))
        ranks, joined = {tuple(m[:2]): k for k, m in enumerate(merges)}, [m[2] for m in merges]
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [one_at_a_time(w.tolist(), ranks, joined) for w in words]


def test_decode_leaves_unknown_ids_out(spark, library):
    rows = spark.createDataFrame([(1, [320, 10 ** 6, -1, None, 321], "x"), (2, None, "y"), (3, [], "z")], "k int, ids array<int>, decoded string")
    assert {r["k"]: r["decoded"] for r in op11_bpe.decode(rows, PATH).collect()} == {1: library.decode([320, 321]), 2: None, 3: ""}


def test_query_digests(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.QUERIES["op11_bpe"](spark, "/root/testdata/sf0.001").collect()}
    for r in docs:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        assert got[r["doc_id"]] == (len(ids), *sha)
