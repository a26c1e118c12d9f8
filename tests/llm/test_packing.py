"""op4: exact round trip, and the plan."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarry.llm import op4_packing
from quarry.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("table", ["odd", "nothing", "sample"])
def test_pieces_and_places(request, table, tokenizer):
    docs = request.getfixturevalue(table)
    got = op4_packing.pack(docs, tokenizer_path()).collect()
    want = Counter()
    for r in docs.collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for k, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a:a + 4096]
            want[(r["doc_id"], k, a, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for rows in places.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r["length"] for r in got)
    assert len(places) <= -(-total // 4096) + 2


def test_awkward_words(tokenizer):
    import pyarrow as pa
    from quarry.llm.common import words_of
    text = "A.B.. c, Don't! ?! x<|endoftext|>Y. <|ENDOFTEXT|> É. ÉÀ!! ÿ÷. 3. á. ΣΑΣ. !a a!b! İstanbul ŉ ﬁ① \x00a\x01 a\x1cb"
    encoder = op4_packing.WordEncoder(tokenizer_path())
    for _ in range(2):
        _, ids = encoder.encode(words_of(pa.array([text]))[1])
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_plan_uses_every_piece_and_fills_gaps():
    rng = np.random.default_rng(2)
    for lengths in (rng.integers(1, 100, 500), rng.integers(60, 101, 80), np.array([100, 50, 50, 30, 30, 40, 99, 99]), np.zeros(0, int)):
        counts = np.bincount(lengths, minlength=101)
        used = Counter()
        sequences = 0
        for times, need in op4_packing.plan(counts, 100):
            assert times > 0 and sum(n * m for n, m in need.items()) <= 100
            sequences += times
            for n, m in need.items():
                used[n] += times * m
        assert used == Counter({i: int(c) for i, c in enumerate(counts) if c})
    assert op4_packing.plan(np.bincount([60, 40, 70, 20, 10, 25, 25, 25, 25], minlength=101), 100) and sequences == 0


def test_exact_fill_prefers_single_then_pair_then_triple():
    left = np.zeros(101, int)
    left[[10, 20, 30, 5]] = 1
    assert op4_packing.exact_fill(30, left) == [30]
    assert op4_packing.exact_fill(50, left) == [30, 20]
    assert op4_packing.exact_fill(60, left) == [30, 20, 10]
    assert op4_packing.exact_fill(10, left) == [10] and op4_packing.exact_fill(9, left) is None
    assert op4_packing.exact_fill(40, left) == [30, 10] and op4_packing.exact_fill(20 + 20, np.where(np.arange(101) == 20, 1, 0)) is None
