"""op13: against both libraries on whole texts and a plain alignment."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from quarry.llm import op13_align, queries

A, B = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")
AWKWARD = ["a", " ", "  ", "a  b   c ", "\n", "\n\n a\n  b\n", " \n x", "a\tb\r\nc\x0b\x0cd", "foo\n bar\n  baz.\nQux", "x<|endoftext|> <s> </s> <unk> <0x0A>",
           "a▁b", "café naïve ﬁ ① ½", "a\xa0b c 　 d  e f \x85 g", "漢字かな 混じり \U0001F600\U0001F44D\U0001F3FD ‍﻿ x",
           "don't I'LL it's '90s  's", "12345 1234 12 3x4", "\x00 \x1c\x1d a\x1f \x7f b", "-" * 300 + " " * 200 + "=" * 77, "ab" * 300, "", None, " lead", "trail ", "trail \n", "A" * 50]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    a.no_truncation()
    b = SentencePieceProcessor(model_file=B)
    raw = {c: i for i, c in enumerate(op13_align.byte_letters())}

    def both(text):
        """((id, bytes) of A, (id, bytes) of B), or nothing where either differs."""
        if not text:
            return [], []
        x = [(i, bytes(raw[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            y.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        want = (" " + text).encode()
        return (x, y) if b"".join(t for _, t in x) == want == b"".join(t for _, t in y) else ([], [])
    return both


def plain(x, y):
    """(groups as text, links) by walking both sides."""
    def ends(tokens):
        at, out = 0, []
        for i, t in tokens:
            at += len(t)
            out.append((at, i))
        return out
    x, y = ends(x), ends(y)
    common = sorted({e for e, _ in x} & {e for e, _ in y})
    groups, low = [], 0
    for e in common:
        groups.append(tuple(",".join(str(i) for end, i in side if low < end <= e) for side in (x, y)))
        low = e
    links = [(i, j) for e, i in x for f, j in y if e == f]
    return ";".join("|".join(g) for g in groups), len(groups), links


def expected(texts, libraries):
    made = [(x, y, *plain(x, y)) for x, y in map(libraries, texts)]
    counts = Counter(p for m in made for p in m[4])
    most = defaultdict(int)
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [(len(x), len(y), k, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(text.encode()).hexdigest() if x else "") for x, y, text, k, links in made]


def answers(docs):
    return Counter(tuple(r) for r in queries.aligned(docs).collect())


def test_segments_encode_like_whole_texts(libraries):
    aligner = op13_align.Aligner(A, B)
    for _ in range(2):
        counts, shown, links = aligner.align(pa.array(AWKWARD))
        at = 0
        for k, text in enumerate(AWKWARD):
            x, y = libraries(text)
            want, groups, pairs = plain(x, y)
            assert (counts[k].tolist(), shown[k].as_py()) == ([len(x), len(y), groups, len(pairs)], want), repr(text)
            assert [tuple(p) for p in links[at:at + len(pairs)].tolist()] == pairs
            at += len(pairs)


def test_coalesce_expands_overlaps():
    rng = np.random.default_rng(3)
    for _ in range(50):
        total = int(rng.integers(1, 60))
        a, b = (np.diff(np.unique(np.concatenate(([0, total], rng.integers(0, total, 8))))) for _ in range(2))
        ga, gb, i, j = op13_align.coalesce(a, b)
        ea, eb = np.cumsum(a), np.cumsum(b)
        common = sorted(set(ea) & set(eb))
        assert ga.tolist() == [sum(c < e for c in common) for e in ea] and gb.tolist() == [sum(c < e for c in common) for e in eb]
        want = [(x, y) for x in range(len(a)) for y in range(len(b)) if ea[x] - a[x] < eb[y] and eb[y] - b[y] < ea[x]]
        assert sorted(zip(i.tolist(), j.tolist())) == want


@pytest.mark.parametrize("table", ["odd", "nothing"])
def test_odd_tables(request, libraries, table):
    docs = request.getfixturevalue(table)
    rows = docs.collect()
    want = Counter((r["doc_id"], *e) for r, e in zip(rows, expected([r["text"] for r in rows], libraries)))
    assert answers(docs) == want


@pytest.mark.parametrize("pairs", [op13_align.PAIRS, 700])
def test_counts_over_the_corpus(spark, sample, libraries, monkeypatch, pairs):
    """Also with the table of pairs held in several passes."""
    monkeypatch.setattr(op13_align, "PAIRS", pairs)
    docs = sample.where("n_chars < 2500").limit(60)
    rows = docs.collect()
    docs = spark.createDataFrame(rows, docs.schema).repartition(3)
    want = Counter((r["doc_id"], *e) for r, e in zip(rows, expected([r["text"] for r in rows], libraries)))
    assert answers(docs) == want
