"""Suffix trees of short word sequences, held as tables.

The leaves of a tree are suffixes in sorted order; an inner node is the words
that a run of neighbouring leaves begins with: its depth (in words) and its
first and end leaf. Suffixes are ranked by doubled prefixes (1, 2, 4 .. words),
whose ranks also give the common prefix of two neighbours, longest block first."""

from __future__ import annotations

import numpy as np
import pandas as pd

from quarry.llm.common import runs


def dense_ranks(values: np.ndarray) -> np.ndarray:
    """Rank from 1 of each value among the distinct ones."""
    codes, distinct = pd.factorize(values)
    rank = np.empty(len(distinct), np.int64)
    rank[np.argsort(distinct)] = np.arange(1, len(distinct) + 1)
    return rank[codes]


def leaves(words: np.ndarray, counts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes that start at ``at`` and the common prefix of each
    with the next one. ``words`` are codes (0 or more) of sequences of ``counts``
    words, one after the other; a suffix ends with its sequence."""
    rest = np.repeat(np.cumsum(counts), counts) - np.arange(len(words))
    width, blocks = 1, [words + 1]
    while width < int(counts.max(initial=0)):
        after = np.zeros(len(words), np.int64)  # 0: past the end, before every word
        after[:-width] = blocks[-1][width:]
        after[rest <= width] = 0
        blocks.append(dense_ranks(blocks[-1] * (int(after.max()) + 1) + after))
        width *= 2
    order = np.argsort(blocks[-1][at], kind="stable")
    left, right = at[order][:-1], at[order][1:]
    room = np.minimum(rest[left], rest[right])
    common = np.zeros(len(left), np.int64)
    for block in reversed(blocks):
        fits = common + width <= room
        same = fits & (block[np.where(fits, left + common, 0)] == block[np.where(fits, right + common, 0)])
        common += width * same
        width //= 2
    return order, common


def inner_nodes(common: np.ndarray, least: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(depth, first leaf, end leaf) of the inner nodes of ``least`` words or
    more, by falling depth."""
    out = []
    for depth in np.unique(common[common >= least])[::-1].tolist():
        a, b = runs(common >= depth)
        here = np.concatenate(([0], np.cumsum(common == depth)))
        ends_here = here[b] > here[a]  # a run without it belongs to a deeper node alone
        out.append((depth, a[ends_here], b[ends_here] + 1))
    return out


def shared_with_smaller(ids: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """Per leaf, the depth of its deepest inner node that has a leaf of a smaller
    id; 0 where no node of ``least`` words or more has one."""
    out = np.zeros(len(ids), np.int64)
    under = np.zeros(len(ids), bool)  # leaves with a deep inner node above them; the others are out of the trees
    deep = common >= least
    under[:-1] |= deep
    under[1:] |= deep
    kept = np.flatnonzero(under)
    if not len(kept):
        return out
    ids, depth_of = ids[kept], np.zeros(len(kept), np.int64)
    common = np.where(np.diff(kept) == 1, common[kept[:-1]], 0)
    padded = np.append(ids, 0)
    for depth, first, end in inner_nodes(common, least):
        low = np.minimum.reduceat(padded, np.stack([first, end], axis=1).ravel())[::2]
        size = end - first
        leaf = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        open_ = leaf[(ids[leaf] > np.repeat(low, size)) & (depth_of[leaf] == 0)]
        depth_of[open_] = depth
    out[kept] = depth_of
    return out


def maximal_repeats(words: np.ndarray, counts: np.ndarray, least: int) -> list[tuple[int, np.ndarray]]:
    """(length, starts) of the repeats of ``least`` words or more that no word
    before or after all their places could extend: inner nodes whose leaves
    differ in the word before."""
    at = np.arange(len(words))
    order, common = leaves(words, counts, at)
    start = np.cumsum(counts) - counts
    before = np.concatenate(([-1], words[:-1]))
    before[start[counts > 0]] = -1 - np.arange(int((counts > 0).sum()))  # the beginning of a sequence is like no word
    out = []
    for depth, first, end in inner_nodes(common, least):
        for a, b in zip(first.tolist(), end.tolist()):
            places = order[a:b]
            if len(np.unique(before[places])) > 1:
                out.append((depth, np.sort(places)))
    return out
