"""Self-join of 64-bit codes within a small Hamming distance by walking a binary trie against itself.

The codes are sorted, so a trie node is a range of them and its children meet at one
searchsorted position. Node pairs are taken together, all pairs of a level at once: the
bits in which their paths differ are counted, and a pair beyond the budget is dropped with
everything below it. Small pairs are compared code by code.
"""

from __future__ import annotations

import numpy as np

#: Node pairs of at most this many code pairs are compared directly.
LEAF_PAIRS = 64
#: Node pairs walked or code pairs compared at once.
FRONTIER = 1 << 16


def _expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts c: the index of each of sum(c) entries, and its number within the index."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def self_join(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, budget: int):
    """Yield (i, j) arrays of positions i < j within one group, their codes at most ``budget`` bits apart.

    ``codes`` (uint64) are ascending and distinct within each group [starts, ends).
    """
    big = ends - starts >= 2
    stack = [(starts[big], ends[big], starts[big], ends[big], np.zeros(big.sum(), np.int64), 63)]
    while stack:
        a0, a1, b0, b1, err, bit = stack.pop()
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            stack += [tuple(x[s] for x in (a0, a1, b0, b1, err)) + (bit,) for s in (slice(half, None), slice(None, half))]
            continue
        work = (a1 - a0) * (b1 - b0)
        leaf = (work <= LEAF_PAIRS) | (bit < 0)
        if leaf.any():
            yield from _compare(codes, a0[leaf], a1[leaf], b0[leaf], b1[leaf], budget)
        a0, a1, b0, b1, err = (x[~leaf] for x in (a0, a1, b0, b1, err))
        if not len(a0):
            continue
        am, bm = _middle(codes, a0, a1, bit), _middle(codes, b0, b1, bit)
        same = (a0 == b0) & (a1 == b1)
        nxt = []
        for x0, x1, y0, y1, cost, keep in (
            (a0, am, b0, bm, 0, None),
            (am, a1, bm, b1, 0, None),
            (a0, am, bm, b1, 1, None),
            (am, a1, b0, bm, 1, ~same),  # a node with itself: its two children meet once
        ):
            ok = (x0 < x1) & (y0 < y1) & (err + cost <= budget)
            if keep is not None:
                ok &= keep
            ok &= ~((x0 == y0) & (x1 == y1) & (x1 - x0 < 2))
            nxt.append((x0[ok], x1[ok], y0[ok], y1[ok], err[ok] + cost))
        merged = tuple(np.concatenate(p) for p in zip(*nxt))
        if len(merged[0]):
            stack.append((*merged, bit - 1))


def _middle(codes: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """First position of each range whose code has ``bit`` set; codes of a range agree above it."""
    lo, hi = lo.copy(), hi.copy()
    mask = np.uint64(1 << bit)
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        one = np.zeros(len(lo), bool)
        one[open_] = (codes[mid[open_]] & mask) != 0
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)
    return lo


def _compare(codes, a0, a1, b0, b1, budget):
    work = (a1 - a0) * (b1 - b0)
    total = np.cumsum(work)
    at = 0
    while at < len(work):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + FRONTIER, "right")))
        s = slice(at, end)
        owner, k = _expand(work[s])
        width = (b1 - b0)[s][owner]
        i, j = a0[s][owner] + k // width, b0[s][owner] + k % width
        ok = i < j
        i, j = i[ok], j[ok]
        near = np.bitwise_count(codes[i] ^ codes[j]) <= budget
        if near.any():
            yield i[near], j[near]
        at = end
