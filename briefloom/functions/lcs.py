"""Longest common subsequence on bit vectors (Hyyro 2004), with Python integers."""

from __future__ import annotations

from collections import Counter
from math import isqrt

# Bits of the vectors of a pair that are held at once; longer pairs keep every k-th.
HELD_BITS = 1 << 27


def _places(a: list[str]) -> dict[str, int]:
    """Bit mask of the places of each item of ``a``."""
    where: dict[str, int] = {}
    for i, token in enumerate(a):
        where[token] = where.get(token, 0) | (1 << i)
    return where


def _step(vector: int, hit: int, full: int) -> int:
    """The bit vector after one more item; bit i is 0 where ``a[i]`` adds to the LCS."""
    hit &= vector
    return ((vector + hit) | (vector - hit)) & full


def lcs_length(a: list[str], b: list[str]) -> int:
    """Length of the LCS; only the last bit vector is held."""
    where, full = _places(a), (1 << len(a)) - 1
    vector = full
    for token in b:
        vector = _step(vector, where.get(token, 0), full)
    return (vector ^ full).bit_count()


def lcs_positions(a: list[str], b: list[str]) -> set[int]:
    """Positions of ``a`` on one LCS; ties go to the later items of ``a``'s partner.

    The path is followed from the end. Only every k-th bit vector is kept on the way there, k the
    root of the length of ``b``, and the vectors between are computed again when they are reached.
    """
    where, full = _places(a), (1 << len(a)) - 1
    k = isqrt(len(b)) + 1
    kept, vector = [full], full
    for j, token in enumerate(b, 1):
        vector = _step(vector, where.get(token, 0), full)
        if j % k == 0:
            kept.append(vector)
    i, j, found = len(a), len(b), set()
    first, block = len(b) + 1, []  # block[n] is the vector after first + n items of b
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            found.add(i)
            continue
        if j < first:
            first = j // k * k
            block = [kept[j // k]]
            for token in b[first:j]:
                block.append(_step(block[-1], where.get(token, 0), full))
        if block[j - first] >> (i - 1) & 1:
            i -= 1
        else:
            j -= 1
    return found


def covered_places(a: list[str], others: list[list[str]], held: int = HELD_BITS) -> int:
    """Bit mask of the positions that ``lcs_positions`` finds with any of ``others``.

    Items that ``a`` lacks leave the bit vector as it is, so only the rest are stepped through. On the way back a
    stretch of missing items, like a stretch without matches, is passed in one step to the next place that ends it.
    """
    where, full = _places(a), (1 << len(a)) - 1
    own, covered = where.keys(), 0
    for b in others:
        if own.isdisjoint(b):
            continue
        masks, gaps, vectors, vector, gap = [0], [False], [full], full, False
        hits = [where.get(token, 0) for token in b]
        if len(a) * sum(map(bool, hits)) > held:
            for place in lcs_positions(a, b):
                covered |= 1 << place
            continue
        for hit in hits:
            if hit:
                masks.append(hit)
                gaps.append(False)
                vector = _step(vector, hit, full)
                vectors.append(vector)
            else:
                gaps[-1] = True
        i, j = len(a), len(vectors) - 1
        while i and j:
            adding = full ^ vectors[j]
            if gaps[j]:
                i = (adding & ((1 << i) - 1)).bit_length()
            hit = masks[j]
            i = ((hit | adding) & ((1 << i) - 1)).bit_length()
            if i and hit >> (i - 1) & 1:
                i -= 1
                covered |= 1 << i
            j -= 1
    return covered


def union_lcs_hits(reference: list[list[str]], hypothesis: list[list[str]]) -> int:
    """Matched tokens over all sentences, each token used no more often than it occurs."""
    left_ref = Counter(token for part in reference for token in part)
    left_hyp = Counter(token for part in hypothesis for token in part)
    hits = 0
    for part in reference:
        covered = set()
        for other in hypothesis:
            covered |= lcs_positions(part, other)
        for i in sorted(covered):
            if left_ref[part[i]] > 0 and left_hyp[part[i]] > 0:
                hits += 1
                left_ref[part[i]] -= 1
                left_hyp[part[i]] -= 1
    return hits
