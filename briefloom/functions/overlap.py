"""Shared n-grams of two token lists per row, for a whole Arrow batch at a time.

Tokens become integer codes, an n-gram becomes one code, and (row, code) pairs are
counted with array operations; no Python code runs per row or per token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Working arrays are some tens of times the size of the tokens' codes that they cover.
TOKENS_PER_STEP = 200_000


def steps(sizes: np.ndarray, most: int = TOKENS_PER_STEP) -> Iterator[slice]:
    """Row ranges of at most ``most`` tokens (a larger row is a range of its own)."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield slice(start, stop)
        start = stop


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _coded(left: pa.Array, right: pa.Array):
    """Token codes, row numbers and places in the row; left lists first, then right ones."""
    tokens = pa.concat_arrays([left.flatten(), right.flatten()]).dictionary_encode()
    codes = tokens.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.concatenate([_lengths(left), _lengths(right)]).astype(np.int64)
    rows = np.repeat(np.tile(np.arange(len(left)), 2), sizes)
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    places = np.arange(len(codes)) - starts
    return codes, rows, places, sizes


def in_steps(kernel, *lists: pa.Array) -> list[np.ndarray]:
    """Run ``kernel(*lists) -> columns`` over a batch in pieces of limited size."""
    sizes = sum(_lengths(column) for column in lists)
    ranges = list(steps(sizes)) or [slice(0, 0)]
    parts = [kernel(*[column[r] for column in lists]) for r in ranges]
    return [np.concatenate(column) for column in zip(*parts)]


def ngram_matches(left: pa.Array, right: pa.Array, orders: int) -> list[np.ndarray]:
    """Per order n = 1..orders, the clipped n-gram matches of every row."""
    n_rows = len(left)
    codes, rows, places, sizes = _coded(left, right)
    n_left = int(sizes[:n_rows].sum())
    room = np.repeat(sizes, sizes) - places
    is_left = np.arange(len(codes)) < n_left
    grams, out = codes, []
    for n in range(1, orders + 1):
        if n > 1:
            # Code of the n-gram at a place = (code of the shorter gram there, next token).
            follow = np.append(codes[n - 1 :], np.zeros(n - 1, np.int64))[: len(codes)]
            grams = np.unique(
                grams * (codes.max(initial=0) + 1) + follow, return_inverse=True
            )[1]
        whole = room >= n
        width = int(grams.max(initial=0)) + 1
        keys = rows * width + grams
        a_keys, a_counts = np.unique(keys[whole & is_left], return_counts=True)
        b_keys, b_counts = np.unique(keys[whole & ~is_left], return_counts=True)
        shared, ia, ib = np.intersect1d(a_keys, b_keys, assume_unique=True, return_indices=True)
        clipped = np.minimum(a_counts[ia], b_counts[ib])
        out.append(np.bincount(shared // width, clipped, n_rows).astype(np.int32))
    return out


def _copy_numbers(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for the equal keys met in turn; ``order`` sorts the keys stably."""
    ordered = keys[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    runs = np.flatnonzero(first)
    numbers = np.empty(len(keys), np.int64)
    numbers[order] = np.arange(len(keys)) - np.repeat(runs, np.diff(np.r_[runs, len(keys)]))
    return numbers


def _same_copies(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs joining the k-th copy of every key on the left with that on the right."""
    deepest = max(len(left), len(right)) + 1
    tags = []
    for keys in (left, right):
        order = np.argsort(keys, kind="stable")
        copies = _copy_numbers(keys, order) if len(keys) else np.zeros(0, np.int64)
        tags.append(keys * deepest + copies)
    _, at_left, at_right = np.intersect1d(*tags, assume_unique=True, return_indices=True)
    return at_left, at_right


def alignment(*stages: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(matches, chunks) per row: k-th copy of a word with its k-th copy opposite.

    ``stages`` are pairs of lists, left and right: the words, then other keys of the same
    words (stems, say). Each stage aligns what the ones before have left over. A chunk is a
    run of matches that are adjacent, in the same order, on both sides.
    """
    n_rows = len(stages[0])
    free, matched = None, []
    for left, right in zip(stages[::2], stages[1::2]):
        codes, rows, places, sizes = _coded(left, right)
        cut = int(sizes[:n_rows].sum())
        if free is None:
            free = [np.arange(cut), np.arange(cut, len(codes))]
        # Equal codes, but numbered anew: keys stay small whatever the vocabulary.
        keys = np.unique(rows * (int(codes.max(initial=0)) + 1) + codes, return_inverse=True)[1]
        a, b = _same_copies(keys[free[0]], keys[free[1]])
        found = np.stack([free[0][a], free[1][b]])
        matched.append(found)
        free = [np.setdiff1d(f, hit, assume_unique=True) for f, hit in zip(free, found)]
    at_left, at_right = np.concatenate(matched, axis=1)
    order = np.argsort(at_left)
    at_left, at_right = at_left[order], at_right[order]
    row, x, y = rows[at_left], places[at_left], places[at_right]
    joined = (row[1:] == row[:-1]) & (x[1:] == x[:-1] + 1) & (y[1:] == y[:-1] + 1)
    opens = np.r_[np.ones(min(len(row), 1), bool), ~joined]
    matches = np.bincount(row, minlength=n_rows).astype(np.int32)
    return matches, np.bincount(row[opens], minlength=n_rows).astype(np.int32)
