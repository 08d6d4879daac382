"""Longest common subsequences of many pairs at once: bit vectors in 64-bit lanes, with carries between lanes.

The step of ``lcs.lcs_length`` for one more item is the same for every pair, so a batch of pairs takes it
together. What is vectorised has up to ``MAX_LANES`` lanes; pairs with longer sequences are
left to Python's integers, which are faster there.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from briefloom.functions.lcs import covered_places, lcs_length

MAX_LANES = 8
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _step(vectors: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """The vectors (pairs x lanes) after one more item, which stands where ``masks`` has ones."""
    hit = vectors & masks
    out = vectors & ~masks
    carry = None
    for lane in range(vectors.shape[1]):
        total = vectors[:, lane] + hit[:, lane]
        over = total < hit[:, lane]
        if carry is not None:
            total += carry
            over |= total < carry
        carry = over.astype(np.uint64)
        out[:, lane] |= total
    return out


def _bits(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lane and bit of places in a sequence."""
    return places >> 6, np.uint64(1) << (places & 63).astype(np.uint64)


def _numbered(left: pa.Array, right: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(item numbers, offsets) of both sides; equal items have equal numbers."""
    flat = pa.chunked_array([pc.cast(left.flatten(), pa.string()), pc.cast(right.flatten(), pa.string())])
    numbers = flat.dictionary_encode().combine_chunks()
    if isinstance(numbers, pa.ChunkedArray):
        numbers = pa.concat_arrays(numbers.chunks)
    codes = numbers.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    out, begin = [], 0
    for side in (left, right):
        sizes = pc.fill_null(pc.list_value_length(side), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = np.append(0, np.cumsum(sizes))
        out.append((codes[begin : begin + offsets[-1]], offsets))
        begin += offsets[-1]
    return out


def lcs_lengths(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Length of the LCS of each row of two list arrays; nulls count as empty."""
    (a, a_at), (b, b_at) = _numbered(left, right)
    n_a, n_b = np.diff(a_at), np.diff(b_at)
    out = np.zeros(len(n_a), np.int64)
    lanes = (np.minimum(n_a, n_b) + 63) >> 6
    for row in np.flatnonzero(lanes > MAX_LANES).tolist():
        out[row] = lcs_length(a[a_at[row] : a_at[row + 1]].tolist(), b[b_at[row] : b_at[row + 1]].tolist())
    for size in range(1, MAX_LANES + 1):
        rows = np.flatnonzero(lanes == size)
        for part in np.array_split(rows, max(1, len(rows) * size // (1 << 16))) if len(rows) else ():
            short = n_a[part] <= n_b[part]
            sides = [
                [(a if s == (k == 0) else b)[(a_at if s == (k == 0) else b_at)[r] :][: (n_a if s == (k == 0) else n_b)[r]]
                 for r, s in zip(part.tolist(), short.tolist())] for k in (0, 1)
            ]
            out[part] = _lengths(*sides, size, int(max(a.max(initial=0), b.max(initial=0))) + 1)
    return out


def _lengths(shorter: list[np.ndarray], longer: list[np.ndarray], lanes: int, kinds: int) -> np.ndarray:
    sizes = np.array([len(x) for x in shorter])
    rows = np.repeat(np.arange(len(sizes)), sizes)
    places = np.concatenate([np.arange(n) for n in sizes.tolist()])
    keys, at = np.unique(rows * kinds + np.concatenate(shorter), return_inverse=True)
    masks = np.zeros((len(keys), lanes), np.uint64)
    lane, bit = _bits(places)
    np.bitwise_or.at(masks, (at, lane), bit)
    # items that the shorter side lacks change nothing: they are left out
    wanted = np.repeat(np.arange(len(sizes)), [len(x) for x in longer]) * kinds + np.concatenate(longer)
    found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    found = found[keys[found] == wanted]
    steps = np.bincount(keys[found] // kinds, minlength=len(sizes))
    begins = np.cumsum(np.append(0, steps))[:-1]
    order = np.argsort(-steps, kind="stable")
    begins, counts = begins[order], steps[order]
    vectors = np.full((len(sizes), lanes), _ALL)
    active = len(order)
    for j in range(int(counts[0])):
        while active and counts[active - 1] <= j:
            active -= 1
        vectors[:active] = _step(vectors[:active], masks[found[begins[:active] + j]])
    zeros = np.bitwise_count(~vectors).sum(1)  # bits beyond the sequence stay one
    out = np.empty(len(sizes), np.int64)
    out[order] = zeros
    return out


def _lines_of_rows(side: pa.Array, codes: np.ndarray) -> Iterator[list[list[int]]]:
    """Each row's lines as lists of word numbers; ``codes`` are those of all words of the side."""
    lines, rows = (
        np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))).tolist()
        for lists in (side.flatten(), side)
    )
    for begin, end in zip(rows, rows[1:]):
        own = codes[lines[begin] : lines[end]].tolist()
        yield [own[a - lines[begin] : b - lines[begin]] for a, b in zip(lines[begin:end], lines[begin + 1 : end + 1])]


def union_hits_of_rows(reference: pa.Array, hypothesis: pa.Array) -> np.ndarray:
    """``union_hits`` of each row of two arrays of lists of lines; words are compared as numbers, and only one row's are Python lists."""
    words = [side.flatten().flatten() for side in (reference, hypothesis)]
    # an empty side may come from Spark with buffers that Arrow cannot slice
    filled = [w for w in words if len(w)] or [pa.array([], pa.string())]
    codes = pa.concat_arrays(filled).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    sides = [_lines_of_rows(reference, codes[: len(words[0])]), _lines_of_rows(hypothesis, codes[len(words[0]) :])]
    return np.array([union_hits(a, b) for a, b in zip(*sides)], np.int32)


def union_hits(reference: list[list[str]], hypothesis: list[list[str]]) -> int:
    """``lcs.union_lcs_hits`` of one row's lines; equal lines of a side are compared once."""
    others = [list(line) for line in dict.fromkeys(map(tuple, hypothesis))]
    left_ref, left_hyp = (Counter(t for line in side for t in line) for side in (reference, hypothesis))
    covered: dict[tuple, int] = {}
    hits = 0
    for line in map(tuple, reference):
        if line not in covered:
            covered[line] = covered_places(list(line), others)
        places = covered[line]
        for i, token in enumerate(line):
            if places >> i & 1 and left_ref[token] > 0 and left_hyp[token] > 0:
                hits += 1
                left_ref[token] -= 1
                left_hyp[token] -= 1
    return hits
