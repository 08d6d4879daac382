"""Token lists of whole texts, cut from their bytes for an Arrow batch at a time.

A task so receives texts, not a string for every token, and no pattern is matched word by word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from briefloom.functions.overlap import steps

# Bytes of text whose tokens are held at once.
BYTES_PER_STEP = 1 << 20

_BYTES = np.arange(256)
_IN_WORD = ((_BYTES >= 48) & (_BYTES < 58)) | ((_BYTES >= 97) & (_BYTES < 123))
_IN_SPACED = (_BYTES != 32) & ((_BYTES < 9) | (_BYTES > 13))


def words(texts: pa.Array) -> pa.Array:
    """Runs of a-z and 0-9 of each text; a null has none."""
    return _token_lists(texts, _IN_WORD)


def spaced(texts: pa.Array) -> pa.Array:
    """What stands between the (ASCII) white space of each text; a null has nothing."""
    return _token_lists(texts, _IN_SPACED)


def _token_lists(texts: pa.Array, kept: np.ndarray) -> pa.Array:
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    at = at - at[0]
    inside = kept[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = at[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    ends = np.cumsum(np.append(0, np.flatnonzero(last) + 1 - starts)).astype(np.int32)
    tokens = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(raw[inside]))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, at).astype(np.int32)), tokens)


def in_text_steps(kernel, cut, *texts: pa.Array) -> list[np.ndarray]:
    """Run ``kernel(*token lists) -> columns`` over texts that ``cut`` makes tokens of, in pieces of limited size.

    The numbers of tokens of each text come before the kernel's columns.
    """
    sizes = sum(pc.fill_null(pc.binary_length(t), 0).to_numpy(zero_copy_only=False).astype(np.int64) for t in texts)
    parts = []
    for r in list(steps(sizes, BYTES_PER_STEP)) or [slice(0, 0)]:
        lists = [cut(t[r]) for t in texts]
        parts.append([*(np.diff(x.offsets.to_numpy()) for x in lists), *kernel(*lists)])
    return [np.concatenate(column) for column in zip(*parts)]
