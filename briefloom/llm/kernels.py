"""Batch kernels on the UTF-8 bytes of Arrow strings: words, word hashes, window hashes.

A word is a run of bytes other than space and the controls 9-13, so spans found in bytes are
the spans of ``[^\\x20\\x09-\\x0D]+``. All hashes are 64 bits wide: polynomials modulo 2**64 over
random byte values (Rabin-Karp, from prefix sums) with a bit mixer on top.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD1342543DE82EF95 | 1
_CHUNK = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Bit mixer (splitmix finaliser) on uint64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_values(fold_case: bool) -> np.ndarray:
    """One odd pseudo-random value per byte; A-Z and a-z alike when ``fold_case``."""
    of = np.arange(256, dtype=np.uint64)
    if fold_case:
        of[65:91] += np.uint64(32)
    return mix(of * np.uint64(_BASE) + np.uint64(1)) | np.uint64(1)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[:1], down[:1] = 1, 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


@functools.cache
def _chunk_powers() -> tuple[np.ndarray, np.ndarray]:
    """The powers that word hashes use, made once per process; not to be written to."""
    return _powers(_BASE, _CHUNK)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null has no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    texts = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    return raw, at - at[0]


class Words:
    """The words of a batch of texts: byte spans, hashes, and first word of each text."""

    def __init__(self, texts: pa.Array, fold_case: bool = False):
        raw, offsets = text_bytes(texts)
        self.raw, self.offsets = raw, offsets
        inside = (raw != 32) & ((raw < 9) | (raw > 13))
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(raw))]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        # bounds[d] .. bounds[d + 1] are the words of text d
        self.bounds = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.bounds)
        self.hashes = self._hashes(byte_values(fold_case))

    def _hashes(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.start), np.uint64)
        i = 0
        while i < len(out):
            begin = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, begin + _CHUNK, "right")))
            n = int(self.end[j - 1] - begin)
            up, down = (p[:n] for p in _chunk_powers()) if n <= _CHUNK else _powers(_BASE, n)
            total = np.zeros(len(up) + 1, np.uint64)
            np.cumsum(values[self.raw[begin : self.end[j - 1]]] * up, out=total[1:])
            s, e = self.start[i:j] - begin, self.end[i:j] - begin
            out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
            i = j
        return out

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every window of ``k`` words that lies in one text."""
        n = len(self.hashes)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        up, down = _powers(_WORD_BASE, n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hashes * up, out=total[1:])
        valid = np.zeros(n, bool)
        valid[: n - k + 1] = True
        for back in range(1, k):  # the last k - 1 words of a text start no window
            tail = self.bounds[1:] - back
            valid[tail[(tail >= self.bounds[:-1]) & (tail < n)]] = False
        at = np.flatnonzero(valid)
        return at, mix((total[at + k] - total[at]) * down[at] + np.uint64(k))

    def whole(self) -> np.ndarray:
        """One hash per text of its word sequence; texts without words give the hash of nothing."""
        n = len(self.hashes)
        up, down = _powers(_WORD_BASE, n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hashes * up[:n], out=total[1:])
        s, e = self.bounds[:-1], self.bounds[1:]
        return mix((total[e] - total[s]) * down[s] + self.counts.astype(np.uint64) * np.uint64(_BASE))

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def slices(texts: pa.Array, limit: int = 4 << 20):
    """(first, last) row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    _, offsets = text_bytes(texts)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j
