"""Periodic run detection with string synchronising sets.

A run is a maximal stretch of words with smallest period q and a length of at least
``max(least, 3 * q)``. Periods up to ``SMALL`` are found by comparing the words with themselves,
shifted. Longer ones come from dyadic scales: at scale k (periods in 2**k < q <= 2**(k+1)) a
synchronising set with tau = 2**(k-1) selects positions by the smallest hash of the tau words that
begin there, leaving out beginnings that are highly periodic (period up to tau / 3). Whether a
position is selected depends on the 2 * tau words after it alone, so in a run a selected
position comes back one period later. Selected positions that are followed by the same context
of at least q words and have no such position between them therefore propose their distance as
period. What a set leaves out lies in runs of small periods, which the scales before have found:
they are handed on from scale to scale, and are results themselves.

Completeness. In a run of period q starting at a, either a position in [a, a + tau) is selected,
or a highly periodic region starts there and the position 2 * tau - 1 words before its end is;
that end lies before a + q + tau / 3. Either way the position, one period and a context of
up to 1.25 q words fit into the 3 q words of the run. Contexts of q words differ within a
period, so the next equal context lies exactly q further on. Four context lengths a scale
(1.25, 1.5, 1.75 and 2 times 2**k) cover all q.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from briefloom.llm.kernels import Words, mix, slices

SMALL = 8  # longest period looked for by shifting
_FIRST = 3  # 2**_FIRST == SMALL
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = 0xC2B2AE3D27D4EB4F | 1
_NAME = np.uint64(0x9E6C63D0876A68DF)

RUN = "struct<start:long,length:long,period:long>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 of the stretches of True."""
    edge = np.diff(np.concatenate(([False], same, [False])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class _Prefixes:
    """Rabin-Karp prefix sums: hashes of any stretch, and longest common extensions."""

    def __init__(self, seq: np.ndarray):
        self.n = len(seq)
        up = np.full(self.n + 1, _BASE, np.uint64)
        down = np.full(self.n + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        self.down = np.cumprod(down, dtype=np.uint64)
        self.total = np.zeros(self.n + 1, np.uint64)
        np.cumsum(seq * np.cumprod(up, dtype=np.uint64)[:-1], out=self.total[1:])

    def hash(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.total[at + size] - self.total[at]) * self.down[at]

    def common(self, a: np.ndarray, b: np.ndarray, backwards: bool) -> np.ndarray:
        """Length of the longest equal stretch from a and b (a < b) on, or before them."""
        low = np.zeros(len(a), np.int64)
        high = (a if backwards else self.n - b).copy()
        while (open_ := low < high).any():
            middle = np.where(open_, (low + high + 1) >> 1, low)
            x, y = (a - middle, b - middle) if backwards else (a, b)
            equal = self.hash(x, middle) == self.hash(y, middle)
            low = np.where(open_ & equal, middle, low)
            high = np.where(open_ & ~equal, middle - 1, high)
        return low


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every window of ``width``."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[: len(values) - have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _smallest(first: np.ndarray, last: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Rows (first, last + 1, period) with the smallest period of each stretch, in text order."""
    order = np.lexsort((period, last, first))
    rows = np.stack([first, last, period], 1)[order]
    if len(rows) > 1:
        rows = rows[np.append(True, (np.diff(rows[:, :2], axis=0) != 0).any(1))]
    return rows


def _small_runs(seq: np.ndarray) -> np.ndarray:
    """All runs with period <= SMALL that are results or are long enough to hide a selected position."""
    found = []
    for p in range(1, SMALL + 1):
        if len(seq) <= p:
            break
        a, b = _stretches(seq[:-p] == seq[p:])
        tau = 1 << max(2, (3 * p - 1).bit_length())  # the first scale that leaves this period out
        long = b + p - a >= max(3 * p, min(24, tau))
        found.append(np.stack([a[long], b[long] + p, np.full(long.sum(), p)], 1))
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return _smallest(*rows.T.astype(np.int64))


def selected(seq: np.ndarray, tau: int, runs: np.ndarray) -> np.ndarray:
    """Synchronising set of ``seq``: depends on the 2 * tau words from a position on alone."""
    names, have = mix(seq), 1
    while have < tau:
        names = mix(names[:-have] * _NAME + names[have:]) if len(names) > have else names[:0]
        have *= 2
    if len(names) <= tau:
        return np.zeros(0, np.int64)
    names = np.minimum(names, _NONE - np.uint64(1))
    hidden = runs[(3 * runs[:, 2] <= tau) & (runs[:, 1] - runs[:, 0] >= tau)]
    if len(hidden):
        depth = np.zeros(len(names) + 1, np.int32)
        np.add.at(depth, hidden[:, 0], 1)
        np.add.at(depth, hidden[:, 1] - tau + 1, -1)
        names = np.where(np.cumsum(depth[:-1]) > 0, _NONE, names)
    least = _window_least(names, tau + 1)
    return np.flatnonzero((least != _NONE) & ((names[: len(least)] == least) | (names[tau:] == least)))


def _scale_runs(seq: np.ndarray, k: int, runs: np.ndarray) -> np.ndarray:
    """Runs with a period in 2**k < q <= 2**(k + 1), given all runs of shorter periods."""
    at = selected(seq, 1 << (k - 1), runs)
    if not len(at):
        return runs[:0]
    sums = _Prefixes(seq)
    first, period, shortest = [], [], 1 << k
    for quarters in (5, 6, 7, 8):
        context = (quarters << k) >> 2
        inside = at[at + context <= len(seq)]
        keys = sums.hash(inside, context)
        order = np.argsort(keys, kind="stable")
        follows = keys[order[1:]] == keys[order[:-1]]
        i, j = inside[order[:-1][follows]], inside[order[1:][follows]]
        near = (j - i > shortest) & (j - i <= context)
        first.append(i[near])
        period.append((j - i)[near])
        shortest = context
    i, d = np.concatenate(first), np.concatenate(period)
    if not len(i):
        return runs[:0]
    # one proposal of each stretch and period is enough: those one period after another follow from the first
    order = np.lexsort((i, d))
    i, d = i[order], d[order]
    again = np.zeros(len(i), bool)
    again[1:] = (d[1:] == d[:-1]) & (i[1:] - i[:-1] <= d[1:])
    i, d = i[~again], d[~again]
    begin = i - sums.common(i, i + d, True)
    end = i + d + sums.common(i, i + d, False)
    long = end - begin >= 3 * d
    rows = _smallest(begin[long], end[long], d[long])
    exact = [np.array_equal(seq[a : b - p], seq[a + p : b]) for a, b, p in rows.tolist()]
    return rows[np.array(exact, bool)]


def find_runs(hashes: np.ndarray, bounds: np.ndarray, least: int = 24) -> list[np.ndarray]:
    """For each text, its runs as rows (start, length, period), sorted by start and period.

    ``hashes`` are the word hashes of all texts, ``bounds[t]`` .. ``bounds[t + 1]`` those of text t.
    All texts are searched at once: they are laid end to end with a mark of its own after each,
    which equals nothing, so no run crosses it. A scale reads only texts that are long enough.
    """
    counts = np.diff(bounds)
    found = [np.zeros((0, 3), np.int64) for _ in counts]
    known = np.zeros((0, 3), np.int64)  # runs of the texts in hand, as places in their joined sequence
    texts, k = np.arange(len(counts)), _FIRST - 1
    while True:
        keep = counts[texts] >= (1 if k < _FIRST else 3 << k)
        if k >= _FIRST and not keep.all():
            # runs of shorter texts are complete; the others move to their new places
            shift = np.cumsum(np.append(0, (counts[texts] + 1) * keep))[:-1] - begins
            of = np.searchsorted(begins, known[:, 0], "right") - 1
            known = known[keep[of]] + (shift[of[keep[of]], None] * np.array([1, 1, 0]))
        if k < _FIRST or not keep.all():
            texts = texts[keep]
            if not len(texts):
                return found
            begins = np.cumsum(np.append(0, counts[texts] + 1))[:-1]
            seq = np.empty(int(counts[texts].sum()) + len(texts), np.uint64)
            marks = begins + counts[texts]
            plain = np.ones(len(seq), bool)
            plain[marks] = False
            chosen = np.zeros(len(counts), bool)
            chosen[texts] = True
            seq[plain] = hashes[np.repeat(chosen, counts)]
            seq[marks] = mix(np.arange(len(texts), dtype=np.uint64) + np.uint64(0xA5A5_0000_0000))
        new = _small_runs(seq) if k < _FIRST else _scale_runs(seq, k, known)
        results = new[(new[:, 1] - new[:, 0] >= np.maximum(least, 3 * new[:, 2]))]
        of = np.searchsorted(begins, results[:, 0], "right") - 1
        cuts = np.searchsorted(of, np.arange(len(texts) + 1))
        for t in np.unique(of).tolist():
            rows = results[cuts[t] : cuts[t + 1]]
            local = np.stack([rows[:, 0] - begins[t], rows[:, 1] - rows[:, 0], rows[:, 2]], 1)
            have = np.concatenate([found[texts[t]], local])
            found[texts[t]] = have[np.lexsort((have[:, 2], have[:, 0]))]
        known = np.concatenate([known, new])
        known = known[np.argsort(known[:, 0], kind="stable")]
        k += 1


def repeats_of(runs: np.ndarray, n: int) -> np.ndarray:
    """Words that a run contains after its first period."""
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:-1]) > 0


def periodic_runs(
    docs: DataFrame, least: int = 24, ident: str = "doc_id", text: str = "text",
    rewrite: Callable[[int | None, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_words, runs, kept_text).

    Runs are sorted by start and period; ``kept_text`` is the words outside the repetitions (the
    first period of a run stays), joined by one space. ``rewrite(doc_id, n)`` may give, for
    each of a text's n words, the number of the word that stands there instead (None: unchanged).
    Null and empty texts have no words, no runs and an empty ``kept_text``. Repeated rows and
    null ids are rows like any other; other columns are not read. Words are told apart by
    64-bit hashes. Texts stay where they are: nothing is shuffled, and tasks hold about 4 MB of text at a
    time (a longer text is held whole).
    """
    if least < 3 * SMALL:
        raise ValueError(f"least must be {3 * SMALL} or more")

    def run(batches):
        for batch in batches:
            idents, column = batch.column(0).to_pylist(), batch.column(1)
            for i, j in slices(column):
                words = Words(column.slice(i, j - i))
                hashes, sources = words.hashes, [None] * (j - i)
                if rewrite:
                    hashes = hashes.copy()
                    for t, ident_ in enumerate(idents[i:j]):
                        a, b = words.bounds[t], words.bounds[t + 1]
                        sources[t] = rewrite(ident_, int(b - a))
                        if sources[t] is not None:
                            hashes[a:b] = words.hashes[a + sources[t]]
                found = find_runs(hashes, words.bounds, least)
                kept, spans = [], []
                for t, rows in enumerate(found):
                    own = words.raw[words.offsets[t] : words.offsets[t + 1]].tobytes().split()
                    if sources[t] is not None:
                        own = [own[s] for s in sources[t].tolist()]
                    if len(rows):
                        own = compress(own, (~repeats_of(rows, len(own))).tolist())
                    kept.append(b" ".join(own).decode())
                    spans.append([{"start": s, "length": n, "period": p} for s, n, p in rows.tolist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(words.counts, pa.int64()), pa.array(spans, pa.list_(_RUN)),
                     pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "runs", "kept_text"],
                )

    rows = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, kept_text string")


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's rewriting of every tenth document (by crc32 of its id); a null id changes nothing."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def op13_periodic_runs(docs: DataFrame) -> DataFrame:
    """The contract's digest columns, from the operator's rows."""
    found = periodic_runs(docs, rewrite=planted)
    # the larger exponent first, compared as fractions; then the smaller start and period
    higher = lambda a, b: a["length"] * b["period"] - b["length"] * a["period"]
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)),
        lambda top, r: F.when(higher(r, top) > 0, r).otherwise(top),
    )
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    sha = lambda column: F.sha2(column.cast("binary"), 256)
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        sha(lines).alias("runs_sha256"), sha(F.col("kept_text")).alias("collapsed_sha256"),
    )
