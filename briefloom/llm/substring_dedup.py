"""Substring dedup: remove every passage whose fixed-length token windows occur elsewhere.

Rabin-Karp hashes of every window of ``width`` words are counted over the whole corpus
(``exchange``); a word is removed if any window that covers it starts at two places or more,
in one text or in several. Touching windows merge into maximal removal intervals.
"""

from __future__ import annotations

import re
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from briefloom.llm import exchange
from briefloom.llm.kernels import Words, slices

WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
RESULT = "kept_text string, n_words long, n_removed long, removed array<struct<first:int,last:int>>"


def _repeated(counts: np.ndarray) -> np.ndarray:
    return (counts > 1).astype(np.uint8)


def _window_hashes(texts: pa.Array, width: int) -> list[np.ndarray]:
    return [Words(texts.slice(i, j - i)).windows(width)[1] for i, j in slices(texts)]


def _texts(group: pa.Table) -> pa.Array:
    column = group["text"].cast(pa.large_string())
    return pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)


def _distinct(hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.unique(np.concatenate(hashes), return_counts=True)


def intervals(covered: np.ndarray) -> list[dict]:
    """Maximal runs of True as first and last word (0-based, last included)."""
    edge = np.diff(np.concatenate(([False], covered, [False])).astype(np.int8))
    return [
        {"first": int(a), "last": int(b) - 1}
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))
    ]


def without(text: bytes, spans: list[dict]) -> bytes:
    """The text from each word after an interval to the next interval, white space as it is."""
    at = [m.start() for m in WORD_BYTES.finditer(text)] + [len(text)]
    edges = [0, *(at[e] for s in spans for e in (s["first"], s["last"] + 1)), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])).rstrip(b" \t\n\v\f\r")


def substring_dedup(
    docs: DataFrame, width: int = 35, ident: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (),
    spacing: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, columns ``carry``, kept text, word counts, removal intervals.

    ``kept_text`` is the remaining words joined by one space, or, with ``spacing``, the text as it is
    without its removal intervals and the white space behind each. Null and empty texts have no
    words (kept text empty, counts 0, no interval); texts shorter than ``width`` lose nothing.
    Repeated rows and repeated or null ids are rows like any other, so of two equal texts
    of ``width`` words or more both lose everything. Carried columns go along with their rows, unread (``text`` among them is the
    whole text); the others are not read.
    """
    extra = [c for c in carry if c != "text"]
    rows = docs.select(
        F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
        *[F.col(c).alias(f"_{c}") for c in extra],
    )
    kinds = dict(docs.dtypes)
    shape = ", ".join(["doc_id long", *(f"{c} {kinds[c]}" for c in carry), RESULT])
    blocks, buckets = exchange.sizes(exchange.total_bytes(rows, "text"))
    blocked = rows.withColumn("block", exchange.block_of(["doc_id", "text"], blocks))

    def keys(group: pa.Table):
        values, counts = _distinct(_window_hashes(_texts(group), width))
        return values, np.minimum(counts, 2)

    def remove(texts: pa.Table, answers: pa.Table) -> pa.Table:
        column = _texts(texts)
        parts = list(slices(column))
        hashes = [Words(column.slice(i, j - i)).windows(width)[1] for i, j in parts]
        values, _ = _distinct(hashes)
        repeated = values[exchange.read_answers(answers, values, buckets) > 0]
        kept, n_words, n_removed, spans = [], [], [], []
        for (i, j), own in zip(parts, hashes):
            words = Words(column.slice(i, j - i))
            at, _ = words.windows(width)
            place = np.searchsorted(repeated, own)
            place[place == len(repeated)] = 0
            hit = at[repeated[place] == own] if len(repeated) else at[:0]
            depth = np.zeros(len(words.start) + 1, np.int32)
            np.add.at(depth, hit, 1)
            np.add.at(depth, hit + width, -1)
            covered = np.cumsum(depth[:-1]) > 0
            for k in range(j - i):
                whole = words.raw[words.offsets[k] : words.offsets[k + 1]].tobytes()
                gone = covered[words.bounds[k] : words.bounds[k + 1]]
                lost = int(gone.sum())
                if spacing:
                    kept.append((without(whole, intervals(gone)) if lost else whole).decode())
                else:
                    own_words = whole.split()
                    if lost:
                        own_words = list(compress(own_words, (~gone).tolist()))
                    kept.append(b" ".join(own_words).decode())
                n_words.append(len(gone))
                n_removed.append(lost)
                spans.append(intervals(gone) if lost else [])
        return pa.table(
            {
                "doc_id": texts["doc_id"],
                **{c: texts["text" if c == "text" else f"_{c}"] for c in carry},
                "kept_text": pa.array(kept, pa.string()),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "removed": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
            }
        )

    counted = exchange.count_hashes(blocked, keys, _repeated, buckets)
    return blocked.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(remove, shape)


def op5_substring_dedup(docs: DataFrame) -> DataFrame:
    """The contract's digest columns, from the operator's rows."""
    return substring_dedup(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"), "removed"
    )
