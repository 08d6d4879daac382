"""Exact counts of hashed windows or shingles, with one number a hash on the wire.

A *block* is a fixed set of texts (chosen by hash, so every attempt of a task sees the same
set). It sends each of its different hashes once, sorted, to the hash's *bucket*; equal hashes
of a block are counted there and then, so a hash that occurs everywhere costs one entry a
block. The bucket answers with one byte for each entry, in the order in which it came. Both
sides therefore agree without ids, positions or joins on hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENT = "block long, bucket long, n long, packed binary, local binary"
ANSWER = "block long, bucket long, answer binary"


def sizes(total_bytes: int) -> tuple[int, int]:
    """(blocks, buckets) for texts of so many bytes.

    Blocks hold 8 MB of text and buckets a million hashes for 1 GB; both grow with the square
    root of the input up to 256 MB and 16 million, so that a block still sends each bucket
    a run of hashes when there are a million of them.
    """
    grow = max(1.0, math.sqrt(total_bytes / 1e9))
    block = min(256e6, 8e6 * grow)
    bucket = min(16e6, 1e6 * grow)
    return max(1, math.ceil(total_bytes / block)), max(1, math.ceil(total_bytes / 6 / bucket))


def total_bytes(df: DataFrame, text: str) -> int:
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def block_of(keys: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by range of the hash, so that sorted hashes have sorted buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def pack(values: np.ndarray) -> bytes:
    """Sorted uint64 as byte planes of their differences; the shuffle's compression does the rest."""
    gaps = np.diff(values, prepend=np.uint64(0))
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def cut(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets present, first, last) of sorted hashes."""
    which = bucket_of(hashes, buckets)
    present, first = np.unique(which, return_index=True)
    return present, first, np.append(first[1:], len(hashes))


def send(block: int, hashes: np.ndarray, local: np.ndarray, buckets: int) -> pa.Table:
    """Rows of one block: sorted different ``hashes`` and a byte of local count for each."""
    present, first, last = cut(hashes, buckets) if len(hashes) else (np.zeros(0, np.int64),) * 3
    local = local.astype(np.uint8)
    return pa.table(
        {
            "block": pa.array(np.full(len(present), block), pa.int64()),
            "bucket": pa.array(present, pa.int64()),
            "n": pa.array(last - first, pa.int64()),
            "packed": pa.array([pack(hashes[a:b]) for a, b in zip(first, last)], pa.binary()),
            "local": pa.array([local[a:b].tobytes() for a, b in zip(first, last)], pa.binary()),
        }
    )


def answers(code: Callable[[np.ndarray], np.ndarray]) -> Callable[[pa.Table], pa.Table]:
    """Bucket function: total count of each hash over all blocks, coded to a byte."""

    def run(group: pa.Table) -> pa.Table:
        runs = [unpack(x) for x in group["packed"].to_pylist()]
        counts = np.concatenate([np.frombuffer(x, np.uint8) for x in group["local"].to_pylist()])
        values = np.concatenate(runs)
        order = np.argsort(values, kind="stable")  # merges the sorted runs
        sorted_values = values[order]
        new = np.ones(len(values), bool)
        new[1:] = sorted_values[1:] != sorted_values[:-1]
        first = np.flatnonzero(new)
        totals = np.add.reduceat(counts[order].astype(np.int64), first)
        coded = np.empty(len(values), np.uint8)
        coded[order] = np.repeat(code(totals), np.diff(np.append(first, len(values))))
        cuts = np.cumsum([len(r) for r in runs])[:-1]
        return pa.table(
            {
                "block": group["block"],
                "bucket": group["bucket"],
                "answer": pa.array([x.tobytes() for x in np.split(coded, cuts)], pa.binary()),
            }
        )

    return run


def read_answers(group: pa.Table, hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The coded count of each of a block's sorted different hashes."""
    out = np.zeros(len(hashes), np.uint8)
    if not len(hashes):
        return out
    present, first, last = cut(hashes, buckets)
    got = dict(zip(group["bucket"].to_pylist(), group["answer"].to_pylist()))
    for bucket, a, b in zip(present.tolist(), first, last):
        out[a:b] = np.frombuffer(got[bucket], np.uint8)
    return out


def count_hashes(
    blocked: DataFrame, keys: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], code: Callable, buckets: int
) -> DataFrame:
    """``keys`` gives a block's sorted different hashes and their local counts; returns the answers."""

    def of_block(group: pa.Table) -> pa.Table:
        hashes, local = keys(group)
        return send(group["block"][0].as_py(), hashes, local, buckets)

    sent = blocked.groupBy("block").applyInArrow(of_block, SENT)
    return sent.groupBy("bucket").applyInArrow(answers(code), ANSWER)
