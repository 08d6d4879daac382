"""What the two classifiers share: labelled rows, sums over partitions, isotonic calibration."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from briefloom.scaling import MAX_BROADCAST_ROWS, row_count_at_most


def one_label(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label): one 0/1 label per id, the largest; rows without id or label are left out."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    return known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))


def with_labels(docs: DataFrame, labels: DataFrame, label: str, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Inner join of ``docs`` with its labels by doc_id.

    Labels are broadcast when counted to be few; else the join shuffles by id.
    """
    known = one_label(labels, label)
    return docs.join(F.broadcast(known) if row_count_at_most(known, max_broadcast_rows) else known, "doc_id")


def summed(partials: DataFrame, groups: int = 8) -> np.ndarray:
    """Sum of the float64 vectors in ``v``: added up in ``groups`` tasks, then on the driver."""

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in group["v"].to_pylist())
        return pa.table({"v": pa.array([total.tobytes()], pa.binary())})

    keyed = partials.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(groups)))
    rows = keyed.groupBy("g").applyInArrow(add, "v binary").collect()
    return sum(np.frombuffer(r["v"], np.float64) for r in rows)


def isotonic(values: np.ndarray, positives: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over sorted ``values``: (centres, rates) of the blocks."""
    blocks: list[list[float]] = []
    for x, p, n in zip(values, positives, totals):
        blocks.append([x * n, p, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def calibration(scored: DataFrame, score: str, label: str, step: float) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic curve of ``label`` on ``score``, from counts in bins of width ``step``.

    ``score`` must be bounded, so that the number of bins is.
    """
    bins = (
        scored.groupBy(F.round(F.col(score) / step).cast("long").alias("bin"))
        .agg(F.sum(label).alias("p"), F.count(F.lit(1)).alias("n")).orderBy("bin").collect()
    )
    if not bins:
        return np.zeros(1), np.full(1, 0.5)
    return isotonic(
        np.array([b["bin"] * step for b in bins]), np.array([float(b["p"]) for b in bins]), np.array([float(b["n"]) for b in bins])
    )


def calibrated(raw: np.ndarray, curve: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Rates read off the curve, with a hair of the raw order kept where it is flat."""
    x, y = curve
    rate = np.interp(raw, x, y)
    return np.clip(0.999 * rate + 0.001 / (1 + np.exp(-np.clip(raw, -30, 30))), 0.0, 1.0)
