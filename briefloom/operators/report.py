"""Run comparison and split metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from briefloom.functions.ordering import hex_prefix


# Marks are 60 bits; their sum is kept modulo this, so that equal rows do not cancel out.
MARKS = 1 << 60


def leaderboard(report: DataFrame, model_col: str = "model") -> DataFrame:
    """Rank models per metric, best first; a report has one row per model and metric."""
    best = Window.partitionBy("metric").orderBy(F.desc("value"))
    return report.select(model_col, "metric", "value", F.rank().over(best).alias("rank"))


def split_manifest(
    df: DataFrame, columns: Sequence[str], split_col: str = "split"
) -> DataFrame:
    """Rows, UTF-8 text bytes and an order-free content fingerprint per split and in total."""
    text = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns]
    n_bytes = text[0]
    for part in text[1:]:
        n_bytes = n_bytes + part
    content = F.md5(
        F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    )
    measured = df.select(
        split_col, n_bytes.cast("long").alias("_bytes"), hex_prefix(content, 15).alias("_mark")
    )
    return (
        measured.rollup(split_col)
        .agg(
            F.count(F.lit(1)).alias("num_examples"),
            F.sum("_bytes").alias("num_bytes"),
            (F.sum(F.col("_mark").cast("decimal(38,0)")) % MARKS).cast("long").alias("fingerprint"),
            F.grouping(split_col).alias("_all"),
        )
        .withColumn(split_col, F.when(F.col("_all") == 1, "total").otherwise(F.col(split_col)))
        .drop("_all")
    )
