"""Batches for a trainer, and user functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from briefloom.functions.ordering import hex_prefix, order_key
from briefloom.operators.split import HISTOGRAM_DIGITS
from briefloom.operators.vocab import PAD_ID
from briefloom.scaling import MAX_BROADCAST_ROWS, materialise, row_count_at_most

# Rows per batch, and the label id a loss function ignores.
BATCH_ROWS = 2
IGNORED_LABEL = -100
# Rows that meet in one task, unless a single key prefix has more.
STRETCH_ROWS = 1_000


def _padded(rows: Column, pad: int) -> Column:
    longest = F.array_max(F.transform(rows, lambda ids: F.size(ids)))
    return F.transform(
        rows, lambda ids: F.concat(ids, F.array_repeat(F.lit(pad), longest - F.size(ids)))
    )


def collate_batches(
    df: DataFrame,
    id_col: str = "id",
    split_col: str = "split",
    inputs: str = "ids",
    labels: str = "label_ids",
    rows_per_batch: int = BATCH_ROWS,
    seed: int = 42,
) -> DataFrame:
    """Group rows into batches per split, padding each batch to its own longest row.

    ``inputs`` and ``labels`` are unpadded id arrays; labels are padded with -100. A group
    never holds more than ``rows_per_batch`` rows. Rows with one id go by content.

    The id arrays are shuffled once. A histogram of the order keys, from the ids alone, cuts
    each split into stretches of known first rank; rows meet by stretch and are ranked and batched
    there. Only batches that cross the end of a stretch are put together in another, small shuffle.
    """
    key = order_key(F.col(id_col), seed)
    histogram = (
        df.select(split_col, hex_prefix(key, HISTOGRAM_DIGITS).alias("_b"))
        .groupBy(split_col, "_b")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    upto = Window.partitionBy(split_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    stretch = Window.partitionBy(split_col, "_stretch")
    stretches = materialise(
        histogram.withColumn("_before", F.coalesce(F.sum("_rows").over(upto), F.lit(0)))
        .withColumn("_stretch", F.floor(F.col("_before") / STRETCH_ROWS))
        .select(
            F.col(split_col).alias("_split"), "_b", "_stretch",
            F.min("_before").over(stretch).alias("_first"), F.sum("_rows").over(stretch).alias("_size"),
        )
    )
    if row_count_at_most(stretches, MAX_BROADCAST_ROWS):
        stretches = F.broadcast(stretches)
    rows = df.select(
        split_col, F.col(id_col).alias("id"), F.col(inputs).alias("ids"), F.col(labels).alias("labels"),
        key.alias("_key"), hex_prefix(key, HISTOGRAM_DIGITS).alias("_bucket"),
    )
    same = (F.col("_bucket") == F.col("_b")) & F.col(split_col).eqNullSafe(F.col("_split"))
    order = Window.partitionBy(split_col, "_stretch").orderBy("_key", "id", F.xxhash64("ids", "labels"))
    ranked = rows.join(stretches, same).withColumn("_rank", F.col("_first") + F.row_number().over(order))
    batch = F.floor((F.col("_rank") - 1) / rows_per_batch).cast("long")
    inside = (F.col("batch") * rows_per_batch >= F.col("_first")) & (
        (F.col("batch") + 1) * rows_per_batch <= F.col("_first") + F.col("_size")
    )
    grouped = (
        ranked.withColumn("batch", batch)
        .withColumn("_inside", inside)
        .groupBy(split_col, "_stretch", "batch", "_inside")
        .agg(F.sort_array(F.collect_list(F.struct("_rank", "id", "ids", "labels"))).alias("_rows"))
    )
    crossing = grouped.filter(~F.col("_inside")).groupBy(split_col, "batch").agg(
        F.sort_array(F.flatten(F.collect_list("_rows"))).alias("_rows")
    )
    gathered = grouped.filter("_inside").select(split_col, "batch", "_rows").unionByName(crossing)
    parts = gathered.select(
        split_col,
        "batch",
        F.transform("_rows", lambda r: r["id"]).alias("ids"),
        F.transform("_rows", lambda r: r["ids"]).alias("_in"),
        F.transform("_rows", lambda r: r["labels"]).alias("_out"),
    )
    ones = F.transform("_in", lambda ids: F.transform(ids, lambda _: F.lit(1)))
    return parts.select(
        split_col,
        "batch",
        "ids",
        _padded(F.col("_in"), PAD_ID).alias("input_ids"),
        _padded(ones, 0).alias("attention_mask"),
        _padded(F.col("_out"), IGNORED_LABEL).alias("labels"),
    )


def map_batched(
    df: DataFrame, fn: Callable[[dict[str, list]], dict[str, Iterable]], added: str | T.StructType
) -> DataFrame:
    """Apply ``fn(dict of column lists) -> dict of new columns`` batch by batch.

    Returned columns replace same-named ones; all others are kept.
    """
    new = T.StructType.fromDDL(added) if isinstance(added, str) else added
    replaced = set(new.fieldNames())
    schema = T.StructType([f for f in df.schema if f.name not in replaced] + list(new))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            result = fn({name: frame[name].tolist() for name in frame.columns})
            yield frame.assign(**{n: pd.Series(list(v), index=frame.index) for n, v in result.items()})[
                schema.fieldNames()
            ]

    return df.mapInPandas(run, schema)


def batch_infer(
    df: DataFrame,
    factory: Callable[[], Callable[[list], Iterable]],
    text_col: str = "dialogue",
    output_col: str = "prediction",
) -> DataFrame:
    """Run a model over the rows: ``factory()`` loads it once per task, then maps batches."""
    schema = T.StructType(
        [f for f in df.schema if f.name != output_col] + [T.StructField(output_col, T.StringType())]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for frame in frames:
            texts = frame[text_col].tolist()
            yield frame.assign(**{output_col: list(model(texts))})[schema.fieldNames()]

    return df.mapInPandas(run, schema)
