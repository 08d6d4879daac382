"""Writing tables: CSV, split Parquet, and several targets from one computation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from briefloom.session import fresh_folder
from briefloom.sources.csv import CSV_OPTIONS


def flat_columns(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, which is what a CSV cell can hold."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[
            F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, nested) else f.name
            for f in df.schema
        ]
    )


def write_csv(df: DataFrame, *paths: str, partition_by: Sequence[str] = ()) -> list[str]:
    """Header CSV without a row index to every path; existing output is replaced."""
    write_targets(df, [Target(p, p, "csv", tuple(partition_by)) for p in paths])
    return list(paths)


def write_arrays(df: DataFrame, *paths: str) -> list[str]:
    write_targets(df, [Target(p, p, "parquet") for p in paths])
    return list(paths)


@dataclass(frozen=True)
class Target:
    """One place a table goes to; any path Spark can write, local or object store."""

    name: str
    path: str
    format: str = "parquet"
    partition_by: tuple[str, ...] = ()
    enabled: bool = True


def write_targets(df: DataFrame, targets: Sequence[Target]) -> dict[str, str | None]:
    """Write every enabled target; a disabled one is reported as ``None``.

    The table is computed once. The first Parquet target feeds the others; with several
    targets and none in Parquet, an intermediate table in the shared folder does. Reading a
    written table back survives lost executors, which a cache does not.
    """
    enabled = [t for t in targets if t.enabled]
    parquet_first = sorted(enabled, key=lambda t: t.format != "parquet")
    source = df
    if len(enabled) > 1 and parquet_first[0].format != "parquet":
        shared = fresh_folder(df.sparkSession, "targets")
        df.write.parquet(shared)
        source = df.sparkSession.read.parquet(shared)
    for target in parquet_first:
        out = flat_columns(source) if target.format == "csv" else source
        writer = out.write.mode("overwrite").format(target.format)
        if target.format == "csv":
            writer = writer.options(**CSV_OPTIONS, quoteAll="true")
        if target.partition_by:
            writer = writer.partitionBy(*target.partition_by)
        writer.save(target.path)
        if source is df and target.format == "parquet" and len(enabled) > 1:
            # columns of folder names come back last
            source = df.sparkSession.read.schema(df.schema).parquet(target.path).select(*df.columns)
    return {t.name: t.path if t.enabled else None for t in targets}


def write_splits(df: DataFrame, root: str) -> str:
    """One directory per split, so that a reader of one split opens no other."""
    write_targets(df, [Target("splits", root, "parquet", ("split",))])
    return root
