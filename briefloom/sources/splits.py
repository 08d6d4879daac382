"""Datasets stored as one table partitioned by split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The split names and the alias other tools use.
SPLITS = ("train", "val", "test")
ALIASES = {"validation": "val"}


def split_name(name: str) -> str:
    name = ALIASES.get(name, name)
    if name not in SPLITS:
        raise ValueError(f"unknown split {name!r}: use one of {SPLITS}")
    return name


def read_split_dataset(spark: SparkSession, root: str, split: str | None = None) -> DataFrame:
    """All splits, or one; a split is a directory, so the others are not even listed.

    A split stored under an alias is found by either name, and carries the usual one.
    """
    table = spark.read.parquet(root)
    if split is not None:
        name = split_name(split)
        stored = [name, *(alias for alias, own in ALIASES.items() if own == name)]
        table = table.filter(F.col("split").isin(stored))
    return table.replace(ALIASES, subset="split")
