"""Several targets published as one step: staged paths, and a commit record that readers resolve.

Every version of a target lies in a folder of its own below the target's path. A version exists
once the log has its record: one file, appended last, that names the folders of *all* targets.
What a failed step has staged is never read; running the step again writes it anew.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from briefloom.sinks.tables import Target, flat_columns, write_targets
from briefloom.sources.csv import CSV_OPTIONS, STRICT_OPTIONS

LOG_SCHEMA = "number long, version string, target string, root string, path string, format string, fields string"
# Fixed value: what a version may be called, as it names a folder.
VERSION_NAME = re.compile(r"[A-Za-z][A-Za-z0-9_.-]*$")


def committed(spark: SparkSession, log: str) -> DataFrame:
    """The commit log, a row for each version and target; empty where nothing has been published."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(log)
    except AnalysisException:
        return spark.createDataFrame([], LOG_SCHEMA)


def publish(
    spark: SparkSession, log: str, version: str, tables: Sequence[tuple[DataFrame, Sequence[Target]]]
) -> dict[str, str | None]:
    """Write every table to its enabled targets, then commit all of them with one record.

    Returns the folder of each target (``None`` where it is disabled). A version that is
    committed already is left as it is, so a step may be run again whatever became of it. The
    log has one writer at a time, and target names are unique within it.
    """
    if not VERSION_NAME.match(version):
        raise ValueError(f"not a version name: {version!r}")
    every = [t for _, targets in tables for t in targets]
    names = [t.name for t in every]
    if len(set(names)) != len(names):
        raise ValueError(f"target names repeat: {sorted(names)}")
    history = committed(spark, log)
    done = history.filter(F.col("version") == version).collect()  # a row a target
    if done:
        return {**dict.fromkeys(names), **{row["target"]: row["path"] for row in done}}
    number = (history.agg(F.max("number")).first()[0] or 0) + 1
    rows, folders = [], {}
    for df, targets in tables:
        staged = [replace(t, path=f"{t.path.rstrip('/')}/version={version}") for t in targets]
        folders |= write_targets(df, staged)
        for target, place in zip(targets, staged):
            if target.enabled:
                fields = (flat_columns(df) if target.format == "csv" else df).schema
                # the columns of folder names come last, as readers of folders have it
                inner = [f for f in fields if f.name not in target.partition_by]
                shape = T.StructType(inner + [fields[name] for name in target.partition_by])
                rows.append((number, version, target.name, target.path.rstrip("/"), place.path, target.format, shape.json()))
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log)
    return folders


def read_published(spark: SparkSession, log: str, target: str, since: int | None = None) -> DataFrame:
    """The last committed version of a target; with ``since``, all versions from that number on.

    A column ``version`` says which one a row is of.
    """
    rows = committed(spark, log).filter(F.col("target") == target)
    last = rows.agg(F.max("number")).first()[0]
    if last is None:
        raise ValueError(f"nothing has been published to {target!r}")
    chosen = rows.filter(F.col("number") >= (last if since is None else since)).orderBy("number").collect()  # a row a version
    shape = T.StructType.fromJson(json.loads(chosen[-1]["fields"])).add("version", T.StringType())
    reader = spark.read.schema(shape).option("basePath", chosen[-1]["root"])
    if chosen[-1]["format"] == "csv":
        reader = reader.options(**CSV_OPTIONS, **STRICT_OPTIONS)
    return reader.format(chosen[-1]["format"]).load([row["path"] for row in chosen])
