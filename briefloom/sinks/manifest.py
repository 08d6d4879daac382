"""Run stamps, run folders and the artifact manifest table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import astuple, dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The run stamp format and the root folder name.
STAMP_FORMAT = "%Y_%m_%dT%H_%M_%SZ"
ARTIFACT_ROOT = "artifacts"

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("run_ts", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("artifact", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("path", T.StringType()),
    ]
)


def run_stamp(now: datetime | None = None) -> str:
    """One stamp per run, taken on the driver and passed to every stage."""
    return (now or datetime.now(timezone.utc)).strftime(STAMP_FORMAT)


def run_path(base: str, stamp: str, stage: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), ARTIFACT_ROOT, stamp, stage, *parts])


@dataclass(frozen=True)
class Artifact:
    """One output of a stage; ``uri`` is ``None`` where its target is switched off.

    Rows of target ``source`` say what was read: ``path`` is the landed file, as listings have it.
    """

    run_ts: str
    stage: str
    artifact: str
    target: str
    uri: str | None
    n_rows: int | None = None
    n_bytes: int | None = None
    path: str | None = None


def artifact_rows(spark: SparkSession, artifacts: Iterable[Artifact]) -> DataFrame:
    return spark.createDataFrame([astuple(a) for a in artifacts], MANIFEST_SCHEMA)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest table; empty where none has been written."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def append_manifest(spark: SparkSession, path: str, artifacts: Iterable[Artifact]) -> DataFrame:
    """Append artifact rows to the manifest table and return the whole table."""
    artifact_rows(spark, artifacts).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)
