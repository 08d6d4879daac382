"""File listings, and the files a manifest does not know yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A read is planned on the driver, which therefore has to hold its file names.
MAX_FILES_PER_READ = 200_000


def list_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(path, rel_path, length, modified) of every file below ``root``; contents stay unread."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    start = F.locate(base, F.col("path")) + len(base)
    return reader.load(root).select(
        "path",
        F.substring(F.col("path"), start, F.length("path")).alias("rel_path"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def new_files(listing: DataFrame, manifest: DataFrame, key: str = "path") -> DataFrame:
    """Files not landed yet: what already has a manifest row is skipped."""
    return listing.join(manifest.select(key).distinct(), key, "left_anti")


def read_files(
    spark: SparkSession,
    files: DataFrame,
    schema: T.StructType,
    format: str = "parquet",
    base: str | None = None,
    max_files: int = MAX_FILES_PER_READ,
    **options: str,
) -> DataFrame:
    """Read exactly the listed files; ``base`` keeps the columns in their folder names.

    More than ``max_files`` names is an error, not a cut: take them in several reads.
    """
    paths = [row["path"] for row in files.select("path").take(max_files + 1)]
    if len(paths) > max_files:
        raise ValueError(f"more than {max_files} files: read them in several steps")
    if not paths:
        return spark.createDataFrame([], schema)
    if base:
        options["basePath"] = base
    return spark.read.schema(schema).options(**options).format(format).load(paths)
