"""Header CSV files with quoted, multi-line texts; columns go by name."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from briefloom.operators.validate import NA_VALUES, na_normalise

# Fixed value: the corpus columns.
CORPUS_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("id", "dialogue", "summary")]
)

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}
# A row with too few or too many cells is an error; all columns are parsed to notice it, and
# Spark compares each file's header with the schema it reads by.
STRICT_OPTIONS = {"mode": "FAILFAST", "columnPruning": "false", "enforceSchema": "false"}


def headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header) of every file: the first line of the piece at its beginning."""
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.monotonically_increasing_id().alias("at"),
    )
    return lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "at").alias("header"))


def header_names(header: str) -> list[str]:
    return next(csv.reader([header.removeprefix("\ufeff")]), [])


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = CORPUS_SCHEMA,
    na_values: Sequence[str] = NA_VALUES,
) -> DataFrame:
    """CSV rows; missing-value markers in string columns become null.

    Columns are found by the names in each file's header: files may hold them in different orders
    and may hold more. A file that lacks a column, a row with too few or too many cells, a
    cell that is not of its column's type, and a missing path are errors. ``schema=None``
    infers columns and types from the files. Finding the headers is a pass over the lines. Any file system the cluster can
    read works, object stores included. A multi-line file is read by one task, so large corpora should
    come as many files. File names and different headers pass through the driver, which
    plans the read.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    if schema is None:
        frame = spark.read.options(**CSV_OPTIONS, inferSchema="true").csv(given)
        return na_normalise(frame, na_values=na_values) if na_values else frame
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    by_header = headers(spark, given).groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
    frames = [_read_alike(spark, given, row["paths"], header_names(row["header"]), schema) for row in by_header]
    if not frames:
        return spark.createDataFrame([], schema)
    frame = frames[0]
    for other in frames[1:]:
        frame = frame.unionByName(other)
    return na_normalise(frame, na_values=na_values) if na_values else frame


def _read_alike(
    spark: SparkSession, given: list[str], paths: list[str], names: list[str], schema: T.StructType
) -> DataFrame:
    """Files with one header; columns of their folder names (``split=train``) count as well."""
    folders = set(re.findall(r"/([^/=]+)=[^/]*(?=/)", paths[0]))
    lacking = [f.name for f in schema if f.name not in names and f.name not in folders]
    if lacking or len(set(names)) != len(names):
        raise ValueError(f"columns {lacking or names} missing or repeated in the header of {sorted(paths)[:3]}")
    types = {f.name: f.dataType for f in schema}
    shape = T.StructType(
        [T.StructField(n, types.get(n, T.StringType())) for n in names]
        + [f for f in schema if f.name in folders and f.name not in names]
    )
    reader = spark.read.options(**CSV_OPTIONS, **STRICT_OPTIONS).schema(shape)
    if len(given) == 1 and not re.search(r"[*?\[{]", given[0]) and folders:
        reader = reader.option("basePath", given[0])
    return reader.csv([unquote(p) for p in paths]).select(*schema.fieldNames())
