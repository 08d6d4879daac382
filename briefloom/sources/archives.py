"""ZIP archives: the first CSV member of each becomes rows."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from briefloom.operators.validate import NA_VALUES
from briefloom.sources.csv import CORPUS_SCHEMA
from briefloom.sources.csv_split import CELL_LIMIT

# Member suffix (case counts) and the error for an archive without one.
CSV_SUFFIX = ".csv"
NO_CSV_MESSAGE = "No CSV file found in ZIP archive."
CHUNK_ROWS = 5_000
# Characters after which a chunk ends: rows of long cells go on in small chunks.
CHUNK_CHARS = 16 << 20
# A binary value holds no more.
MAX_ARCHIVE = 2**31 - 1


def _member_rows(stream, names: list[str], missing: set[str], where: str) -> Iterator[list[list]]:
    """Chunks of rows of one CSV stream, columns found by name; a malformed row is an error."""
    csv.field_size_limit(CELL_LIMIT)
    reader = csv.reader(io.TextIOWrapper(stream, "utf-8-sig", newline=""))
    header = next(reader, [])
    lacking = [n for n in names if n not in header]
    if lacking:
        raise ValueError(f"columns {lacking} missing in the header of {where}")
    places = [header.index(n) for n in names]
    chunk: list[list] = []
    chars = 0
    for row in reader:
        if not row:  # an empty line
            continue
        if len(row) != len(header):
            raise ValueError(f"{len(row)} cells instead of {len(header)} in line {reader.line_num} of {where}")
        chunk.append([None if row[p] in missing else row[p] for p in places])
        chars += sum(map(len, row))
        if len(chunk) == CHUNK_ROWS or chars >= CHUNK_CHARS:
            yield chunk
            chunk, chars = [], 0
    if chunk:
        yield chunk


def zip_csv_rows(
    archives: DataFrame,
    schema: T.StructType = CORPUS_SCHEMA,
    na_values: Sequence[str] = NA_VALUES,
    keep_path: bool = False,
) -> DataFrame:
    """Rows of (path, content) archives, read member by member in chunks.

    Archives are read in parallel; one archive is one stream, as deflate has no split
    points, and its rows are passed on in chunks without holding the member in memory.
    """
    names = schema.fieldNames()
    raw = T.StructType(
        [T.StructField("path", T.StringType())]
        + [T.StructField(n, T.StringType()) for n in names]
    )
    missing = set(na_values)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    member = next(
                        (m for m in archive.namelist() if m.endswith(CSV_SUFFIX)), None
                    )
                    if member is None:
                        raise ValueError(f"{NO_CSV_MESSAGE} ({path})")
                    with archive.open(member) as stream:
                        for rows in _member_rows(stream, names, missing, f"{path}: {member}"):
                            yield pd.DataFrame(rows, columns=names, dtype=object).assign(path=path)[raw.fieldNames()]

    rows = archives.select("path", "content").mapInPandas(run, raw)
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    return rows.select(*(["path"] if keep_path else []), *typed)


def read_zip_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = CORPUS_SCHEMA,
    na_values: Sequence[str] = NA_VALUES,
) -> DataFrame:
    """All ``*.zip`` files under ``path`` (or the files a glob names); each up to 2 GB."""
    return zip_csv_rows(zip_files(spark, path), schema, na_values)


def zip_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, modificationTime, length, content) of the archives; too large ones are named before any is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if not path.endswith(".zip"):
        reader = reader.option("pathGlobFilter", "*.zip")
    files = reader.load(path)
    large = [r["path"] for r in files.filter(F.col("length") > MAX_ARCHIVE).select("path").take(20)]
    if large:
        raise ValueError(f"archives above {MAX_ARCHIVE} bytes cannot be read whole: {large}")
    return files
