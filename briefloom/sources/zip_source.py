"""ZIP archives as a data source: one partition an archive, read by seeking, of any size.

A task opens its archive where it lies, reads the central directory at its end and then the first
CSV member as one stream, in batches of rows: no archive and no member is held whole. Deflate
has no split points, so a member is one task's work.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from briefloom.operators.validate import NA_VALUES
from briefloom.sources.archives import CSV_SUFFIX, NO_CSV_MESSAGE, _member_rows, zip_csv_rows
from briefloom.sources.csv import CORPUS_SCHEMA
from briefloom.sources.incremental import list_files

FORMAT = "zipped_csv"
# File systems that tasks can open without Spark.
OPENED = ("file", "s3", "s3a", "s3n", "gs", "hdfs")


def open_file(uri: str):
    """A seekable file of any file system that Arrow knows (local, S3, GCS, HDFS); s3a and s3n are S3."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if scheme in ("s3a", "s3n"):
        uri = f"s3:{rest}"
    elif scheme == "file":
        return open("/" + rest.lstrip("/"), "rb")  # no URI decoding: paths come as Spark lists them
    files, path = fs.FileSystem.from_uri(uri)
    return pa.PythonFile(files.open_input_file(path), "r")


def first_csv(archive: zipfile.ZipFile, where: str) -> zipfile.ZipInfo:
    member = next((m for m in archive.infolist() if m.filename.endswith(CSV_SUFFIX)), None)
    if member is None:
        raise ValueError(f"{NO_CSV_MESSAGE} ({where})")
    return member


class Archive(InputPartition):
    def __init__(self, uri: str):
        super().__init__(uri)
        self.uri = uri


class ZippedCsvReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.names = [n for n in schema.fieldNames() if n != "path"]
        self.uris = options["archives"].split("\n") if options.get("archives") else []
        self.missing = set(options["missing"].split("\n")) if "missing" in options else set()

    def partitions(self) -> list[InputPartition]:
        return [Archive(uri) for uri in self.uris]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        names = ["path", *self.names]
        with open_file(partition.uri) as file, zipfile.ZipFile(file) as archive:
            member = first_csv(archive, partition.uri)
            with archive.open(member) as stream:
                for rows in _member_rows(stream, self.names, self.missing, f"{partition.uri}: {member.filename}"):
                    columns = [[partition.uri] * len(rows), *zip(*rows)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names)


class ZippedCsv(DataSource):
    """``spark.read.format("zipped_csv")``: options ``archives`` (URIs, one a line) and ``missing`` (markers of null)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ZippedCsvReader(schema, self.options)


def scan_archives(
    spark: SparkSession,
    uris: Sequence[str],
    schema: T.StructType | str = CORPUS_SCHEMA,
    na_values: Sequence[str] = NA_VALUES,
    keep_path: bool = False,
) -> DataFrame:
    """Rows of the first CSV member of each archive; columns go by the names in its header.

    A member that lacks a column, a row with too few or too many cells and an archive without a CSV
    member are errors; a cell that is not of its column's type is one in ANSI mode (Spark's
    default). No archives give no rows. Archive names pass through the driver, which plans the read.
    Archives on a file system that Arrow does not know are read whole by Spark, up to 2 GB each.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    uris = [u if ":" in u else f"file:{u}" for u in uris]
    if any(u.split(":")[0] not in OPENED for u in uris):
        return zip_csv_rows(spark.read.format("binaryFile").load(list(uris)), schema, na_values, keep_path)
    if not uris:
        rows = spark.createDataFrame([], "path string, " + ", ".join(f"`{n}` string" for n in schema.fieldNames()))
    else:
        spark.dataSource.register(ZippedCsv)
        raw = T.StructType([T.StructField("path", T.StringType())] + [T.StructField(n, T.StringType()) for n in schema.fieldNames()])
        reader = spark.read.format(FORMAT).schema(raw).option("archives", "\n".join(uris))
        if na_values:
            reader = reader.option("missing", "\n".join(na_values))
        rows = reader.load()
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    return rows.select(*(["path"] if keep_path else []), *typed)


def scan_zip_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str = CORPUS_SCHEMA,
    na_values: Sequence[str] = NA_VALUES,
    keep_path: bool = False,
) -> DataFrame:
    """All ``*.zip`` files under ``path`` (or the files a glob names), whatever their size."""
    listing = list_files(spark, path, None if path.endswith(".zip") else "*.zip")
    return scan_archives(spark, [r["path"] for r in listing.select("path").collect()], schema, na_values, keep_path)
