"""``.npy`` files by ranges of rows: one large file is read by many tasks.

Tasks read the headers of the listed files, each header becomes as many row ranges as its file needs, and
tasks seek to their range. No file is held whole, and no listing passes through the driver.
"""

from __future__ import annotations

import ast
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from briefloom.scaling import materialise, one_task_each
from briefloom.sources.arrays import NPY_ROWS
from briefloom.sources.incremental import list_files
from briefloom.sources.zip_source import open_file

# Fixed values of the format: its first bytes, and the alignment of the data.
MAGIC = b"\x93NUMPY"
ALIGNED = 64
RANGE_BYTES = 32 << 20
# Bytes of vectors in one Arrow batch.
BATCH_BYTES = 4 << 20

HEADER = "path string, dtype string, by_column boolean, n_rows long, width long, start long"


def header_bytes(dtype: str, shape: tuple[int, ...]) -> bytes:
    """The header of a row-major array, version 1.0."""
    described = repr({"descr": dtype, "fortran_order": False, "shape": shape}).encode()
    pad = -(len(MAGIC) + 4 + len(described) + 1) % ALIGNED
    described += b" " * pad + b"\n"
    return MAGIC + b"\x01\x00" + struct.pack("<H", len(described)) + described


def read_header(file, where: str) -> tuple[str, bool, tuple[int, ...], int]:
    """(dtype, column order, shape, first data byte); arrays of objects are refused, as they are pickles."""
    start = file.read(len(MAGIC) + 2)
    if len(start) < len(MAGIC) + 2 or start[: len(MAGIC)] != MAGIC:
        raise ValueError(f"not an array file: {where}")
    form = "<H" if start[len(MAGIC)] == 1 else "<I"
    (length,) = struct.unpack(form, file.read(struct.calcsize(form)))
    described = ast.literal_eval(file.read(length).decode("utf-8" if start[len(MAGIC)] >= 3 else "latin1").strip())
    dtype = described["descr"]
    if not isinstance(dtype, str) or np.dtype(dtype).kind not in "biuf":
        raise ValueError(f"not an array of numbers: {where}")
    return dtype, described["fortran_order"], described["shape"], len(start) + struct.calcsize(form) + length


def headers(files: DataFrame) -> DataFrame:
    """One row per file of ``path`` and ``length``; a file shorter or longer than its header says is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path, length in zip(*(c.to_pylist() for c in batch.columns)):
                with open_file(path) as file:
                    dtype, by_column, shape, start = read_header(file, path)
                n_rows = shape[0] if shape else 1
                width = math.prod(shape[1:])
                if start + n_rows * width * np.dtype(dtype).itemsize != length:
                    raise ValueError(f"an array file of {length} bytes does not fit its header: {path}")
                # columns of a column-major array of more dimensions are not those of its rows, read in order
                if by_column and len(shape) > 2:
                    raise ValueError(f"column-major arrays of more than two dimensions are not read: {path}")
                found.append((path, dtype, by_column, n_rows, width, start))
            names = ["path", "dtype", "by_column", "n_rows", "width", "start"]
            kinds = [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*found)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return files.select("path", "length").mapInArrow(run, HEADER)


def _read_rows(file, dtype: np.dtype, by_column: bool, n_rows: int, width: int, start: int, first: int, count: int) -> np.ndarray:
    """Rows ``first`` to ``first + count`` as a matrix."""

    def at(element: int, many: int) -> np.ndarray:
        file.seek(start + element * dtype.itemsize)
        return np.frombuffer(file.read(many * dtype.itemsize), dtype)

    if not by_column:
        return at(first * width, count * width).reshape(count, width)
    return np.stack([at(c * n_rows + first, count) for c in range(width)], axis=1)


def ranges(found: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows (path, row, vector) of the files that ``headers`` describes, read range by range."""
    item = F.regexp_extract("dtype", r"(\d+)$", 1).cast("long")
    step = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(range_bytes) / F.greatest(item * F.col("width"), F.lit(1))))
    cut = found.filter("n_rows > 0").withColumn("step", step).withColumn(
        "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_rows") - 1, F.col("step")))
    )
    names = ["path", "dtype", "by_column", "n_rows", "width", "start", "step", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, kind, by_column, n_rows, width, start, step, first in zip(*(c.to_pylist() for c in batch.columns)):
                dtype = np.dtype(kind)
                at_once = max(1, BATCH_BYTES // max(1, width * 8))
                with open_file(path) as file:
                    for row in range(first, min(first + step, n_rows), at_once):
                        count = min(at_once, first + step - row, n_rows - row)
                        values = _read_rows(file, dtype, by_column, n_rows, width, start, row, count).astype(np.float64)
                        vectors = pa.ListArray.from_arrays(
                            pa.array(np.arange(count + 1) * width, pa.int32()), pa.array(values.reshape(-1))
                        )
                        numbers = pa.array(np.arange(row, row + count), pa.int64())
                        yield pa.RecordBatch.from_arrays([pa.array([path] * count, pa.string()), numbers, vectors], ["path", "row", "vector"])

    return one_task_each(materialise(cut.select(*names)), "path", "first").mapInArrow(run, NPY_ROWS)


def read_npy_ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, row, vector) of every ``*.npy`` file below ``path``, in tasks of about ``range_bytes``.

    A one-dimensional array has vectors of one element, an array of more than two dimensions flattened ones, a single
    number is one row; arrays without rows give none. Files must lie where Arrow can open them; ``read_npy`` takes
    whole files from any file system that Spark knows.
    """
    return ranges(headers(list_files(spark, path, "*.npy")), range_bytes)
