"""Dense numeric arrays: Parquet vector tables and landed ``.npy`` files."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHUNK_VECTORS = 4_096

NPY_ROWS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("row", T.LongType()),
        T.StructField("vector", T.ArrayType(T.DoubleType())),
    ]
)


def read_arrays(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def npy_vectors(files: DataFrame) -> DataFrame:
    """(path, content) files -> one row per vector; pickled objects are refused."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                array = np.atleast_1d(np.load(io.BytesIO(content), allow_pickle=False))
                table = array.reshape(len(array), -1).astype("float64")
                for start in range(0, len(table), CHUNK_VECTORS):
                    part = table[start : start + CHUNK_VECTORS]
                    yield pd.DataFrame(
                        {
                            "path": path,
                            "row": np.arange(start, start + len(part)),
                            "vector": list(part),
                        }
                    )

    return files.select("path", "content").mapInPandas(run, NPY_ROWS)


def read_npy(spark: SparkSession, path: str) -> DataFrame:
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.npy")
        .load(path)
    )
    return npy_vectors(files)
