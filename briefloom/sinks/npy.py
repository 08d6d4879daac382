"""Vectors as ``.npy`` files, one for each Arrow batch of rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from briefloom.sinks.files import file_writer
from briefloom.sources.npy_ranges import header_bytes


def write_npy(df: DataFrame, folder: str, vector: str, key: str, dtype: str = "<f4") -> DataFrame:
    """Writes the vectors and returns (name, row, key): which row of which file holds whose vector; the result is lazy.

    ``key`` must differ between rows and not be null: a file is named by the first one in it, and a repeated attempt
    replaces it. Null vectors, null elements and vectors of different lengths in one batch are errors.
    """
    kind = df.schema[key].dataType
    shape = T.StructType([T.StructField("name", T.StringType()), T.StructField("row", T.LongType()), T.StructField("key", kind)])

    def run(batches):
        put = file_writer(folder)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, vectors = batch.columns
            sizes = pc.unique(pc.list_value_length(vectors))
            if len(sizes) != 1 or sizes[0].as_py() is None or keys.null_count or vectors.flatten().null_count:
                raise ValueError("an array file holds vectors of one length, without nulls, and a key for each")
            content = vectors.flatten().to_numpy(zero_copy_only=False).astype(dtype)
            name = f"vectors-{keys[0].as_py()}.npy"
            put(name, header_bytes(dtype, (batch.num_rows, sizes[0].as_py())) + content.tobytes())
            rows = pa.array(np.arange(batch.num_rows), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([name] * batch.num_rows), rows, keys], ["name", "row", "key"])

    return df.select(F.col(key), F.col(vector)).mapInArrow(run, shape)
