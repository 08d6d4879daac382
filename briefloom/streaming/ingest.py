"""Landing folder -> tables as checkpointed file streams: each file is taken once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from briefloom.operators.encode import Limits, encode_features
from briefloom.operators.split import SplitRatios, split_hash
from briefloom.operators.validate import NA_VALUES, na_normalise
from briefloom.sources.csv import CORPUS_SCHEMA, CSV_OPTIONS, STRICT_OPTIONS

# Bytes of landed files that a task of ``stream_features`` takes.
TASK_BYTES = 16 << 20


def csv_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType = CORPUS_SCHEMA,
    na_values: Sequence[str] = NA_VALUES,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """New CSV files of a landing folder; ``max_files`` or ``max_bytes`` bounds one micro-batch.

    A file whose header differs from ``schema`` and a row with too few or too many cells stop
    the stream with an error; nothing is read by position.
    """
    reader = spark.readStream.schema(schema).options(**CSV_OPTIONS, **STRICT_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    elif max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    frame = reader.csv(landing)
    return na_normalise(frame, na_values=na_values) if na_values else frame


def append_table(
    stream: DataFrame, target: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Take everything that has landed, append it exactly once, and stop."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def stream_ingest(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    schema: T.StructType = CORPUS_SCHEMA,
    max_files: int | None = None,
) -> DataFrame:
    """Ingest what is new in ``landing``; the whole table so far is returned."""
    stream = csv_stream(spark, landing, schema, max_files=max_files)
    append_table(stream, target, checkpoint).awaitTermination()
    return spark.read.schema(schema).parquet(target)


def stream_features(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    encode,
    schema: T.StructType = CORPUS_SCHEMA,
    ratios: SplitRatios = SplitRatios(),
    limits: Limits = Limits(),
    max_files: int | None = None,
) -> DataFrame:
    """Landing folder -> split and encoded feature table.

    The hash split and the encoder (``word_encoder`` or ``piece_encoder``) work row by
    row, so the stream needs no state and no shuffle. A task sorts its rows by split, with their padded features, so
    a micro-batch holds about ``TASK_BYTES`` of files a core, whatever has landed, or ``max_files`` files.
    """
    max_bytes = TASK_BYTES * spark.sparkContext.defaultParallelism
    rows = split_hash(csv_stream(spark, landing, schema, max_files=max_files, max_bytes=max_bytes), "id", ratios)
    features = encode_features(rows, encode, limits)
    append_table(features, target, checkpoint, ["split"]).awaitTermination()
    return spark.read.parquet(target)
