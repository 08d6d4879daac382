"""Landing folder -> several targets, each file once; malformed rows are set aside, not fatal."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from briefloom.operators.validate import NA_VALUES, na_normalise
from briefloom.scaling import materialise
from briefloom.sinks.commits import publish, read_published
from briefloom.sinks.tables import Target
from briefloom.sources.csv import CORPUS_SCHEMA, CSV_OPTIONS, header_names, headers

# Fixed value: the columns of a file listing.
LISTING = "path string, modificationTime timestamp, length long, content binary"
# Files of one micro-batch, whose names pass through the driver that plans the read.
FILES_PER_BATCH = 1000


@dataclass(frozen=True)
class Outputs:
    """Where batches go: ``targets`` take the good rows, ``quarantine`` the others, ``log`` the commits."""

    targets: Sequence[Target]
    quarantine: Target
    log: str


def parse_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name, and (_path, _reason, _record), which are null in good rows.

    A row with too few or too many cells, or a cell not of its column's type, and a file whose
    header lacks or repeats a column (one row for the file, with its header) have a reason. A
    file without any line has no rows.
    """
    kinds = {f.name: f.dataType for f in schema}
    frames = []
    by_header = headers(spark, paths).groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
    for row in by_header:
        names = header_names(row["header"])
        if set(kinds) - set(names) or len(set(names)) != len(names):
            bad = spark.createDataFrame([(p, row["header"]) for p in row["paths"]], "_path string, _record string")
            empty = {name: F.lit(None).cast(kind) for name, kind in kinds.items()}
            frames.append(bad.withColumns({**empty, "_reason": F.lit("header")}))
            continue
        shape = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names]).add("_record", T.StringType())
        parsed = (
            spark.read.schema(shape).options(**CSV_OPTIONS, mode="PERMISSIVE", columnPruning="false")
            .option("columnNameOfCorruptRecord", "_record").csv([unquote(p) for p in row["paths"]])
        )
        reason = F.when(F.col("_record").isNotNull(), "row")
        frames.append(parsed.select(*kinds, F.col("_metadata.file_path").alias("_path"), reason.alias("_reason"), "_record"))
    out = spark.createDataFrame([], T.StructType([*schema, *(T.StructField(n, T.StringType()) for n in ("_path", "_reason", "_record"))]))
    for other in frames:
        out = out.unionByName(other)
    return out


def publish_batch(
    files: DataFrame, batch: int, outputs: Outputs, schema: T.StructType, na_values: Sequence[str] = NA_VALUES
) -> None:
    """Commit one micro-batch of (path) rows to all targets; a batch that is committed already adds nothing."""
    spark = files.sparkSession
    paths = [row["path"] for row in files.select("path").collect()]  # bounded by the files of a batch
    if not paths:
        return
    parsed = materialise(parse_files(spark, paths, schema))
    good = parsed.filter("_reason is null").select(*schema.fieldNames())
    bad = parsed.filter("_reason is not null").select(*[F.col(f"_{n}").alias(n) for n in ("path", "reason", "record")])
    good = na_normalise(good, na_values=na_values) if na_values else good
    publish(spark, outputs.log, f"batch-{batch:010d}", [(good, outputs.targets), (bad, [outputs.quarantine])])


def start_targets(
    spark: SparkSession,
    landing: str,
    outputs: Outputs,
    checkpoint: str,
    schema: T.StructType = CORPUS_SCHEMA,
    max_files: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Take everything that has landed in micro-batches and stop.

    The log belongs to the checkpoint: batches are known by number, so a new checkpoint needs a
    new log. Only names of files go through the stream; their contents are read by the batch.
    """
    files = (
        spark.readStream.format("binaryFile").schema(LISTING).option("maxFilesPerTrigger", max_files)
        .option("pathGlobFilter", "*.csv").load(landing).select("path")
    )
    return (
        files.writeStream.foreachBatch(lambda batch, number: publish_batch(batch, number, outputs, schema))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_target(spark: SparkSession, outputs: Outputs, name: str) -> DataFrame:
    """All committed batches of a target, or of the quarantine."""
    return read_published(spark, outputs.log, name, since=1)
