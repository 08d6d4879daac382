"""The whole job: landed archives -> ingested corpus -> split features -> evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from briefloom.operators import validate
from briefloom.operators.encode import Limits, encode_features, encode_pairs
from briefloom.operators.metrics import REPORT_METRICS, evaluation_report
from briefloom.operators.split import SplitRatios, split_exact
from briefloom.scaling import materialise
from briefloom.sinks.manifest import MANIFEST_SCHEMA, Artifact, append_manifest, read_manifest, run_path, run_stamp
from briefloom.sinks.report import write_report
from briefloom.sinks.tables import Target, write_targets
from briefloom.sources.csv import CORPUS_SCHEMA
from briefloom.sources.csv_split import read_split_csv
from briefloom.sources.incremental import list_files, new_files
from briefloom.sources.zip_source import scan_archives

# Stage names, which are folder names below the run folder.
INGESTION = "data_ingestion"
VALIDATION = "data_validation"
TRANSFORMATION = "data_transformation"
EVALUATION = "model_evaluation"


@dataclass(frozen=True)
class Run:
    """Where one run writes. ``primary`` and ``backup`` are roots on any file system."""

    primary: str
    backup: str | None = None
    stamp: str = field(default_factory=run_stamp)
    primary_enabled: bool = True
    backup_enabled: bool = True
    formats: tuple[str, ...] = ("parquet",)

    def targets(self, stage: str, name: str, partition_by: tuple[str, ...] = ()) -> list[Target]:
        roots = [("primary", self.primary, self.primary_enabled)]
        if self.backup:
            roots.append(("backup", self.backup, self.backup_enabled))
        return [
            Target(
                f"{place}:{fmt}",
                run_path(root, self.stamp, stage, f"{name}.{fmt}"),
                fmt,
                partition_by,
                enabled,
            )
            for place, root, enabled in roots
            for fmt in self.formats
        ]

    def roots(self) -> list[tuple[str, str]]:
        """(place, root) of the enabled targets; nothing is written below the others."""
        found = [("primary", self.primary)] if self.primary_enabled else []
        return found + ([("backup", self.backup)] if self.backup and self.backup_enabled else [])

    def record(
        self, spark: SparkSession, stage: str, artifact: str, written: dict[str, str | None], sources: DataFrame | None = None
    ) -> list[Artifact]:
        """Append to the manifest of every enabled root: outputs with rows and bytes, and sources read."""
        rows = [Artifact(self.stamp, stage, artifact, t, uri, *_measured(spark, t, uri)) for t, uri in written.items()]
        for _, root in self.roots():
            path = f"{root.rstrip('/')}/manifest"
            append_manifest(spark, path, rows)
            if sources is not None:
                read = [F.lit(x) for x in (self.stamp, stage, artifact, "source")]
                named = [c.alias(f.name) for c, f in zip(read, MANIFEST_SCHEMA)]
                sources.select(
                    *named, F.lit(None).cast("string").alias("uri"), F.lit(None).cast("long").alias("n_rows"),
                    F.col("length").alias("n_bytes"), "path",
                ).write.mode("append").parquet(path)
        return rows

    def landed(self, spark: SparkSession) -> DataFrame:
        """(path) of the source files earlier runs have ingested, from any enabled root's manifest."""
        known = read_manifest(spark, f"{self.roots()[0][1].rstrip('/')}/manifest") if self.roots() else None
        if known is None:
            return spark.createDataFrame([], "path string")
        return known.filter("target = 'source'").select("path").distinct()

    def report(self, spark: SparkSession, stage: str, name: str, write) -> None:
        """``write(path)`` a report below every enabled root and record it."""
        form = name.rpartition(".")[2]
        written: dict[str, str | None] = {f"{p}:{form}": None for p in ("primary", *(["backup"] if self.backup else []))}
        for place, root in self.roots():
            written[f"{place}:{form}"] = path = run_path(root, self.stamp, stage, name)
            write(path)
        self.record(spark, stage, "report", written)


def _measured(spark: SparkSession, target: str, uri: str | None) -> tuple[int | None, int | None]:
    """(rows, bytes) of a stored table; rows of Parquet only, whose footers have them."""
    if uri is None:
        return None, None
    size = list_files(spark, uri).agg(F.sum("length")).first()[0]
    return (spark.read.parquet(uri).count() if target.endswith("parquet") else None), size


def _written(spark: SparkSession, written: dict[str, str | None], otherwise: DataFrame) -> DataFrame:
    """The stage's stored output, or its plan when nothing was stored in Parquet."""
    for name, path in written.items():
        if path and name.endswith(":parquet"):
            return spark.read.schema(otherwise.schema).parquet(path)
    return otherwise


def run_ingestion(
    spark: SparkSession, run: Run, source: str, na_values: Sequence[str] = validate.NA_VALUES
) -> DataFrame:
    """ZIP archives (or CSV files) of (id, dialogue, summary) -> the ingested table.

    Files that the manifest of an earlier run names as ingested are skipped; with nothing new the
    table is empty and nothing is written.
    """
    is_csv = source.endswith(".csv")
    listing = list_files(spark, source, None if source.endswith((".csv", ".zip")) else "*.zip")
    fresh = materialise(new_files(listing, run.landed(spark)).select("path", "length"))
    if fresh.limit(1).count() == 0:
        return spark.createDataFrame([], CORPUS_SCHEMA)
    if is_csv:
        corpus = read_split_csv(spark, [r["path"] for r in fresh.collect()], CORPUS_SCHEMA, na_values)
    else:
        corpus = scan_archives(spark, [r["path"] for r in fresh.collect()], CORPUS_SCHEMA, na_values)
    written = write_targets(corpus, run.targets(INGESTION, "ingested_data"))
    run.record(spark, INGESTION, "ingested_data", written, fresh)
    return _written(spark, written, corpus)


def run_validation(spark: SparkSession, run: Run, corpus: DataFrame) -> DataFrame:
    """Write the check report to every enabled target and return the rows that can be encoded."""
    report = validate.validate_pairs(corpus)
    run.report(spark, VALIDATION, "report.json", lambda path: report.write.mode("overwrite").json(path))
    return validate.valid_pairs(corpus)


def run_transformation(
    spark: SparkSession,
    run: Run,
    corpus: DataFrame,
    vocab: DataFrame | None = None,
    encode=None,
    ratios: SplitRatios = SplitRatios(),
    limits: Limits = Limits(),
    strata: Sequence[str] = (),
) -> DataFrame:
    """Split and encode: columns of the corpus + split, input_ids, attention_mask, labels.

    Give a word vocabulary (any size) or an ``encode`` function such as ``piece_encoder``.
    """
    if (vocab is None) == (encode is None):
        raise ValueError("give either vocab or encode")
    labelled = split_exact(corpus, "id", ratios, strata)
    features = (
        encode_pairs(labelled, vocab, limits)
        if encode is None
        else encode_features(labelled, encode, limits)
    )
    written = write_targets(features, run.targets(TRANSFORMATION, "features", ("split",)))
    run.record(spark, TRANSFORMATION, "features", written)
    return _written(spark, written, features)


def run_evaluation(
    spark: SparkSession,
    run: Run,
    predictions: DataFrame,
    metrics: Sequence[str] = REPORT_METRICS,
    form: str = "yaml",
    meteor_stages: Sequence = (),
) -> DataFrame:
    """Score (id, model, prediction, reference) rows and write the report to every enabled target.

    ``meteor_stages`` are tried on words that do not match exactly, such as ``metrics.stems``.
    """
    report = evaluation_report(predictions, metrics, meteor_stages=meteor_stages)
    run.report(spark, EVALUATION, f"evaluation_report.{form}", lambda path: write_report(report, path, form))
    return report
