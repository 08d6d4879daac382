"""A training corpus from ``documents`` in five stages; each works on all rows the one before kept.

Every stage but the last returns the columns of ``documents``. ``run`` stores each stage's rows as
Parquet in the cluster's shared folder and reads them again, so a lost executor costs no more than
one stage's tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from briefloom.llm.decontamination import decontaminated
from briefloom.llm.helpers import table
from briefloom.llm.jaccard_join import keep_first
from briefloom.llm.mixing import mix_sources
from briefloom.llm.quality_rules import ledger, rejected
from briefloom.llm.substring_dedup import substring_dedup
from briefloom.session import fresh_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the current policy does not reject; null and empty texts go."""
    return ledger(docs, kept=COLUMNS).filter(~rejected()).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five words, similarity 0.8): that of the smallest doc_id."""
    return keep_first(docs.select(*COLUMNS), width=5, percent=80)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 35 words or more that occur elsewhere; texts left empty go.

    What stays of a text keeps its line breaks and spacing.
    """
    cut = substring_dedup(docs, carry=COLUMNS[1:], spacing=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    size = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return cut.filter("n_removed = 0 or n_removed < n_words").select(
        "doc_id", text.alias("text"), "lang", "source", size.alias("n_chars")
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no benchmark item is found."""
    return decontaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed stream: words taken of each copy, and its position."""
    return mix_sources(docs).filter("taken > 0").select(
        "doc_id", "source", "size", "source_size", "target", "epoch", "taken", "position"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substrings),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# Near-duplicate components and template matches have no sensible SQL; tests/llm checks ``run``
# stage by stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = fresh_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
