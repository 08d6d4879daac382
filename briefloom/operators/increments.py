"""Word counts that grow with new files: stored per increment and merged, never counted again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from briefloom.functions.text import word_tokens
from briefloom.scaling import materialise
from briefloom.sinks.commits import committed, publish, read_published
from briefloom.sinks.tables import Target

FILES = ("path", "length", "modified")
# Increments that are read one by one before they are merged into one.
MERGE_AFTER = 16


def word_and_document_counts(df: DataFrame, text_col: str = "text", unicode: bool = False) -> DataFrame:
    """(word, count, docs): occurrences, and rows that hold the word; combined before the shuffle."""
    words = word_tokens(F.col(text_col), unicode)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def tallies(tokens, count, docs):
        return F.transform(tokens, lambda w: F.struct(w.alias("word"), count.alias("count"), docs.alias("docs")))

    both = F.concat(tallies(words, one, none), tallies(F.array_distinct(words), none, one))
    return df.select(F.explode(both).alias("t")).groupBy("t.word").agg(F.sum("t.count").alias("count"), F.sum("t.docs").alias("docs"))


def _log(store: str) -> str:
    return f"{store.rstrip('/')}/log"


def _since(spark: SparkSession, store: str) -> int:
    """Number of the last merged version: what came before is contained in it."""
    merged = committed(spark, _log(store)).filter(F.col("version").startswith("merged-"))
    return merged.agg(F.max("number")).first()[0] or 1


def known_files(spark: SparkSession, store: str) -> DataFrame:
    """(path, length, modified) of the files counted so far."""
    return read_published(spark, _log(store), "files", _since(spark, store)).select(*FILES)


def stored_counts(spark: SparkSession, store: str) -> DataFrame:
    """(word, count, docs) over all files counted so far."""
    parts = read_published(spark, _log(store), "counts", _since(spark, store))
    return parts.groupBy("word").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def stored_rows(spark: SparkSession, store: str) -> int:
    """Rows of all files counted so far: what document frequencies are shares of."""
    return read_published(spark, _log(store), "sizes", _since(spark, store)).agg(F.sum("n_rows")).first()[0]


def _publish(spark: SparkSession, store: str, kind: str, files: DataFrame, counts: DataFrame, sizes: DataFrame) -> None:
    number = (committed(spark, _log(store)).agg(F.max("number")).first()[0] or 0) + 1
    parts = {"counts": counts, "files": files, "sizes": sizes}
    targets = [(df, [Target(name, f"{store.rstrip('/')}/{name}")]) for name, df in parts.items()]
    publish(spark, _log(store), f"{kind}-{number:06d}", targets)


def add_counts(
    spark: SparkSession,
    store: str,
    listing: DataFrame,
    read: Callable[[DataFrame], DataFrame],
    text_col: str = "text",
    unicode: bool = False,
    merge_after: int = MERGE_AFTER,
) -> int:
    """Count what ``listing`` (path, length, modified) has beyond the store; returns the number of new files.

    ``read`` turns a listing into rows. Counts, files and row totals of one increment are
    committed together, so a run that fails adds nothing, and one that is repeated adds nothing
    twice. A file that is known but has changed is an error: its old words cannot be taken back, and
    the store has to be built again. After ``merge_after`` increments they are merged into one version.
    """
    files = materialise(listing.select(*FILES))
    begun = committed(spark, _log(store)).limit(1).count() > 0
    if begun:
        known = materialise(known_files(spark, store))
        old = known.select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
        changed = files.join(old, "path").filter("length <> _length or modified <> _modified").select("path").take(3)
        if changed:
            raise ValueError(f"counted files have changed: {[row['path'] for row in changed]}")
        files = materialise(files.join(known.select("path"), "path", "left_anti"))
    n_files = files.count()
    if not n_files:
        return 0
    rows = read(files)
    sizes = rows.agg(F.count(F.lit(1)).alias("n_rows"))
    _publish(spark, store, "counted", files, word_and_document_counts(rows, text_col, unicode), sizes)
    numbers = committed(spark, _log(store)).filter(F.col("number") >= _since(spark, store))
    if numbers.select("number").distinct().count() > merge_after:
        total = spark.range(1).select(F.lit(stored_rows(spark, store)).cast("long").alias("n_rows"))
        _publish(spark, store, "merged", known_files(spark, store), stored_counts(spark, store), total)
    return n_files
