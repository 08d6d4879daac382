"""Vocabularies built from a corpus: whole words, and sub-word pieces with log scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from briefloom.functions.text import word_tokens
from briefloom.scaling import heaviest, materialise

# Special ids of the summarisation checkpoint family.
PAD_ID = 0
EOS_ID = 1
UNKNOWN_ID = 105
FIRST_WORD_ID = 106
# Fixed value: vocabulary size of the same family; the default size limit.
DEFAULT_VOCAB_SIZE = 96_103


def word_counts(df: DataFrame, text_col: str = "text", unicode: bool = False) -> DataFrame:
    """(word, count); counts are combined before the shuffle, so hot words cost little."""
    return (
        df.select(F.explode(word_tokens(F.col(text_col), unicode)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def _next_id(name: str) -> Column:
    """Ids by falling count; used on a vocabulary's rows only, whose number is limited."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("count"), F.asc(name))
    return (F.row_number().over(order) + (FIRST_WORD_ID - 1)).cast("int")


def build_vocab(
    df: DataFrame, text_col: str = "text", size: int = DEFAULT_VOCAB_SIZE, unicode: bool = False
) -> DataFrame:
    """(word, count, id): the ``size`` most frequent words, ids from 106 in that order."""
    return vocab_of_counts(word_counts(df, text_col, unicode), size).select("word", "count", "id")


def vocab_of_counts(counts: DataFrame, size: int = DEFAULT_VOCAB_SIZE) -> DataFrame:
    """The ``size`` most frequent words of a (word, count, ...) table with their ids."""
    top = heaviest(materialise(counts), size, "count", "word")
    return top.withColumn("id", _next_id("word"))


def substrings(word: Column, longest: int) -> Column:
    starts = F.sequence(F.lit(1), F.length(word))
    return F.flatten(
        F.transform(
            starts,
            lambda start: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(longest), F.length(word) - start + 1)),
                lambda n: F.substring(word, start, n),
            ),
        )
    )


def build_pieces(
    df: DataFrame,
    text_col: str = "text",
    size: int = 8_000,
    longest: int = 8,
    unicode: bool = False,
) -> DataFrame:
    """(piece, count, logp, id): frequent substrings of words plus every single character.

    Substrings are cut from *distinct* words weighted by their counts. ``logp`` is the log
    share of the kept pieces' total, to 6 places: the last bits of a logarithm differ between
    platforms, and equally good segmentations must not depend on them. Single characters are
    kept whatever their rank, so every word can be segmented.
    """
    return pieces_of_counts(word_counts(df, text_col, unicode), size, longest)


def pieces_of_counts(words: DataFrame, size: int = 8_000, longest: int = 8) -> DataFrame:
    """``build_pieces`` of a (word, count) table."""
    counts = materialise(
        words.select(F.explode(substrings(F.col("word"), longest)).alias("piece"), "count")
        .groupBy("piece")
        .agg(F.sum("count").alias("count"))
    )
    singles = counts.filter(F.length("piece") == 1)
    kept = heaviest(counts, size, "count", "piece").unionByName(singles).distinct()
    whole = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return kept.select(
        "piece",
        "count",
        F.round(F.ln(F.col("count") / whole), 6).alias("logp"),
        _next_id("piece").alias("id"),
    )
