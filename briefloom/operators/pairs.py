"""(id, dialogue, summary) rows from turn tables and from plain documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from briefloom.functions.text import let, sentences

PAIR_COLUMNS = ("id", "dialogue", "summary")


def select_pair_columns(
    df: DataFrame, id_col: str = "id", dialogue: str = "dialogue", summary: str = "summary"
) -> DataFrame:
    return df.select(
        F.col(id_col).cast("string").alias("id"),
        F.col(dialogue).alias("dialogue"),
        F.col(summary).alias("summary"),
    )


def _ordered_turns(turns: DataFrame, chunk_turns: int) -> DataFrame:
    """One row per conversation with its turns in order: ``array<struct<line,text>>``.

    Turns are first gathered per (conversation, stretch of ``chunk_turns`` turns), so a
    very long conversation is sorted in many tasks; the second step only strings the
    ready pieces together.
    """
    piece = F.floor(F.col("turn") / chunk_turns)
    entry = F.struct(
        "turn",
        "role",
        "text",
        F.concat_ws(": ", "role", F.coalesce("text", F.lit(""))).alias("line"),
    )
    pieces = (
        turns.withColumn("_piece", piece)
        .groupBy("conv_id", "_piece")
        .agg(F.sort_array(F.collect_list(entry)).alias("_part"))
        .select(
            "conv_id",
            "_piece",
            F.transform("_part", lambda t: F.struct(t["line"], t["text"])).alias("_part"),
        )
    )
    return pieces.groupBy("conv_id").agg(
        F.flatten(
            F.transform(
                F.sort_array(F.collect_list(F.struct("_piece", "_part"))), lambda p: p["_part"]
            )
        ).alias("turns")
    )


def assemble_dialogue(turns: DataFrame, chunk_turns: int = 512) -> DataFrame:
    """(conv_id, turn, role, text) rows -> one ``role: text`` dialogue per conversation."""
    ordered = _ordered_turns(turns, chunk_turns)
    return ordered.select(
        F.col("conv_id").cast("string").alias("id"),
        F.array_join(F.transform("turns", lambda t: t["line"]), "\n").alias("dialogue"),
        F.size("turns").alias("n_turns"),
    )


def pairs_from_turns(turns: DataFrame, chunk_turns: int = 512) -> DataFrame:
    """Dialogue = every turn but the last; summary = the last turn's text."""
    ordered = _ordered_turns(turns, chunk_turns).filter(F.size("turns") >= 2)
    lines = F.transform("turns", lambda t: t["line"])
    return ordered.select(
        F.col("conv_id").cast("string").alias("id"),
        F.array_join(F.slice(lines, F.lit(1), F.size("turns") - 1), "\n").alias("dialogue"),
        F.coalesce(F.element_at("turns", -1)["text"], F.lit("")).alias("summary"),
    )


def _head_and_rest(parts: Column) -> Column:
    return F.when(
        F.size(parts) >= 2,
        F.array(
            F.struct(
                F.array_join(F.slice(parts, F.lit(2), F.size(parts)), " ").alias("dialogue"),
                F.get(parts, F.lit(0)).alias("summary"),
            )
        ),
    )


def pairs_from_documents(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Documents of two or more sentences: summary = the first, dialogue = the rest."""
    # inline() evaluates the sentences once; a filter on them would be pushed below the
    # projection and split every text a second time.
    return documents.select(
        F.col(id_col).cast("string").alias("id"),
        F.inline(let(sentences(F.col(text_col)), _head_and_rest)),
    )
