"""Text -> fixed-length id arrays.

A vocabulary is limited by its size argument, so it is sent to the executors once and
every row is encoded where it lies: no explode, no join, no regrouping of tokens. Texts are
cut and looked up by an Arrow kernel, in steps of limited size. A table too large to send is
joined instead (``encode_by_join``), with the same result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from briefloom.functions.overlap import steps
from briefloom.functions.text import word_text, word_tokens
from briefloom.functions.tokens import BYTES_PER_STEP, spaced, words
from briefloom.operators.split import SplitRatios, split_exact
from briefloom.operators.vocab import EOS_ID, PAD_ID, UNKNOWN_ID
from briefloom.scaling import MAX_BROADCAST_ROWS, left_lookup, materialise, row_count_at_most

# Default limits of the input and target sequences.
MAX_INPUT = 1024
MAX_TARGET = 128

IDS = T.ArrayType(T.IntegerType())


@dataclass(frozen=True)
class Limits:
    max_input: int = MAX_INPUT
    max_target: int = MAX_TARGET
    label_pad: int = PAD_ID


class SentTable:
    """A lookup table on its way to the executors; mappings are built once per worker, not per batch."""

    def __init__(self, table: pa.Table):
        self.table = table
        self.built: dict = {}

    def mapping(self, key: str, value: str) -> dict:
        """{key: value} of two of the table's columns."""
        if (key, value) not in self.built:
            keys, values = (self.table.column(c).to_pylist() for c in (key, value))
            self.built[key, value] = dict(zip(keys, values))
        return self.built[key, value]

    def __getstate__(self):
        return {"table": self.table, "built": {}}


def send_table(table: DataFrame, max_rows: int = MAX_BROADCAST_ROWS):
    """Broadcast a lookup table of measured size; ``None`` if it has too many rows or bytes."""
    if not row_count_at_most(table, max_rows):
        return None
    return table.sparkSession.sparkContext.broadcast(SentTable(table.toArrow().combine_chunks()))


def looked_up(tokens: pa.Array, mapping: dict, type_: pa.DataType, missing=None) -> pa.Array:
    """Value of every token of flat ``tokens``: each different token of the batch is looked up once."""
    words = pc.cast(tokens, pa.string()).dictionary_encode()
    found = [mapping.get(word, missing) for word in words.dictionary.to_pylist()]
    return pa.array(found, type_).take(words.indices)


def regroup(values: pa.Array, lengths) -> pa.ListArray:
    """Cut a flat array into lists of the given lengths."""
    ends = pc.cumulative_sum(pc.cast(lengths, pa.int32()))
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    return pa.ListArray.from_arrays(offsets, values)


def kept_tokens(text: Column, max_length: int, unicode: bool = False) -> Column:
    """The tokens that fit: the end mark takes one place."""
    return F.slice(word_tokens(text, unicode), F.lit(1), F.lit(max_length - 1))


# Bytes of a text for each place of its ids, up to which a task receives it as it is.
WHOLE_BYTES = 16


def kept_text(text: Column, max_length: int, unicode: bool = False) -> Column:
    """A text whose first ``max_length - 1`` tokens (see ``word_text``) are ``kept_tokens``: a long one has only these."""
    kept = F.array_join(kept_tokens(text, max_length, unicode), " ")
    return F.when(F.octet_length(text) > WHOLE_BYTES * max_length, kept).otherwise(word_text(text, unicode))


def coded_texts(texts: pa.Array, cut, ids: dict, most: int, unknown: int = UNKNOWN_ID) -> pa.Array:
    """The ids of the first ``most`` tokens that ``cut`` finds in each text.

    Tokens are strings for texts of limited size at a time, whatever the batch holds; ids are all that is kept.
    """
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = []
    for r in list(steps(sizes, BYTES_PER_STEP)) or [slice(0, 0)]:
        tokens = cut(texts[r])
        found = looked_up(tokens.flatten(), ids, pa.int32(), unknown)
        counts = np.diff(tokens.offsets.to_numpy())
        if len(counts) and counts.max() > most:
            place = np.arange(len(found)) - np.repeat(np.cumsum(counts) - counts, counts)
            found, counts = found.filter(pa.array(place < most)), np.minimum(counts, most)
        parts.append(regroup(found, pa.array(counts)))
    return pa.concat_arrays(parts)


def finish(ids: Column, max_length: int, pad: int = PAD_ID, eos: int = EOS_ID) -> Column:
    """Append the end mark and pad on the right to exactly ``max_length``."""
    return F.concat(
        ids, F.array(F.lit(eos)), F.array_repeat(F.lit(pad), F.lit(max_length - 1) - F.size(ids))
    )


def attention_mask(ids: Column, max_length: int) -> Column:
    return F.concat(
        F.array_repeat(F.lit(1), F.size(ids) + 1),
        F.array_repeat(F.lit(0), F.lit(max_length - 1) - F.size(ids)),
    )


def encode_features(
    df: DataFrame,
    encode,
    limits: Limits = Limits(),
    dialogue: str = "dialogue",
    summary: str | None = "summary",
) -> DataFrame:
    """Add ``input_ids``, ``attention_mask`` and (given a summary column) ``labels``.

    ``encode(text column, max_length)`` returns the unpadded ids. Existing columns stay.
    """
    ids = {"_in": encode(F.col(dialogue), limits.max_input)}
    if summary:
        ids["_out"] = encode(F.col(summary), limits.max_target)
    coded = df.withColumns(ids)
    features = {
        "input_ids": finish(F.col("_in"), limits.max_input),
        "attention_mask": attention_mask(F.col("_in"), limits.max_input),
    }
    if summary:
        features["labels"] = finish(F.col("_out"), limits.max_target, limits.label_pad)
    return coded.withColumns(features).drop("_in", "_out")


def word_encoder(vocab: DataFrame, unicode: bool = False, max_rows: int = MAX_BROADCAST_ROWS, unknown: int = UNKNOWN_ID):
    """``encode`` function over a (word, id) vocabulary, or ``None`` if it is too large to send."""
    sent = send_table(vocab.select("word", "id"), max_rows)
    if sent is None:
        return None
    cut = spaced if unicode else words

    def encode(text: Column, max_length: int) -> Column:
        @F.arrow_udf(IDS)
        def coded(texts: pa.Array) -> pa.Array:
            return coded_texts(texts, cut, sent.value.mapping("word", "id"), max_length - 1, unknown)

        return coded(kept_text(text, max_length, unicode))

    return encode


ROW = "_row"


def numbered(df: DataFrame) -> DataFrame:
    """Stored copy of ``df`` with a number for each row.

    User ids may repeat or be null, so rows that are taken apart are put together by number. The
    frame is stored: numbers depend on partitions, which a second computation may cut otherwise.
    """
    return materialise(df.withColumn(ROW, F.monotonically_increasing_id()))


# Rows of a block, as a power of two: what a group of a lookup by blocks holds.
BLOCK_BITS = 8


def _block() -> Column:
    return F.shiftrightunsigned(ROW, BLOCK_BITS).alias("_block")


def asked_words(rows: DataFrame, words: Column) -> DataFrame:
    """(_block, word), stored: the different words of each block of ``rows`` (from ``numbered``).

    A block is a stretch of rows of one partition, so its words are combined where they lie; what is shuffled
    is a block's vocabulary, not its tokens.
    """
    return materialise(rows.select(_block(), F.explode(F.array_distinct(words)).alias("word")).distinct())


def answered(rows: DataFrame, lists: dict[str, Column], asked: DataFrame, table: DataFrame, kernel, type_: T.DataType, **limits) -> DataFrame:
    """``rows`` (from ``numbered``) with a column of ``type_`` for each of ``lists``: ``kernel(list array, {word: value})``.

    ``table`` has two columns, ``word`` and a value, and may be of any size; ``limits`` are those of ``left_lookup``. The blocks'
    ``asked`` words are joined with it, and a block's rows meet the values that it asked for in one group.
    """
    value = next(c for c in table.columns if c != "word")
    found = left_lookup(asked, materialise(table), "word", **limits).filter(F.col(value).isNotNull()).select("_block", "word", value)
    places = {f"_list_{name}": column for name, column in lists.items()}
    sources = dict(zip(lists, places))
    schema = T.StructType([*rows.schema, *[T.StructField(name, type_) for name in lists]])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        values = dict(zip(right.column("word").to_pylist(), right.column(value).to_pylist()))
        out = left.drop_columns(["_block", *sources.values()])
        for name, source in sources.items():
            out = out.append_column(name, kernel(pa.concat_arrays(left.column(source).chunks), values))
        return out

    # the texts are moved, and cut into words where they arrive
    dealt = rows.withColumn("_block", _block()).repartition("_block").withColumns(places)
    return dealt.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(run, schema)


def _coded_lists(tokens: pa.Array, ids: dict) -> pa.Array:
    return regroup(looked_up(tokens.flatten(), ids, pa.int32(), UNKNOWN_ID), pc.list_value_length(tokens))


def _lists_by_join(rows: DataFrame, vocab: DataFrame, lists: dict[str, Column], max_rows: int) -> DataFrame:
    asked = asked_words(rows, F.concat(*lists.values()))
    table = vocab.select("word", F.col("id").cast("int").alias("id"))
    return answered(rows, lists, asked, table, _coded_lists, IDS, max_rows=max_rows)


def encode_by_join(
    rows: DataFrame,
    vocab: DataFrame,
    text_col: str,
    max_length: int,
    name: str = "ids",
    unicode: bool = False,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """``rows`` (from ``numbered``) with unpadded ids ``name``, through a join.

    For vocabularies of any size. Each block of rows asks once for each of its words; texts without
    tokens get an empty array.
    """
    return _lists_by_join(rows, vocab, {name: kept_tokens(F.col(text_col), max_length, unicode)}, max_rows)


def encode_pairs(
    df: DataFrame,
    vocab: DataFrame,
    limits: Limits = Limits(),
    unicode: bool = False,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Features for (dialogue, summary) rows, whatever the vocabulary's size; ids are not used."""
    encode = word_encoder(vocab, unicode, max_rows)
    if encode is not None:
        return encode_features(df, encode, limits)
    sides = {
        "_in": kept_tokens(F.col("dialogue"), limits.max_input, unicode),
        "_out": kept_tokens(F.col("summary"), limits.max_target, unicode),
    }
    rows = _lists_by_join(numbered(df), vocab, sides, max_rows)
    return rows.withColumns(
        {
            "input_ids": finish(F.col("_in"), limits.max_input),
            "attention_mask": attention_mask(F.col("_in"), limits.max_input),
            "labels": finish(F.col("_out"), limits.max_target, limits.label_pad),
        }
    ).drop("_in", "_out", ROW)


def feature_table(
    pairs: DataFrame,
    vocab: DataFrame,
    limits: Limits = Limits(),
    ratios: SplitRatios = SplitRatios(),
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Pairs + split + features as one frame; rows are labelled and encoded in place."""
    return encode_pairs(split_exact(pairs, "id", ratios), vocab, limits, max_rows=max_rows)


def length_profile(
    df: DataFrame,
    text_col: str,
    max_length: int,
    by: str = "split",
    unicode: bool = False,
) -> DataFrame:
    """Per group: rows, rows that the limit cuts, longest text, exact length percentiles.

    Rows are first reduced to (group, length) counts, so the exact percentiles work on
    distinct lengths however many rows a group has.
    """
    lengths = (
        df.select(by, F.size(word_tokens(F.col(text_col), unicode)).alias("n"))
        .groupBy(by, "n")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    shares = F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99))
    return (
        lengths.groupBy(by)
        .agg(
            F.sum("rows").alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("n") > max_length - 1, F.col("rows"))), F.lit(0)).alias(
                "n_cut"
            ),
            F.max("n").alias("max_tokens"),
            F.percentile("n", shares, F.col("rows")).alias("_p"),
        )
        .select(
            by,
            "n_rows",
            "n_cut",
            "max_tokens",
            F.get("_p", F.lit(0)).alias("p50"),
            F.get("_p", F.lit(1)).alias("p95"),
            F.get("_p", F.lit(2)).alias("p99"),
        )
    )
