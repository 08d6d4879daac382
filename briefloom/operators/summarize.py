"""Extractive summaries: lead sentences, tf-idf scored sentences, TextRank."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from briefloom.functions.overlap import steps
from briefloom.functions.text import let, sentences, word_tokens
from briefloom.functions.tokens import words
from briefloom.operators.encode import ROW, answered, asked_words, looked_up, numbered, regroup, send_table
from briefloom.scaling import MAX_BROADCAST_ROWS, materialise

# TextRank damping (Mihalcea & Tarau 2004) and number of rounds.
DAMPING = 0.85
ROUNDS = 20
SENTENCES_PER_STEP = 20_000
# Pairs of sentence lengths that meet in a word, held at a time.
MEETINGS_PER_BLOCK = 4_000_000
POSITIONS = T.ArrayType(T.IntegerType())


def lead_k(
    df: DataFrame,
    k: int = 3,
    text_col: str = "dialogue",
    output_col: str = "prediction",
    joiner: str = " ",
) -> DataFrame:
    """The first k sentences."""
    first = F.slice(sentences(F.col(text_col)), F.lit(1), F.lit(k))
    return df.withColumn(output_col, F.array_join(first, joiner))


def document_frequencies(df: DataFrame, text_col: str) -> DataFrame:
    """(word, df): each text lists a word once, so a plain combined count is enough.

    Every text also lists the empty word, whose count is the number of texts.
    """
    listed = F.array_append(F.array_distinct(word_tokens(F.col(text_col))), F.lit(""))
    return (
        df.select(F.explode(listed).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def idf_table(df: DataFrame, text_col: str) -> DataFrame:
    """(word, df, idf): smoothed inverse document frequency, stored in the shared folder."""
    frequencies = materialise(document_frequencies(df, text_col))
    counted = frequencies.filter(F.col("word") == "").first()
    n_docs = counted["df"] if counted else 0
    return frequencies.select(
        "word", "df", (F.ln(F.lit(float(n_docs + 1)) / (F.col("df") + 1)) + 1).alias("idf")
    )


def _six_places(value):
    """One rounding rule for both ways of scoring: half up at six places."""
    return np.floor(value * 1e6 + 0.5) / 1e6


def _tokenised(text_col: str) -> Column:
    return F.transform(sentences(F.col(text_col)), lambda s: word_tokens(s))


def _sentence_texts(text_col: str) -> Column:
    """The sentences of ``_tokenised`` as texts, whose tokens ``_with_tokens`` finds in the task."""
    return sentences(F.lower(F.col(text_col)))


def _chosen_apart(df: DataFrame, choose, text_col: str) -> DataFrame:
    """Add ``_chosen`` in a step that Spark does not join to later ones.

    It is marked as not deterministic for that alone: in one step with another Python function that reads the extracts, it
    cannot be planned.
    """
    return df.withColumn("_chosen", choose.asNondeterministic()(_sentence_texts(text_col)))


def _with_tokens(docs: pa.Array) -> pa.Array:
    return regroup(words(docs.flatten()), pc.list_value_length(docs))


def _mean_idf(docs: pa.Array, idf: dict) -> tuple[np.ndarray, np.ndarray]:
    """(mean idf to 6 places, number of tokens) of the sentences of ``docs``, one after the other."""
    parts = docs.flatten()
    lengths = _sizes(parts)
    values = looked_up(parts.flatten(), idf, pa.float64()).to_numpy(zero_copy_only=False)
    sums = np.bincount(np.repeat(np.arange(len(lengths)), lengths), values, len(lengths))
    return _six_places(sums / np.maximum(lengths, 1)), lengths


def _best_by_idf(docs: pa.Array, idf: dict, k: int) -> pa.Array:
    def best(part: pa.Array) -> pa.Array:
        scores, lengths = _mean_idf(part, idf)
        return top_positions(_sizes(part), scores, k, lengths > 0)

    return _in_ranges(docs, best)


def _by_join(rows: DataFrame, idf: DataFrame, text_col: str, kernel, name: str, type_: T.DataType, **limits) -> DataFrame:
    docs = _tokenised(text_col)
    asked = asked_words(rows, F.flatten(docs))
    return answered(rows, {name: docs}, asked, idf.select("word", "idf"), kernel, type_, **limits)


def tfidf_scores(rows: DataFrame, idf: DataFrame, text_col: str, **limits) -> DataFrame:
    """(row, pos, score) of rows from ``numbered``: mean idf of the sentence's tokens, to 6 places."""

    def scored(docs: pa.Array, values: dict) -> pa.Array:
        scores, lengths = _mean_idf(docs, values)
        return regroup(pa.array(scores, pa.float64(), mask=lengths == 0), pc.list_value_length(docs))

    lists = _by_join(rows, idf, text_col, scored, "_scores", T.ArrayType(T.DoubleType()), **limits)
    return lists.select(ROW, F.posexplode("_scores").alias("pos", "score")).filter(F.col("score").isNotNull())


def _chosen_by_join(df: DataFrame, idf: DataFrame, k: int, text_col: str, **limits) -> DataFrame:
    """Add ``_chosen`` with a word join: blocks of texts ask for the idf of their words, and are ranked where these arrive."""
    return _by_join(numbered(df), idf, text_col, lambda docs, values: _best_by_idf(docs, values, k), "_chosen", POSITIONS, **limits)


def _chosen_in_place(df: DataFrame, sent, k: int, text_col: str) -> DataFrame:
    """Add ``_chosen`` with an idf table that was sent to the executors: no shuffle."""

    @F.arrow_udf(POSITIONS)
    def choose(docs: pa.Array) -> pa.Array:
        idf_of = sent.value.mapping("word", "idf")
        return _in_ranges(docs, lambda part: _best_by_idf(_with_tokens(part), idf_of, k))

    return _chosen_apart(df, choose, text_col)


def _with_chosen(
    df: DataFrame, columns: list[str], text_col: str, output_col: str
) -> DataFrame:
    """Replace ``_chosen`` positions by those sentences of the text."""
    text = let(
        sentences(F.col(text_col)),
        lambda parts: F.array_join(
            F.transform(F.col("_chosen"), lambda p: F.get(parts, p)), " "
        ),
    )
    return df.select(*columns, F.coalesce(text, F.lit("")).alias(output_col))


def tfidf_extract(
    df: DataFrame,
    k: int = 3,
    text_col: str = "dialogue",
    output_col: str = "prediction",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """The k best sentences by mean idf (earlier wins ties), in text order.

    An idf table of measured size is sent to the executors and every text is scored where
    it lies; a larger one is joined.
    """
    idf = idf_table(df, text_col)
    sent = send_table(idf.select("word", "idf"), max_rows)
    scored = (
        _chosen_by_join(df, idf, k, text_col, max_rows=max_rows)
        if sent is None
        else _chosen_in_place(df, sent, k, text_col)
    )
    return _with_chosen(scored, df.columns, text_col, output_col)


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def _in_ranges(docs: pa.Array, best) -> pa.Array:
    """Apply ``best`` to runs of documents with a limited number of sentences."""
    parts = [best(docs[r]) for r in steps(_sizes(docs), SENTENCES_PER_STEP)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))


def top_positions(counts: np.ndarray, scores: np.ndarray, k: int, eligible: np.ndarray) -> pa.Array:
    """Per document the positions of its k best eligible sentences, in text order."""
    doc_of = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(scores)) - np.repeat(np.cumsum(counts) - counts, counts)
    rows = np.flatnonzero(eligible)
    usable = np.bincount(doc_of[rows], minlength=len(counts))
    ranked = rows[np.lexsort((place[rows], -scores[rows], doc_of[rows]))]
    turn = np.arange(len(rows)) - np.repeat(np.cumsum(usable) - usable, usable)
    kept = np.sort(ranked[turn < k])
    return regroup(pa.array(place[kept], pa.int32()), pa.array(np.minimum(usable, k), pa.int32()))


def _inverse(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_inverse=True)


def textrank_scores(
    doc_of: np.ndarray,
    sentence_of: np.ndarray,
    codes: np.ndarray,
    lengths: np.ndarray,
    damping: float = DAMPING,
    rounds: int = ROUNDS,
) -> np.ndarray:
    """TextRank of all sentences of many documents at once.

    Two sentences of a document are tied by shared distinct words / (ln|a| + ln|b|). That
    depends on the words and the two lengths only, so neighbours are summed per (document,
    word, length) and no sentence is paired with another: exact, at a cost that
    follows the tokens and, per word of a document, the square of the number of different
    sentence lengths it occurs in. ``doc_of`` and ``lengths`` are per sentence, ``sentence_of`` and ``codes`` (word
    numbers) per token.
    """
    n = len(lengths)
    linked = lengths[sentence_of] > 1
    width = int(codes.max(initial=0)) + 1
    entries = np.unique(sentence_of[linked] * width + codes[linked])
    sentence, word = entries // width, entries % width
    _, word_in_doc = _inverse(doc_of[sentence] * width + word)
    longest = int(lengths.max(initial=0)) + 1
    groups, group = _inverse(word_in_doc * longest + lengths[sentence])
    group_word, group_length = groups // longest, groups % longest
    # Lengths that meet in one word of one document; groups of a word are neighbours.
    words, starts, per_word = np.unique(group_word, return_index=True, return_counts=True)
    fan, start_of = np.repeat(per_word, per_word), np.repeat(starts, per_word)
    logs = np.log(np.maximum(group_length, 1))

    def meetings():
        """(first group, last, its neighbours, their weights) in blocks of limited size."""
        ends = np.cumsum(fan)
        first = 0
        while first < len(groups):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + MEETINGS_PER_BLOCK, "right")))
            own_fan = fan[first:last]
            here = np.repeat(np.arange(first, last), own_fan)
            step = np.arange(len(here)) - np.repeat(np.cumsum(own_fan) - own_fan, own_fan)
            there = np.repeat(start_of[first:last], own_fan) + step
            yield first, last, here - first, there, 1.0 / (logs[here] + logs[there])
            first = last

    kept = list(meetings()) if fan.sum() <= MEETINGS_PER_BLOCK else None  # else built again each round
    own = np.bincount(sentence, minlength=n) / np.maximum(2 * np.log(np.maximum(lengths, 2)), 1.0)

    def neighbour_sum(values: np.ndarray) -> np.ndarray:
        given = np.bincount(group, values[sentence], len(groups))
        met = np.zeros(len(groups))
        for first, last, here, there, weight in kept if kept is not None else meetings():
            met[first:last] = np.bincount(here, weight * given[there], last - first)
        return np.bincount(sentence, met[group], n) - own * values

    out = neighbour_sum(np.ones(n))
    score = np.ones(n)
    for _ in range(rounds):
        flow = np.divide(score, out, out=np.zeros(n), where=out > 1e-9)
        score = (1 - damping) + damping * neighbour_sum(flow)
    return score


def best_sentences(docs: pa.Array, k: int) -> pa.Array:
    """Positions of the k best sentences of each list of tokenised sentences, in order."""
    counts = _sizes(docs)
    parts = docs.flatten()
    lengths = _sizes(parts)
    codes = parts.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    doc_of = np.repeat(np.arange(len(counts)), counts)
    sentence_of = np.repeat(np.arange(len(lengths)), lengths)
    scores = np.round(textrank_scores(doc_of, sentence_of, codes.astype(np.int64), lengths), 6)
    return top_positions(counts, scores, k, np.ones(len(scores), bool))


def textrank(
    df: DataFrame, k: int = 3, text_col: str = "dialogue", output_col: str = "prediction"
) -> DataFrame:
    """The k best sentences by TextRank, in text order. A text is one row, so this is local."""

    @F.arrow_udf(POSITIONS)
    def choose(docs: pa.Array) -> pa.Array:
        return _in_ranges(docs, lambda part: best_sentences(_with_tokens(part), k))

    return _with_chosen(_chosen_apart(df, choose, text_col), df.columns, text_col, output_col)
