"""ROUGE, BLEU and METEOR for (prediction, reference) rows.

Both texts are in the same row, so every metric is computed where the row lies; only
corpus sums are shuffled, as one row per task.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from briefloom.functions.chunks import STATES, fewest_chunks
from briefloom.functions.lcs_lanes import lcs_lengths, union_hits_of_rows
from briefloom.functions.overlap import alignment, in_steps, ngram_matches
from briefloom.functions.stem import porter_stem
from briefloom.functions.text import bleu_text, split_nonempty, word_text, word_tokens
from briefloom.functions.tokens import in_text_steps, spaced, words
from briefloom.operators.encode import ROW, answered, asked_words, looked_up, numbered, regroup, send_table
from briefloom.scaling import MAX_BROADCAST_ROWS

# Longest BLEU n-gram; METEOR weights (Banerjee & Lavie 2005).
BLEU_ORDER = 4
METEOR_RECALL_WEIGHT = 9.0
METEOR_PENALTY = 0.5

# A stage maps a token-list column to a list of keys of the same length.
Stage = Callable[[Column], Column]

ROW_METRICS = ("rouge1", "rouge2", "rougeL", "rougeLsum", "meteor")


def _struct_of(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.IntegerType()) for n in names])


def _as_struct(names: list[str], columns) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in columns], names)


SIZES = ["n_left", "n_right"]


def _n_tokens(counts: str, text_h: str, text_r: str) -> list[Column]:
    """The numbers of tokens of two texts, from a struct of ``_text_udf``.

    They read the texts as well: with a second use, Spark keeps the step that makes the texts apart from the function.
    Joined into one step, a text that comes from another Python function (extracts, say) cannot be planned.
    """
    return [F.when(F.octet_length(t) > 0, F.col(counts)[n]).otherwise(0) for t, n in zip((text_h, text_r), SIZES)]


def _text_udf(names: list[str], kernel, cut):
    """Arrow function (two texts) -> struct of their numbers of tokens, and of one integer per name."""

    @F.arrow_udf(_struct_of([*SIZES, *names]))
    def count(left: pa.Array, right: pa.Array) -> pa.Array:
        return _as_struct([*SIZES, *names], in_text_steps(kernel, cut, left, right))

    return count


def shared_ngrams(left: Column, right: Column, orders: int, cut=words) -> Column:
    """Struct ``n_left, n_right, match1 .. match<orders>`` of two texts: tokens, and clipped n-gram matches."""
    names = [f"match{n}" for n in range(1, orders + 1)]
    return _text_udf(names, lambda a, b: ngram_matches(a, b, orders), cut)(left, right)


ALIGNED = ["matches", "chunks"]


def aligned_texts(left: Column, right: Column, cut=words, fewest: bool = False, states: int = STATES) -> Column:
    """``aligned_words`` of two texts, for equal words only, with their numbers of tokens."""
    kernel, names = (functools.partial(fewest_chunks, states=states), [*ALIGNED, "exact"]) if fewest else (alignment, ALIGNED)
    return _text_udf(names, kernel, cut)(left, right)


def aligned_words(
    left: Column, right: Column, stages: Sequence[Stage] = (), keys: Sequence[tuple[Column, Column]] = (), fewest: bool = False,
    states: int = STATES,
) -> Column:
    """Struct (matches, chunks): equal words first, then equal keys of the words left over.

    ``stages`` make keys from words, ``keys`` are lists of them, left and right. With ``fewest`` copies are paired for the fewest
    chunks (``exact`` is 1, see ``fewest_chunks``), else k-th copy with k-th copy.
    """
    kernel, names = alignment, ALIGNED
    if fewest:
        kernel, names = functools.partial(fewest_chunks, states=states), [*ALIGNED, "exact"]

    @F.arrow_udf(_struct_of(names))
    def align(sides: pa.Array) -> pa.Array:
        return _as_struct(names, in_steps(kernel, *sides.flatten()))

    pairs = [(left, right)] + [(stage(left), stage(right)) for stage in stages] + list(keys)
    sides = [side for pair in pairs for side in pair]
    return align(F.struct(*[side.alias(f"s{i}") for i, side in enumerate(sides)]))


@F.arrow_udf(T.ArrayType(T.StringType()))
def stems(tokens: pa.Array) -> pa.Array:
    """Porter stems of token lists; each distinct word of a batch is stemmed once."""
    words = pc.cast(tokens.flatten(), pa.string()).dictionary_encode()
    stemmed = pa.array([porter_stem(w) for w in words.dictionary.to_pylist()], pa.string())
    return regroup(stemmed.take(words.indices), pc.list_value_length(tokens))


def synonyms(table: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> Stage:
    """METEOR stage from a (word, key) table: words with the same key match.

    The table must fit the broadcast limit; ``row_metrics(meteor_synonyms=table)`` takes tables of any size.
    """
    stage = _sent_synonyms(table, max_rows)
    if stage is None:
        raise ValueError("a synonym table must fit the broadcast limit")
    return stage


def _sent_synonyms(table: DataFrame, max_rows: int) -> Stage | None:
    sent = send_table(table.select("word", "key"), max_rows)
    if sent is None:
        return None

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def keys(tokens: pa.Array) -> pa.Array:
        return _key_lists(tokens, sent.value.mapping("word", "key"))

    return keys


def _key_lists(tokens: pa.Array, keys: dict) -> pa.Array:
    """The keys of the words; a word without one is its own."""
    flat = pc.cast(tokens.flatten(), pa.string())
    own = pc.binary_join_element_wise(pa.scalar("word:"), flat, "")
    found = pc.binary_join_element_wise(pa.scalar("key:"), looked_up(flat, keys, pa.string()), "")
    return regroup(pc.coalesce(found, own), pc.list_value_length(tokens))


def joined_keys(
    rows: DataFrame, table: DataFrame, texts: dict[str, str], unicode: bool = False, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """``rows`` (from ``numbered``) with lists of the keys of their words, {list: text column}, through a join.

    For (word, key) tables of any size; of several keys of a word the smallest is taken. A word without a key is its own.
    """
    lists = {name: word_tokens(F.col(text), unicode) for name, text in texts.items()}
    keys = table.groupBy("word").agg(F.min("key").alias("key"))
    asked = asked_words(rows, F.concat(*lists.values()))
    return answered(rows, lists, asked, keys, _key_lists, T.ArrayType(T.StringType()), max_rows=max_rows)


@F.arrow_udf(T.IntegerType())
def _lcs(left: pa.Array, right: pa.Array) -> pa.Array:
    return pa.array(lcs_lengths(left, right), pa.int32())


@F.arrow_udf(T.IntegerType())
def _union_lcs(reference: pa.Array, hypothesis: pa.Array) -> pa.Array:
    return pa.array(union_hits_of_rows(reference, hypothesis), pa.int32())


def _prf(matches: Column, n_prediction: Column, n_reference: Column) -> Column:
    """Struct (p, r, f); all zero when nothing matches."""
    some = matches > 0
    precision = F.when(some, matches / n_prediction).otherwise(0.0)
    recall = F.when(some, matches / n_reference).otherwise(0.0)
    # 2PR/(P+R) with P = m/a and R = m/b is 2m/(a+b).
    f = F.when(some, 2 * matches / (n_prediction + n_reference)).otherwise(0.0)
    return F.struct(precision.alias("p"), recall.alias("r"), f.alias("f"))


def _meteor(matches: Column, chunks: Column, n_prediction: Column, n_reference: Column) -> Column:
    p = matches / n_prediction
    r = matches / n_reference
    mean = (1 + METEOR_RECALL_WEIGHT) * p * r / (r + METEOR_RECALL_WEIGHT * p)
    penalty = METEOR_PENALTY * F.pow(chunks / matches, F.lit(3))
    return F.when(matches == 0, F.lit(0.0)).otherwise(mean * (1 - penalty))


def row_metrics(
    df: DataFrame,
    metrics=ROW_METRICS,
    prediction: str = "prediction",
    reference: str = "reference",
    unicode: bool = False,
    meteor_stages: Sequence[Stage] = (),
    meteor_synonyms: DataFrame | None = None,
    fewest_chunks: bool = False,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add one struct (p, r, f) per ROUGE metric and one number for METEOR.

    METEOR matches equal words, k-th copy to k-th copy or, with ``fewest_chunks``, the copies that make the fewest chunks;
    ``meteor_stages`` such as ``stems`` and ``synonyms(table)`` then match what is left over, and last
    ``meteor_synonyms``, a (word, key) table of any size: it is joined if it is too large to be sent.
    """
    unknown = set(metrics) - set(ROW_METRICS)
    if unknown:
        raise ValueError(f"not a row metric: {sorted(unknown)}")
    h, r = F.col("_h"), F.col("_r")
    stages, keys = list(meteor_stages), []
    if meteor_synonyms is not None and "meteor" in metrics:
        table = meteor_synonyms.groupBy("word").agg(F.min("key").alias("key"))
        stage = _sent_synonyms(table, max_rows)
        if stage is not None:
            stages.append(stage)
        else:
            df = joined_keys(numbered(df), table, {"_keys_h": prediction, "_keys_r": reference}, unicode, max_rows)
            keys = [(F.col("_keys_h"), F.col("_keys_r"))]
    tokens = df.withColumns(
        {
            "_h": word_tokens(F.col(prediction), unicode),
            "_r": word_tokens(F.col(reference), unicode),
            "_h_text": word_text(F.col(prediction), unicode),
            "_r_text": word_text(F.col(reference), unicode),
        }
    )
    h_text, r_text, cut = F.col("_h_text"), F.col("_r_text"), spaced if unicode else words
    orders = max([n for n in (1, 2) if f"rouge{n}" in metrics], default=0)
    counts = {}
    if orders:
        counts["_grams"] = shared_ngrams(h_text, r_text, orders, cut)
    if "rougeL" in metrics:
        counts["_lcs"] = _lcs(h, r)
    if "rougeLsum" in metrics:
        lines = [
            F.transform(split_nonempty(F.col(c), "\n"), lambda line: word_tokens(line, unicode))
            for c in (reference, prediction)
        ]
        counts["_lcs_sum"] = _union_lcs(*lines)
    if "meteor" in metrics:
        in_place = not stages and not keys
        counts["_aligned"] = aligned_texts(h_text, r_text, cut, fewest_chunks) if in_place else aligned_words(h, r, stages, keys, fewest_chunks)
    counted = tokens.withColumns(counts)
    n_h, n_r = F.size(h), F.size(r)
    if orders or ("meteor" in metrics and in_place):
        # counted with the tokens in the task: the lists are not made for it
        n_h, n_r = _n_tokens("_grams" if orders else "_aligned", "_h_text", "_r_text")
    scores = {}
    for n in (1, 2):
        if f"rouge{n}" in metrics:
            scores[f"rouge{n}"] = _prf(F.col(f"_grams.match{n}"), n_h - (n - 1), n_r - (n - 1))
    if "rougeL" in metrics:
        scores["rougeL"] = _prf(F.col("_lcs"), n_h, n_r)
    if "rougeLsum" in metrics:
        scores["rougeLsum"] = _prf(F.col("_lcs_sum"), n_h, n_r)
    if "meteor" in metrics:
        scores["meteor"] = _meteor(F.col("_aligned.matches"), F.col("_aligned.chunks"), n_h, n_r)
    return counted.withColumns(scores).drop("_h", "_r", "_h_text", "_r_text", "_keys_h", "_keys_r", ROW, *counts)


def metric_value(name: str) -> Column:
    """The reported number of a metric column: F for ROUGE, the score itself otherwise."""
    return F.col(name)["f"] if name.startswith("rouge") else F.col(name)


BLEU_COUNTS = (
    "sys_len", "ref_len", "match1", "total1", "match2", "total2", "match3", "total3", "match4", "total4",
)


def with_bleu_counts(df: DataFrame, prediction: str, reference: str) -> DataFrame:
    """Add the numbers corpus BLEU is made of: lengths, clipped matches, totals."""
    tokens = df.withColumns(
        {"_h": bleu_text(F.col(prediction)), "_r": bleu_text(F.col(reference))}
    ).withColumn("_grams", shared_ngrams(F.col("_h"), F.col("_r"), BLEU_ORDER, spaced))
    n_h, n_r = _n_tokens("_grams", "_h", "_r")
    counts = {"sys_len": n_h, "ref_len": n_r}
    for n in range(1, BLEU_ORDER + 1):
        counts[f"match{n}"] = F.col(f"_grams.match{n}")
        counts[f"total{n}"] = F.greatest(n_h - (n - 1), F.lit(0))
    return tokens.withColumns(counts).drop("_h", "_r", "_grams")


def _bleu_sums() -> list[Column]:
    return [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in BLEU_COUNTS]


def _bleu_score() -> Column:
    """Corpus BLEU from summed counts: exponential smoothing, brevity penalty, 0..100."""
    zeros = F.lit(0)
    log_sum = F.lit(0.0)
    complete = F.lit(True)
    for n in range(1, BLEU_ORDER + 1):
        match, total = F.col(f"match{n}"), F.col(f"total{n}")
        zeros = zeros + F.when(match == 0, 1).otherwise(0)
        safe_total = F.greatest(total, F.lit(1))
        precision = F.when(match > 0, 100.0 * match / safe_total).otherwise(
            100.0 / (F.pow(F.lit(2.0), zeros) * safe_total)
        )
        log_sum = log_sum + F.ln(precision)
        complete = complete & (total > 0)
    short = F.when(
        F.col("sys_len") < F.col("ref_len"),
        F.exp(1 - F.col("ref_len") / F.greatest(F.col("sys_len"), F.lit(1))),
    ).otherwise(1.0)
    none = F.col("match1") + F.col("match2") + F.col("match3") + F.col("match4") == 0
    return F.when(~complete | none, F.lit(0.0)).otherwise(short * F.exp(log_sum / BLEU_ORDER))


def bleu_corpus(
    df: DataFrame, by=(), prediction: str = "prediction", reference: str = "reference"
) -> DataFrame:
    """Corpus BLEU (per group): sums over all rows, never a mean of row scores."""
    counted = with_bleu_counts(df.select(*by, prediction, reference), prediction, reference)
    return counted.groupBy(*by).agg(*_bleu_sums()).withColumn("bleu", _bleu_score())


# The reported metrics, and the subset that is logged to tracking.
REPORT_METRICS = ("rouge1", "rouge2", "rougeL", "rougeLsum", "bleu", "meteor")
LOGGED_METRICS = ("rouge1", "rouge2", "rougeL", "rougeLsum")


def evaluation_report(
    predictions: DataFrame,
    metrics=REPORT_METRICS,
    model_col: str = "model",
    meteor_stages: Sequence[Stage] = (),
) -> DataFrame:
    """(model, metric, value): mean row metrics and corpus BLEU, in long form."""
    rowwise = [m for m in metrics if m != "bleu"]
    rows = predictions.select(model_col, "prediction", "reference")
    wide = row_metrics(rows, rowwise, meteor_stages=meteor_stages)
    aggregates = [F.avg(metric_value(m)).alias(m) for m in rowwise]
    if "bleu" in metrics:
        wide = with_bleu_counts(wide, "prediction", "reference")
        aggregates += _bleu_sums()
    summed = wide.groupBy(model_col).agg(*aggregates)
    if "bleu" in metrics:
        summed = summed.withColumn("bleu", _bleu_score())
    return summed.unpivot(model_col, list(metrics), "metric", "value")
