"""Tokens cut from bytes are those of the text expressions."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from briefloom.functions import tokens
from briefloom.functions.text import BLEU_LITERALS, BLEU_PATTERNS, bleu_text, split_nonempty, word_text, word_tokens
from briefloom.functions.overlap import ngram_matches
from briefloom.operators import metrics, summarize

EDGES = ["", " ", "a", "a b", "\t\n\v\f\r", "\u0130I \u212a\u00c4x \u2028y\u00a0z", "1...5 ,., a.,5 -- 3-4 . .5 .  ,x", "end", None, "start  ", "  x"]


def texts(n=400):
    rng, signs = random.Random(7), "ab1 9.,.,- !&$'(\n\t\u00e9K\u4e2d"
    return EDGES + ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(n)]


def published_13a(text):
    out = text
    for old, new in BLEU_LITERALS:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.concat(F.lit(" "), out, F.lit(" "))
    for pattern, replacement in BLEU_PATTERNS:
        out = F.regexp_replace(out, pattern, replacement)
    return split_nonempty(out, r"\s+")


@pytest.mark.parametrize("offset", [0, 3])
def test_tokens_of_texts(spark, offset):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "i int, t string")
    text = F.col("t")
    rows = frame.select(
        word_text(text).alias("lower"), word_text(text, True).alias("any"), bleu_text(text).alias("bleu"),
        word_tokens(text).alias("w"), word_tokens(text, True).alias("u"), published_13a(text).alias("b"),
    ).orderBy("i").collect()
    for name, want, cut in (("lower", "w", tokens.words), ("any", "u", tokens.spaced), ("bleu", "b", tokens.spaced)):
        column = pa.array([r[name] for r in rows], pa.string())[offset:]
        assert cut(column).to_pylist() == [r[want] for r in rows][offset:]


def test_steps_count_tokens(monkeypatch):
    left = pa.array(["a b c", None, "a a", ""] * 50)
    right = pa.array(["b c d", "x", "a", None] * 50)
    whole = tokens.in_text_steps(lambda a, b: ngram_matches(a, b, 2), tokens.words, left, right)
    monkeypatch.setattr(tokens, "BYTES_PER_STEP", 4)
    cut = tokens.in_text_steps(lambda a, b: ngram_matches(a, b, 2), tokens.words, left, right)
    assert [c.tolist() for c in whole] == [c.tolist() for c in cut] == [[3, 0, 2, 0] * 50, [3, 1, 1, 0] * 50, [2, 0, 1, 0] * 50, [1, 0, 0, 0] * 50]
    assert [len(c) for c in tokens.in_text_steps(lambda a, b: ngram_matches(a, b, 1), tokens.words, left[:0], right[:0])] == [0] * 3


def test_sentences_are_those_of_the_token_lists(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "i int, t string")
    rows = frame.select(summarize._sentence_texts("t").alias("s"), summarize._tokenised("t").alias("w")).orderBy("i").collect()
    got = summarize._with_tokens(pa.array([r["s"] for r in rows], pa.list_(pa.string())))
    assert got.to_pylist() == [r["w"] for r in rows]


def test_whole_texts_reach_the_metrics_as_texts(spark):
    """A string for every token is neither made nor sent: the rows and BLEU's counts need no ``split``."""
    frame = spark.createDataFrame([("m", "a b", "a c")], "model string, prediction string, reference string")
    for out in (metrics.bleu_corpus(frame), metrics.evaluation_report(frame, ("rouge1", "rouge2", "bleu", "meteor"))):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "split(" not in plan and "bleu" in plan


def test_texts_of_another_python_function_are_scored(spark):
    """Extracts come from an Arrow function, whose result must reach that of the metrics."""
    frame = spark.createDataFrame([("a b c. d e. f g.", "a b c"), ("x y", None)], "dialogue string, reference string")
    rows = summarize.tfidf_extract(frame, 3).withColumn("model", F.lit("m"))
    for names in (["rouge1"], ["meteor"], ["bleu"], ["rouge1", "rouge2", "bleu", "meteor"]):
        got = {r["metric"]: r["value"] for r in metrics.evaluation_report(rows, names).collect()}
        assert set(got) == set(names) and all(v >= 0 for v in got.values())
        if "rouge1" in names:
            assert got["rouge1"] == pytest.approx((6 / 10 + 0) / 2)
