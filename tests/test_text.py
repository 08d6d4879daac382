from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from briefloom.functions import overlap
from briefloom.functions.text import bleu_tokens, sentences, word_tokens


def value(spark, column, **cells):
    row = spark.createDataFrame([tuple(cells.values())], ", ".join(f"{c} {t}" for c, t in TYPES(cells)))
    return row.select(column.alias("out")).first()["out"]


def TYPES(cells):
    return [(c, "array<string>" if isinstance(v, list) else "string") for c, v in cells.items()]


def test_word_tokens(spark):
    assert value(spark, word_tokens(F.col("t")), t="It's  A-1, naïve!") == ["it", "s", "a", "1", "na", "ve"]
    assert value(spark, word_tokens(F.col("t"), unicode=True), t="Über naïve") == ["über", "naïve"]
    for empty in ("", "?!. --", None):
        assert value(spark, word_tokens(F.col("t")), t=empty) == []


def test_sentences(spark):
    got = value(spark, sentences(F.col("t")), t="One. Two!  Three?\n\nFour 3.5 five")
    assert got == ["One.", "Two!", "Three?", "Four 3.5 five"]
    assert value(spark, sentences(F.col("t")), t=None) == []


def lists(*rows):
    return pa.array(list(rows), pa.list_(pa.string()))


def counted_by_hand(a, b, n):
    grams = [Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1)) for t in (a, b)]
    return sum((grams[0] & grams[1]).values())


def aligned_by_hand(a, b):
    """k-th copy to k-th copy, then count the runs that advance by one on both sides."""
    where = {}
    for i, w in enumerate(b):
        where.setdefault(w, []).append(i)
    pairs = [(i, where[w].pop(0)) for i, w in enumerate(a) if where.get(w)]
    joined = sum((x + 1, y + 1) == after for (x, y), after in zip(pairs, pairs[1:]))
    return len(pairs), len(pairs) - joined


def test_overlaps_against_counting():
    rng = random.Random(7)
    a, b = ([rng.choices("abcde", k=rng.randint(0, 14)) for _ in range(400)] for _ in range(2))
    for most in (1, 50, 10**6):
        ranges = list(overlap.steps(np.array([len(x) + len(y) for x, y in zip(a, b)]), most))
        assert [i for r in ranges for i in range(r.start, r.stop)] == list(range(400))
    matches = overlap.in_steps(lambda x, y: overlap.ngram_matches(x, y, 4), lists(*a), lists(*b))
    for n in range(1, 5):
        assert matches[n - 1].tolist() == [counted_by_hand(x, y, n) for x, y in zip(a, b)]
    m, chunks = overlap.in_steps(overlap.alignment, lists(*a), lists(*b))
    assert list(zip(m, chunks)) == [aligned_by_hand(x, y) for x, y in zip(a, b)]


def test_overlaps_of_nothing_and_of_slices():
    for rows in (lists(), lists([]), lists([], [])):
        assert [c.tolist() for c in overlap.in_steps(overlap.alignment, rows, rows)] == [[0] * len(rows)] * 2
        assert all(c.tolist() == [0] * len(rows) for c in overlap.ngram_matches(rows, rows, 3))
    part = lists(["x"], ["a", "b"], ["a"])[1:]
    assert [c.tolist() for c in overlap.ngram_matches(part, part, 2)] == [[2, 1], [1, 0]]


def test_bleu_tokens(spark):
    got = value(spark, bleu_tokens(F.col("t")), t='Hello, "World" costs 3.5 (or 1,000)-ish &amp; it\'s 10-20.')
    assert got == ["Hello", ",", '"', "World", '"', "costs", "3.5", "(", "or", "1,000", ")", "-ish", "&", "it's", "10", "-", "20", "."]
