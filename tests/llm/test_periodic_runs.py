"""Periodic runs against trying every period at every place."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from briefloom.llm.kernels import mix
from briefloom.llm.periodic_runs import find_runs, op13_periodic_runs, periodic_runs, selected

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(seq, least=24):
    n, by = len(seq), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and seq[j] == seq[j + p]:
                j += 1
            if j + p - i >= max(least, 3 * p):
                by.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((a, b - a, p) for (a, b), p in by.items())


def found(texts, least=24):
    bounds = np.cumsum([0, *map(len, texts)])
    flat = np.array([x for t in texts for x in t], np.uint64)
    return [[tuple(r) for r in rows.tolist()] for rows in find_runs(mix(flat + np.uint64(9)), bounds, least)]


def layered(rng, depth, kinds):
    """A sequence of repetitions of repetitions, with breaks."""
    if depth == 0:
        return [rng.randrange(kinds) for _ in range(rng.randrange(1, 14))]
    w = layered(rng, depth - 1, kinds)
    turn = rng.random()
    if turn < 0.45:
        w = w * rng.randrange(2, 6)
        w = w[: len(w) - rng.randrange(0, 3)] or w
    elif turn < 0.7:
        w = w + layered(rng, depth - 1, kinds)
    elif turn < 0.85:
        w = w + w[: len(w) // 2] + w
    else:
        w = list(w)
        w[rng.randrange(len(w))] = rng.randrange(kinds)
    return w[:700]


@pytest.mark.parametrize("seed", range(6))
def test_layered_repetitions(seed):
    rng = random.Random(seed)
    texts = [layered(rng, rng.randrange(0, 7), rng.choice((1, 2, 3, 20))) for _ in range(60)]
    texts = [t * 3 if rng.random() < 0.5 else t for t in texts] + [[], [1]]
    assert found(texts) == [brute(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 9)), min_size=1, max_size=6))
def test_any_concatenation_of_powers(parts):
    text = [x for word, times in parts for x in word * times]
    assert found([text, text[::-1]]) == [brute(text), brute(text[::-1])]


def test_one_letter_long_and_binary_words():
    fibonacci = [0, 1]
    while len(fibonacci) < 1500:
        fibonacci = fibonacci + fibonacci[: len(fibonacci) * 5 // 8]
    morse = [bin(i).count("1") & 1 for i in range(2048)]
    rng = random.Random(0)
    periodic = [rng.randrange(50) for _ in range(333)] * 4
    texts = [[7] * 1000, fibonacci, morse, morse * 3, periodic, [7] * 30 + periodic + [7] * 30]
    assert found(texts) == [brute(t) for t in texts]


def test_selection_depends_on_the_context_alone():
    rng = np.random.default_rng(1)
    for tau in (4, 8, 16):
        part = mix(rng.integers(0, 3, 400).astype(np.uint64))
        both = np.concatenate([mix(rng.integers(9, 99, 50).astype(np.uint64)), part, mix(rng.integers(9, 99, 60).astype(np.uint64))])
        none = np.zeros((0, 3), np.int64)
        alone = selected(part, tau, none)
        inside = selected(both, tau, none) - 50
        assert alone.tolist() == [i for i in inside.tolist() if 0 <= i <= 400 - 2 * tau]
        assert np.diff(alone).max() <= tau  # dense where nothing is left out


def words_of(ident, text):
    own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(own)
    if ident is not None and n and (h := zlib.crc32(str(ident).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        own = [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]
    return own


def digest(ident, text):
    own = words_of(ident, text)
    runs = brute(own)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        ident, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
        sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(" ".join(w for i, w in enumerate(own) if i not in gone)),
    )


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_query_on_odd_rows(spark):
    rng = random.Random(3)
    rows = []
    for i in range(150):
        unit = [f"w{rng.randrange(30)}é" for _ in range(rng.randrange(1, 40))]
        rows.append((i, rng.choice((" ", "\n", "\t ")).join(unit * rng.randrange(1, 6) + unit[:3]), "en", "s", 1))
    rows += [(200, None, None, None, None), (201, "", None, None, None), (202, " \n", None, None, None),
             (None, rows[3][1], None, None, None), (None, None, None, None, None), rows[5], rows[5],
             (203, "a b " * 12, None, None, None), (204, "c " * 24 + "d e " * 12, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    clash = docs.select("*", *[F.lit("x").alias(c) for c in ("runs", "best", "start", "length", "period", "kept_text")])
    want = [digest(r[0], r[1]) for r in rows]
    assert sum(r[1] > 0 for r in want) > 50
    same(op13_periodic_runs(clash).collect(), want)
    plain = periodic_runs(docs).filter("doc_id = 203").first()
    assert (plain["kept_text"], [tuple(r) for r in plain["runs"]]) == ("a b", [(0, 24, 2)])


def test_query_on_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = [digest(r["doc_id"], r["text"]) for r in docs.collect()]
    assert any(r[1] for r in want)
    same(op13_periodic_runs(docs).collect(), want)


def test_a_very_long_text_and_no_text(spark):
    rng = random.Random(8)
    unit = [f"{rng.randrange(10**6)}" for _ in range(20_000)]
    text = " ".join(unit * 3 + ["x", "y"] * 50_000)
    row = periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 60_000, 20_000), (60_000, 100_000, 2)]
    assert row["kept_text"] == " ".join([*unit, "x", "y"])
    assert op13_periodic_runs(spark.createDataFrame([], DOCS)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(spark.createDataFrame([], DOCS), least=10)
