"""Piece training and segmentation against all segmentations of short words."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from briefloom.operators import encode
from briefloom.operators.piece_training import LEAST, LIKELIHOOD, expectations, expected_counts, losses, train_pieces
from briefloom.operators.pieces import Trie, best_segmentation, encode_by_piece_join, piece_encoder
from briefloom.operators.vocab import build_pieces


def all_segmentations(word, pieces):
    if not word:
        yield []
    for end in range(1, len(word) + 1):
        if word[:end] in pieces:
            yield from ([word[:end], *rest] for rest in all_segmentations(word[end:], pieces))


def table(rng, letters="abc", n=14):
    pieces = {c: -rng.uniform(1, 6) for c in letters}
    while len(pieces) < n:
        pieces["".join(rng.choice(letters) for _ in range(rng.randrange(2, 5)))] = -rng.uniform(0.5, 6)
    return pieces


def brute_expectations(word, pieces):
    total, sums = 0.0, defaultdict(float)
    for parts in all_segmentations(word, pieces):
        p = math.exp(sum(pieces[x] for x in parts))
        total += p
        for x in parts:
            sums[x] += p
    return (math.log(total) if total else -math.inf), {x: v / total for x, v in sums.items()}


def test_expectations_and_the_best_segmentation():
    rng = random.Random(1)
    for _ in range(200):
        pieces = table(rng)
        names = list(pieces)
        trie = Trie((x, s, i) for i, (x, s) in enumerate(pieces.items()))
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))
        total, got = expectations(word, trie)
        want_total, want = brute_expectations(word, pieces)
        assert total == pytest.approx(want_total) and {names[k]: v for k, v in got.items()} == pytest.approx(dict(want))
        best = max(sum(pieces[x] for x in parts) for parts in all_segmentations(word, pieces))
        parts = [word[a:b] for a, b, _ in trie.best(word, -99.0)]
        assert "".join(parts) == word and sum(pieces[x] for x in parts) == pytest.approx(best)
    assert expectations("axb", Trie([("a", -1.0, 0), ("b", -1.0, 1)])) == (-math.inf, {})
    assert best_segmentation("axab", {"a": -1.0, "ab": -1.5, "b": -1.0}, 8, -9.0) == ["a", None, "ab"]
    long = "ab" * 2000
    assert expectations(long, Trie([("a", -9.0, 0), ("b", -9.0, 1), ("ab", -9.0, 2)]))[0] < -17000


def test_one_round_is_that_of_all_segmentations(spark):
    rng = random.Random(2)
    pieces = table(rng)
    words = Counter("".join(rng.choice("abc") for _ in range(rng.randrange(1, 8))) for _ in range(300))
    got = {r["piece"]: r["expected"] for r in expected_counts(
        spark.createDataFrame(list(words.items()), "word string, count long").repartition(3),
        spark.createDataFrame(list(pieces.items()), "piece string, logp double"),
    ).collect()}
    likelihood, sums = 0.0, defaultdict(float)
    for word, n in words.items():
        total, own = brute_expectations(word, pieces)
        likelihood += n * total
        for x, v in own.items():
            sums[x] += n * v
    assert got.pop(LIKELIHOOD) == pytest.approx(likelihood)
    assert got == pytest.approx(dict(sums))


def test_losses_compare_with_the_best_other_pieces(spark):
    rows = [("a", 5.0, -1.0), ("b", 5.0, -2.0), ("ab", 4.0, -1.5), ("aba", 2.0, -2.0)]
    got = {r["piece"]: r["loss"] for r in losses(spark.createDataFrame(rows, "piece string, expected double, logp double")).collect()}
    assert got == {"a": None, "b": None, "ab": pytest.approx(4 * 1.5), "aba": pytest.approx(2 * 0.5)}


def test_likelihood_rises_in_every_round_and_the_size_is_met(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    trained = train_pieces(docs, size=300, rounds=3)
    by_size = defaultdict(list)
    for n, likelihood in trained.likelihoods:
        by_size[n].append(likelihood)
    runs = [trained.likelihoods[i : i + 3] for i in range(0, len(trained.likelihoods), 3)]
    assert len(runs) > 1
    for run in runs:
        values = [v for _, v in run]
        assert all(b >= a - 1e-6 * abs(a) for a, b in zip(values, values[1:])) and values[-1] > values[0]
    rows = trained.pieces.orderBy("id").collect()
    letters = {c for r in docs.select(F.lower("text").alias("t")).collect() for c in r["t"] if c in "abcdefghijklmnopqrstuvwxyz0123456789"}
    assert len(rows) <= 300 and letters <= {r["piece"] for r in rows}
    assert [r["id"] for r in rows] == list(range(106, 106 + len(rows)))
    assert sum(math.exp(r["logp"]) for r in rows) == pytest.approx(1, abs=1e-3)
    # better than the table of plain counts of the same size
    plain = build_pieces(docs, size=len(rows) - 36)
    words = docs.select(F.explode(F.split(F.lower("text"), "[^a-z0-9]+")).alias("word")).filter("word <> ''").groupBy("word").count()
    score = lambda p: expected_counts(words, p.select("piece", "logp")).filter(F.col("piece") == LIKELIHOOD).first()["expected"]
    assert score(trained.pieces) > score(plain)


def test_training_without_words(spark):
    assert train_pieces(spark.createDataFrame([(None,), ("",)], "text string"), size=10).pieces.collect() == []
    assert LEAST > 0


def test_join_and_broadcast_give_the_same_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, None), (1, ""), (1, "zz qq"), (2, "ab " * 3000), (None, "漢 a1")], "doc_id long, text string")
    docs = docs.unionByName(odd)
    pieces = build_pieces(docs, size=400).filter("piece <> 'q'")
    for size in (16, 1024):
        rows = encode.numbered(docs)
        want = rows.withColumn("ids", piece_encoder(pieces)(F.col("text"), size)).select("_row", "ids")
        got = encode_by_piece_join(rows, pieces, "text", size, max_rows=100).select("_row", "ids")
        key = lambda r: r["_row"]
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
