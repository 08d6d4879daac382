from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from briefloom.operators import pairs, summarize
from briefloom.operators.encode import numbered


def pairwise_textrank(parts, d=0.85, rounds=20):
    """The definition, pair by pair."""
    n = len(parts)
    w = [[0.0] * n for _ in range(n)]
    for i in range(n):
        for j in range(n):
            if i != j and len(parts[i]) > 1 and len(parts[j]) > 1:
                shared = len(set(parts[i]) & set(parts[j]))
                w[i][j] = shared / (math.log(len(parts[i])) + math.log(len(parts[j])))
    out = [sum(row) for row in w]
    score = [1.0] * n
    for _ in range(rounds):
        score = [
            1 - d + d * sum(w[j][i] * score[j] / out[j] for j in range(n) if out[j] > 0)
            for i in range(n)
        ]
    return score


def test_textrank_equals_the_pairwise_definition():
    """Many documents in one call, some empty, against each document on its own."""
    rng = random.Random(2)
    docs = [[rng.choices("abcdefghij", k=rng.randint(0, 9)) for _ in range(rng.randint(0, 12))] for _ in range(150)]
    sentences = [s for d in docs for s in d]
    doc_of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    lengths = np.array([len(s) for s in sentences])
    got = summarize.textrank_scores(
        doc_of, np.repeat(np.arange(len(sentences)), lengths), np.array([ord(w) - 97 for s in sentences for w in s]), lengths
    )
    assert np.allclose(got, [v for d in docs for v in pairwise_textrank(d)], atol=1e-9)
    table = pa.array(docs, pa.list_(pa.list_(pa.string())))
    best = summarize.best_sentences(table, 3).to_pylist()
    for doc, chosen in zip(docs, best):
        scores = np.round(pairwise_textrank(doc), 6)
        assert chosen == sorted(sorted(range(len(doc)), key=lambda i: (-scores[i], i))[:3])
    assert summarize.best_sentences(table[5:9], 3).to_pylist() == best[5:9]


def test_textrank_picks_the_connected_sentences(spark):
    text = "Red cars go fast. Blue birds sing loud. Fast red cars win. People like fast red cars."
    rows = spark.createDataFrame([("x", text), ("y", ""), ("z", "Only one.")], "id string, dialogue string")
    got = {r["id"]: r["prediction"] for r in summarize.textrank(rows, 2).collect()}
    assert "Blue birds" not in got["x"] and got["y"] == "" and got["z"] == "Only one."


def test_tfidf_prefers_rare_words_and_keeps_order(spark):
    rows = spark.createDataFrame(
        [("1", "Common words here. Unusual zebra. Common words here. Peculiar quokka."), ("2", "Common words here."), ("3", "?! ...")],
        "id string, dialogue string",
    )
    got = {r["id"]: r["prediction"] for r in summarize.tfidf_extract(rows, 2).collect()}
    assert got == {"1": "Unusual zebra. Peculiar quokka.", "2": "Common words here.", "3": ""}


def test_tfidf_with_a_large_word_table_is_the_same(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").alias("id"), F.col("text").alias("dialogue"))
    want = sorted(map(tuple, summarize.tfidf_extract(docs).collect()))
    assert sorted(map(tuple, summarize.tfidf_extract(docs, max_rows=1000).collect())) == want
    idf, rows = summarize.idf_table(docs, "dialogue"), numbered(docs)
    tight = summarize.tfidf_scores(rows, idf, "dialogue", max_rows=10, hot_rows=20)
    plain = summarize.tfidf_scores(rows, idf, "dialogue")
    assert sorted(map(tuple, tight.collect())) == sorted(map(tuple, plain.collect()))


def test_lead(spark):
    rows = spark.createDataFrame([("One. Two! Three? Four.",), ("",), (None,)], "dialogue string")
    assert [r["prediction"] for r in summarize.lead_k(rows, 2).collect()] == ["One. Two!", "", ""]


def test_dialogues_across_pieces(spark):
    """A conversation longer than one piece, in scrambled order, with a null text."""
    turns = spark.range(95).select(
        F.lit(1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.when(F.col("id") != 7, F.concat(F.lit("t"), "id")).alias("text"),
    ).orderBy(F.md5(F.col("id").cast("string")))
    lines = [f"{'user' if i % 2 == 0 else 'assistant'}: {f't{i}' if i != 7 else ''}" for i in range(95)]
    whole = pairs.assemble_dialogue(turns, chunk_turns=10).first()
    assert whole["dialogue"].split("\n") == lines and whole["n_turns"] == 95
    pair = pairs.pairs_from_turns(turns, chunk_turns=10).first()
    assert pair["dialogue"].split("\n") == lines[:-1] and pair["summary"] == "t94"


def test_single_turns_and_single_sentences_give_no_pair(spark):
    turn = spark.createDataFrame([(1, 0, "user", "hi")], "conv_id long, turn long, role string, text string")
    assert pairs.pairs_from_turns(turn).count() == 0
    docs = spark.createDataFrame([(1, "One only."), (2, "A b. C d. E."), (3, None)], "doc_id long, text string")
    assert [tuple(r) for r in pairs.pairs_from_documents(docs).collect()] == [("2", "C d. E.", "A b.")]


def test_tfidf_does_not_use_ids(spark):
    texts = ["Aa bb. Cc cc. Dd ee. Ff.", "Xx ww vv. Yy yy. Zz yy. Aa."]
    rows = spark.createDataFrame([("1", t) for t in texts] + [(None, t) for t in texts], "id string, dialogue string")
    want = sorted(r["prediction"] for r in summarize.tfidf_extract(rows, 2).collect())
    assert sorted(r["prediction"] for r in summarize.tfidf_extract(rows, 2, max_rows=1).collect()) == want


def test_textrank_in_blocks_is_the_same(monkeypatch):
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 12, 40)
    sentence_of = np.repeat(np.arange(40), lengths)
    codes, doc_of = rng.integers(0, 15, len(sentence_of)), np.sort(rng.integers(0, 3, 40))
    want = summarize.textrank_scores(doc_of, sentence_of, codes, lengths)
    monkeypatch.setattr(summarize, "MEETINGS_PER_BLOCK", 7)
    assert np.allclose(summarize.textrank_scores(doc_of, sentence_of, codes, lengths), want)
