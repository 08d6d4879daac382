"""Context-tree scores against a model kept in dictionaries, node by node."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from briefloom.llm import context_tree
from briefloom.llm.context_tree import (
    context_tree_scores, grams_of, log_estimate, log_gamma, op12_context_tree, planes, stream, unplaned,
)
from briefloom.llm.kernels import Words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(seed=3, n=70):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7))) for _ in range(40)] + ["The", "THE", "漢字"]
    texts = [rng.choice((" ", "\n", "\t ")).join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(n)]
    texts += [None, "", " \n ", "x" * 3000, texts[0], texts[1]]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    return rows + [rows[2], rows[2], (None, texts[3], None, None, None), (None, None, None, None, None)]


def held(ident, folds=10):
    return zlib.crc32(b"" if ident is None else str(ident).encode()) % folds == 0


def brute(rows, depth, more=()):
    """(words' counts, training texts, function from text to log2 probability, chance of a 1 at a decision,
    weighted probabilities) by a walk over every node of the tree. ``more``: further training decisions."""
    counts = defaultdict(lambda: [0, 0])
    seen = Counter()
    n_train = 0

    def decisions(text):
        coded = stream((text or "").encode())
        past = b"\n" * depth
        for byte in coded:
            node = 1
            for bit in range(7, -1, -1):
                one = byte >> bit & 1
                yield past, node, one
                node = node * 2 + one
            past = (past + bytes([byte]))[-depth:]

    for ident, text, *_ in rows:
        if held(ident):
            continue
        n_train += 1
        seen.update((text or "").encode().lower().split())
        for past, node, one in decisions(text):
            for d in range(depth + 1):
                counts[past[depth - d :], node][one] += 1
    for past, node, one in more:
        for d in range(depth + 1):
            counts[past[depth - d :], node][one] += 1

    estimate = lambda c: sum(math.lgamma(x + 0.5) for x in c) - math.lgamma(sum(c) + 1) - math.log(math.pi)
    children = defaultdict(set)
    for past, node in counts:
        if past:
            children[past[1:], node].add(past)
    weighted = {}
    for past, node in sorted(counts, key=lambda k: -len(k[0])):
        own = estimate(counts[past, node])
        if len(past) < depth:
            below = sum(weighted[child, node] for child in children[past, node])
            weighted[past, node] = np.logaddexp(own, below) - math.log(2)
        else:
            weighted[past, node] = own

    def chance_of(past, node):
        chance = None
        for d in range(depth, -1, -1):
            key = (past[depth - d :], node)
            zeros, ones = counts[key] if key in counts else (0, 0)
            own = (ones + 0.5) / (zeros + ones + 1)
            share = 1.0 if d == depth else math.exp(estimate((zeros, ones)) - math.log(2) - weighted.get(key, 0.0))
            chance = own if chance is None else share * own + (1 - share) * chance
        return chance

    def score(text):
        return sum(math.log2(c if one else 1 - c) for past, node, one in decisions(text) for c in [chance_of(past, node)])

    return seen, n_train, score, chance_of, weighted


def test_log_gamma_and_estimate():
    x = np.array([0.5, 1, 1.5, 2, 7.5, 8, 100.5, 1e6, 1e12])
    assert np.allclose(log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-10)
    pairs = [(0, 0), (1, 0), (3, 4), (100, 0), (5000, 9000), (10**9, 3)]
    want = [math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi) for a, b in pairs]
    got = log_estimate(*(np.array(v) for v in zip(*pairs)))
    assert np.allclose(got, want, rtol=1e-9, atol=1e-9)


def test_streams_grams_and_planes(monkeypatch):
    assert stream("Ab  É\n".encode()) == "ab É \n".encode() and stream(b" \t") == b"\n"
    grams = grams_of([b"ab \n", b"\n"], 3)
    assert [int(g).to_bytes(4, "big") for g in grams] == [b"\n\n\na", b"a\n\nb", b"ba\n ", b" ba\n", b"\n\n\n\n"]
    long = [b"abcdefg \n", b"", b"x" * 23 + b"\n"]
    whole = grams_of(long, 3)
    for size in (1, 4, 100):
        monkeypatch.setattr(context_tree, "SLICE", size)
        cut = list(context_tree.gram_slices(long, 3))
        assert np.concatenate([g for g, _, _ in cut]).tolist() == whole.tolist()
        assert sum((np.repeat(r, n).tolist() for _, r, n in cut), []) == [0] * 9 + [2] * 24
    values = np.array([1, -5, 2**40], np.int64)
    assert unplaned(planes(values), np.int64).tolist() == values.tolist()


@pytest.mark.parametrize("depth", [3, 6, 7])
def test_a_block_cuts_its_texts_once_and_looks_up_every_key(monkeypatch, depth):
    texts = pa.array([t for _, t, *_ in rows_of()], pa.large_string())
    cut = []
    monkeypatch.setattr(context_tree, "Words", lambda *a, **k: cut.append(1) or Words(*a, **k))
    monkeypatch.setattr(context_tree, "SLICE", 500)
    block = context_tree.Block(texts, depth)
    streams = [stream((t or "").encode()) for t in texts.to_pylist()]
    grams = grams_of(streams, depth)
    past = [bytes([10]) * depth + s for s in streams]
    want = [int.from_bytes(p[i - depth : i][::-1] + p[i : i + 1], "big") for p in past for i in range(depth, len(p))]
    assert grams.tolist() == want
    hashes = Words(texts, fold_case=True).hashes
    assert [k.tolist() for k in block.keys] == [sorted(set(want)), sorted(set(hashes.tolist()))]
    coded = list(block.coded((block.keys[0] % np.uint64(97)).astype(np.float32), (block.keys[1] % np.uint64(97)).astype(np.int64)))
    assert len(cut) == len(block.slices) > 1
    bits, sizes, n_words, counts = (np.concatenate(x) for x in zip(*coded))
    ends = np.cumsum([len(s) for s in streams])
    assert bits.tolist() == [sum(int(g) % 97 for g in grams[e - len(s) : e]) for e, s in zip(ends, streams)]
    assert sizes.tolist() == [len(s) for s in streams] and n_words.tolist() == [len(s.split()) for s in streams]
    assert counts.tolist() == [int(h) % 97 for h in hashes]


@pytest.mark.parametrize("places", [3, 300, 70_000])
def test_keys_are_ordered_by_place(places):
    which = np.random.default_rng(5).integers(0, places, 2000)
    which[which == 1] = 2
    order, present, first, last = context_tree.by_place(which, places)
    assert order.tolist() == np.argsort(which, kind="stable").tolist()
    assert [(p, which[order[a:b]].tolist()) for p, a, b in zip(present, first, last)] == [
        (p, [p] * int((which == p).sum())) for p in sorted(set(which.tolist()))
    ]
    assert all(len(x) == 0 for x in context_tree.by_place(which[:0], places))


@pytest.mark.parametrize("depth", [3, 5, 6])
def test_scores_are_those_of_the_walk_over_all_nodes(spark, depth):
    rows = rows_of()
    seen, n_train, score, _, _ = brute(rows, depth)
    total = sum(seen.values()) + n_train
    rest = math.log10(total + 0.1 * (len(seen) + 2))
    got = context_tree_scores(spark.createDataFrame(rows, DOCS).repartition(4), depth=depth).collect()
    want = []
    for ident, text, *_ in rows:
        tokens = (text or "").encode().lower().split()
        base = sum(math.log10(c + 0.1) - rest for c in [*(seen[t] for t in tokens), n_train])
        coded = len(stream((text or "").encode()))
        bits = -score(text)
        want.append((ident, held(ident), len(tokens) + 1, sum(seen[t] > 0 for t in tokens) + 1, total, base, -bits * math.log10(2), coded, bits / coded))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[7] == b[7]
        assert a[5:] == pytest.approx(b[5:], rel=1e-6)


@pytest.mark.parametrize("past,node", [(b"\n\n\n", 1), (b"\n\na", 3), (b" ab", 1), (b"zzz", 5)])
def test_predictions_are_ratios_of_the_weighted_probability(past, node):
    """Mixing along the path is the same as weighing the whole tree anew with one more bit."""
    rows = rows_of(n=8)
    _, _, _, chance_of, before = brute(rows, 3)
    after = brute(rows, 3, more=[(past, node, 1)])[-1]
    assert math.exp(after[b"", node] - before.get((b"", node), 0.0)) == pytest.approx(chance_of(past, node), rel=1e-9)


def test_no_rows_no_training_and_clashing_columns(spark):
    none = spark.createDataFrame([], DOCS)
    assert context_tree_scores(none).collect() == []
    ident = next(i for i in range(1000) if held(i))
    alone = context_tree_scores(spark.createDataFrame([(ident, "ab c", None, None, None)], DOCS)).first()
    assert (alone["train_tokens"], alone["n_known"], alone["base_score"]) == (0, 0, pytest.approx(0.0, abs=1e-9))
    assert alone["bits_per_byte"] == pytest.approx(8.0)
    rows = spark.createDataFrame(rows_of(), DOCS)
    names = ("block", "bucket", "kind", "part", "keys", "score", "held_out", "digest", "copies")
    same = lambda df: sorted(map(tuple, df.drop("base_score").collect()), key=repr)
    assert same(op12_context_tree(rows.select("*", *[F.lit("x").alias(c) for c in names]))) == same(op12_context_tree(rows))


def test_many_equal_rows_are_coded_once(spark):
    row = (None, "same words here", None, None, None)
    rows = spark.createDataFrame([row] * 3000 + [(1, "other words", None, None, None)], DOCS)
    got = op12_context_tree(rows).groupBy("doc_id", "n_tokens", "train_tokens", F.round("score", 6).alias("s")).count().collect()
    assert sorted(r["count"] for r in got) == [1, 3000]


def test_held_out_texts_are_scored_better_than_by_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sums = op12_context_tree(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > 0.97 * sums[1] > sums[1]
