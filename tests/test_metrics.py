"""Metrics against hand-worked cases and plain Python definitions."""

from __future__ import annotations

import math
import random
import time
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from briefloom.functions.chunks import _Row, fewest_chunks
from briefloom.functions.lcs import lcs_length, lcs_positions, union_lcs_hits
from briefloom.functions.overlap import alignment
from briefloom.functions.stem import porter_stem
from briefloom.operators.metrics import (
    REPORT_METRICS,
    ROW_METRICS,
    bleu_corpus,
    evaluation_report,
    metric_value,
    row_metrics,
    stems,
    synonyms,
)
from briefloom.operators.report import leaderboard

EDGE = [
    ("same", "the cat sat on the mat", "the cat sat on the mat"),
    ("apart", "alpha beta", "gamma delta"),
    ("null", None, "something"),
    ("both", None, None),
    ("blank", "", ""),
    ("marks", "?!", "..."),
    ("one", "word", "word"),
    ("repeat", "the the the the", "the cat"),
    ("order", "mat the on sat cat the", "the cat sat on the mat"),
]


def pairs(spark, rows=EDGE):
    return spark.createDataFrame(rows, "id string, prediction string, reference string")


def scores(spark, name, rows=EDGE):
    out = row_metrics(pairs(spark, rows), [name]).select("id", metric_value(name).alias("v"))
    return {r["id"]: r["v"] for r in out.collect()}


def reference_rouge(h, r, n):
    def count(t):
        return Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1))

    a, b = count(h), count(r)
    m = sum((a & b).values())
    if not m:
        return 0.0
    p, q = m / sum(a.values()), m / sum(b.values())
    return 2 * p * q / (p + q)


def table_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t


def table_positions(a, b):
    t, i, j, out = table_lcs(a, b), len(a), len(b), set()
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.add(i)
        elif t[i][j - 1] > t[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return out


def random_texts(seed, n=200, words="abcdefg"):
    rng = random.Random(seed)
    return [
        (str(i), " ".join(rng.choices(words, k=rng.randint(0, 30))), " ".join(rng.choices(words, k=rng.randint(0, 30))))
        for i in range(n)
    ]


def test_bit_parallel_lcs_equals_the_table():
    rng = random.Random(3)
    for _ in range(300):
        a = rng.choices("abcd", k=rng.randint(0, 90))
        b = rng.choices("abcde", k=rng.randint(0, 90))
        assert lcs_length(a, b) == table_lcs(a, b)[-1][-1]
        assert lcs_positions(a, b) == table_positions(a, b)


def test_union_lcs_known_example():
    # Lin 2004: w1 w2 from one sentence and w1 w3 w5 from the other make 4 of 5 words.
    reference = [["w1", "w2", "w3", "w4", "w5"]]
    hypothesis = [["w1", "w2", "w6", "w7", "w8"], ["w1", "w3", "w8", "w9", "w5"]]
    assert union_lcs_hits(reference, hypothesis) == 4


@pytest.mark.parametrize("n", [1, 2])
def test_rouge_n(spark, n):
    rows = random_texts(n)
    got = scores(spark, f"rouge{n}", rows)
    for key, h, r in rows:
        assert got[key] == pytest.approx(reference_rouge(h.split(), r.split(), n), abs=1e-12)


def test_rouge_edges(spark):
    one = scores(spark, "rouge1")
    assert one["same"] == one["one"] == one["order"] == 1.0
    assert one["apart"] == one["null"] == one["both"] == one["blank"] == one["marks"] == 0.0
    assert one["repeat"] == pytest.approx(2 * 0.25 * 0.5 / 0.75)
    two = scores(spark, "rouge2")
    assert two["same"] == 1.0 and two["one"] == 0.0


def test_rouge_l_never_exceeds_rouge_1(spark):
    rows = random_texts(9)
    one, long, lsum = (scores(spark, m, rows) for m in ("rouge1", "rougeL", "rougeLsum"))
    for key, h, r in rows:
        assert long[key] <= one[key] + 1e-12
        assert long[key] == pytest.approx(lsum[key])
        m = table_lcs(h.split(), r.split())[-1][-1]
        assert long[key] == pytest.approx(2 * m / (len(h.split()) + len(r.split())) if m else 0.0)


def test_meteor_by_hand(spark):
    got = scores(spark, "meteor")
    assert got["same"] == pytest.approx(1 - 0.5 * (1 / 6) ** 3)
    assert got["one"] == pytest.approx(0.5)
    assert got["apart"] == got["null"] == got["both"] == got["marks"] == 0.0
    # one match: P = 1/4, R = 1/2, one chunk
    assert got["repeat"] == pytest.approx(10 * 0.25 * 0.5 / (0.5 + 9 * 0.25) * 0.5)
    # six matches; only the pair (on sat)->(sat on) order breaks: no two matches are joined
    assert got["order"] == pytest.approx(1 - 0.5 * 1.0)


# The examples printed with the published rules.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi",
    "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc",
    "digitizer": "digit", "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal",
    "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formaliti": "formal",
    "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form",
    "formalize": "formal", "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good",
    "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop",
    "adjustable": "adjust", "defensible": "defens", "irritant": "irrit", "replacement": "replac",
    "adjustment": "adjust", "dependent": "depend", "adoption": "adopt", "communism": "commun", "activate": "activ",
    "angulariti": "angular", "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll", "is": "is",
}


@pytest.mark.parametrize("word", list(STEMS))
def test_porter(word):
    assert porter_stem(word) == STEMS[word]


def test_meteor_stages(spark):
    rows = pairs(spark, [("a", "cats like big houses", "cat likes large house"), ("b", "cat cats", "cats cat"), ("c", "", "cat")])
    table = spark.createDataFrame([("big", "size"), ("large", "size")], "word string, key string")

    def value(stages):
        out = row_metrics(rows, ["meteor"], meteor_stages=stages).collect()
        return {r["id"]: r["meteor"] for r in out}

    assert value([])["a"] == 0.0
    # three of four words by stem, in two runs
    stemmed = value([stems])
    assert stemmed["a"] == pytest.approx(0.75 * (1 - 0.5 * (2 / 3) ** 3))
    assert value([stems, synonyms(table)])["a"] == pytest.approx(1 - 0.5 * (1 / 4) ** 3)
    # equal words first: two matches that cross
    assert stemmed["b"] == value([])["b"] == pytest.approx(0.5)
    assert stemmed["c"] == 0.0
    report = evaluation_report(rows.withColumn("model", F.lit("m")), ["meteor"], meteor_stages=[stems])
    assert report.first()["value"] == pytest.approx(sum(stemmed.values()) / 3)


def bleu(spark, rows):
    return bleu_corpus(pairs(spark, rows)).first()


def test_bleu(spark):
    same = [("a", "the cat sat on the mat", "the cat sat on the mat")]
    assert bleu(spark, same)["bleu"] == pytest.approx(100.0)
    short = [("a", "the cat sat on", "the cat sat on the mat")]
    assert bleu(spark, short)["bleu"] == pytest.approx(100 * math.exp(1 - 6 / 4))
    # 4 of 6 words, 2 of 5 pairs, 1 of 4 triples, no 4-gram: smoothed to 1/(2*3)
    mixed = [("a", "a b c x d y", "a b c d e f")]
    want = 100 * (4 / 6 * 2 / 5 * 1 / 4 * 1 / (2 * 3)) ** 0.25
    assert bleu(spark, mixed)["bleu"] == pytest.approx(want)
    assert bleu(spark, [("a", "x", "y")])["bleu"] == 0.0
    assert bleu(spark, [("a", None, "y z")])["bleu"] == 0.0
    assert bleu(spark, [])["bleu"] == 0.0


def test_bleu_is_a_corpus_score(spark):
    rows = [("a", "a b c d e", "a b c d e"), ("b", "p q r s t u", "u t s r q p")]
    whole = bleu(spark, rows)
    assert (whole["match1"], whole["total1"], whole["match4"], whole["total4"]) == (11, 11, 2, 5)
    means = sum(bleu(spark, [r])["bleu"] for r in rows) / 2
    assert whole["bleu"] != pytest.approx(means)


def test_report_and_leaderboard(spark):
    rows = pairs(spark).withColumn("model", F.lit("m1")).unionByName(
        pairs(spark).withColumn("prediction", F.col("reference")).withColumn("model", F.lit("m2"))
    )
    report = evaluation_report(rows)
    assert report.count() == 2 * len(REPORT_METRICS)
    ranks = {(r["metric"], r["model"]): r["rank"] for r in leaderboard(report).collect()}
    assert all(ranks[m, "m2"] == 1 for m in REPORT_METRICS)
    assert ranks["rouge2", "m1"] == 2


def test_unknown_metric(spark):
    with pytest.raises(ValueError):
        row_metrics(pairs(spark), ["rouge9"])


def test_metrics_ignore_partitioning(spark):
    rows = random_texts(5)
    frame = row_metrics(pairs(spark, rows).repartition(7), ROW_METRICS)
    other = row_metrics(pairs(spark, rows).repartition(1), ROW_METRICS)
    assert sorted(map(str, frame.collect())) == sorted(map(str, other.collect()))


def test_lcs_of_long_texts_needs_little_memory():
    import random
    import tracemalloc

    from briefloom.functions.lcs import lcs_length, lcs_positions

    rng = random.Random(1)
    a, b = ([rng.choice("abcdefgh") for _ in range(4000)] for _ in range(2))
    tracemalloc.start()
    n, found = lcs_length(a, b), lcs_positions(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == n and peak < 1_000_000


def fewest_by_trying_all(left, right, key):
    """(matches, chunks) over all alignments: most equal words, then most equal keys, then fewest chunks."""
    best = (0, 0, 0)

    def go(i, used, before, exact, other, chunks):
        nonlocal best
        if i == len(left):
            best = max(best, (exact, other, -chunks))
            return
        go(i + 1, used, None, exact, other, chunks)
        for j, word in enumerate(right):
            if j not in used and key(word) == key(left[i]):
                same = word == left[i]
                more = before is None or j != before + 1
                go(i + 1, used | {j}, j, exact + same, other + (not same), chunks + more)

    go(0, frozenset(), None, 0, 0, 0)
    return best[0] + best[1], -best[2]


@pytest.mark.parametrize("keyed", [False, True])
def test_fewest_chunks_equal_trying_all(keyed):
    rng = random.Random(8)
    key = (lambda w: w.lower()[0]) if keyed else (lambda w: w)
    rows = [
        (rng.choices(["a1", "a2", "b1", "b2", "c1"], k=rng.randint(0, 6)), rng.choices(["a1", "a2", "b1", "a3", "c1"], k=rng.randint(0, 6)))
        for _ in range(400)
    ]
    words = [pa.array([r[side] for r in rows], pa.list_(pa.string())) for side in (0, 1)]
    keys = [pa.array([[key(w) for w in r[side]] for r in rows], pa.list_(pa.string())) for side in (0, 1)]
    stages = words + keys if keyed else words
    matches, chunks, exact = fewest_chunks(*stages, states=5_000)
    plain = alignment(*stages)
    want = [fewest_by_trying_all(*r, key) for r in rows]
    assert list(zip(matches.tolist(), chunks.tolist())) == want
    assert exact.all() and (chunks < plain[1]).any() and (matches == plain[0]).all()
    # few open choices: no fewer chunks than there can be, no more than k-th copies give, and told apart
    _, some, sure = fewest_chunks(*stages, states=1)
    assert (some >= chunks).all() and (some <= plain[1]).all() and (some == chunks)[sure == 1].all()


def test_fewest_chunks_of_long_rows():
    rng = random.Random(9)
    text = rng.choices(["the", "of", *map(str, range(2_000))], weights=[200, 100, *[1] * 2_000], k=6_000)
    moved = text[2_000:] + text[:2_000]
    started = time.perf_counter()
    matches, chunks, _ = fewest_chunks(*[pa.array([t], pa.list_(pa.string())) for t in (moved, text)])
    assert matches[0] == 6_000 and chunks[0] < 10
    assert time.perf_counter() - started < 60


def test_fewest_chunks_give_up_no_choice():
    """Rows with more choices than are kept at first: the fewest chunks are found, with and without keys."""
    rng = random.Random(21)
    rows = []
    for _ in range(300):
        # the right side's three pieces are moved, and copies of its words lie before and between them
        text = rng.choices("abcdefg", k=9)
        pieces = [text[:3], text[3:6], text[6:]]
        rng.shuffle(pieces)
        noise = [rng.choices("abcdefg", k=rng.randint(0, 3)) for _ in pieces]
        rows.append(([w for n, p in zip(noise, pieces) for w in n + p], text))
    lists = [pa.array([r[side] for r in rows], pa.list_(pa.string())) for side in (0, 1)]
    matches, chunks, exact = fewest_chunks(*lists, states=2)
    want = [most_links_by_trying_all(*r) for r in rows]
    assert (matches - chunks).tolist() == want and exact.all()
    rows = [(left[:7], right[:6]) for left, right in rows]
    stages = [pa.array([[f(w) for w in r[side]] for r in rows], pa.list_(pa.string())) for f in (str, lambda w: "x" if w in "abc" else w) for side in (0, 1)]
    matches, chunks, exact = fewest_chunks(*stages, states=1)
    assert list(zip(matches.tolist(), chunks.tolist())) == [fewest_by_trying_all(*r, lambda w: "x" if w in "abc" else w) for r in rows]
    assert exact.all()


def most_links_by_trying_all(left, right):
    links = [(i, j) for i in range(len(left) - 1) for j in range(len(right) - 1) if left[i : i + 2] == right[j : j + 2]]

    def agree(a, b):
        return a[0] - a[1] == b[0] - b[1] or abs(a[0] - b[0]) > 1 and abs(a[1] - b[1]) > 1

    def most(some):
        return max(1 + most([b for b in some[1:] if agree(some[0], b)]), most(some[1:])) if some else 0

    return most(links)


def test_words_that_repeat_in_long_rows():
    """A piece repeated thousands of times is decided by bounds, not by trying."""
    line = ["a", "b", "c"]
    rows = [(line * 120 + ["x"] + line * 100, line * 150), (["a"] * 300 + ["b"] + ["a"] * 300, ["a"] * 400 + ["c"])]
    matches, chunks, _ = fewest_chunks(*[pa.array([r[side] for r in rows], pa.list_(pa.string())) for side in (0, 1)])
    assert (matches.tolist(), chunks.tolist()) == ([450, 400], [2, 2])


def test_words_that_meet_nothing_cost_no_choices(monkeypatch):
    """Of a long text only the words that occur opposite are searched."""
    asked = []
    monkeypatch.setattr(_Row, "choices", lambda self, word, used, seen: asked.append(word) or ([], True))
    text = [f"w{i}" for i in range(500)] + ["b", "x", "a", "a"]
    _, chunks, exact = fewest_chunks(*[pa.array([t], pa.list_(pa.string())) for t in (text, ["a", "b"])])
    assert (chunks.tolist(), exact.tolist(), asked) == ([2], [1], [])


def test_meteor_with_the_fewest_chunks(spark):
    rows = pairs(spark, [("a", "the end of the day", "of the day the end"), ("b", "cats of the cat", "the cat of cats"), ("c", None, "x"), ("d", "", "")])

    def value(**options):
        return {r["id"]: r["meteor"] for r in row_metrics(rows, ["meteor"], **options).collect()}

    plain, fewest = value(), value(fewest_chunks=True)
    assert fewest["a"] == pytest.approx(1 - 0.5 * (2 / 5) ** 3) and plain["a"] < fewest["a"]
    assert fewest["c"] == fewest["d"] == 0.0
    assert value(fewest_chunks=True, meteor_stages=[stems])["b"] >= value(meteor_stages=[stems])["b"]
    with pytest.raises(Exception, match="one more stage"):
        value(fewest_chunks=True, meteor_stages=[stems, stems])


def test_synonyms_by_join_equal_synonyms_sent(spark):
    rows = pairs(spark, [*random_texts(5, 60), ("null", None, "a b"), ("empty", "", "c"), ("0", "a a b", "b c c"), (None, "d", "e")])
    table = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2"), ("d", "2"), ("d", "3"), ("unused", "9")], "word string, key string")

    def value(**options):
        out = row_metrics(rows, ["meteor"], meteor_synonyms=table, **options)
        assert out.columns == ["id", "prediction", "reference", "meteor"]
        return sorted((r["id"] or "", r["meteor"]) for r in out.collect())

    sent = value()
    assert sent == value(max_rows=0)
    assert value(fewest_chunks=True) == value(fewest_chunks=True, max_rows=0)
    assert sum(v for _, v in sent) > sum(r["meteor"] for r in row_metrics(rows, ["meteor"]).collect())


def test_queries_of_repeated_words_and_stems(spark, tmp_path):
    """Whole queries on a small table against trying all alignments."""
    from briefloom.plans import queries

    rng = random.Random(12)
    rows = []
    for i in range(40):
        first, rest = (" ".join(rng.choices(["cats", "cat", "runs", "run", "of"], k=k)) for k in (4, 6))
        rows.append((i, f"{first.capitalize()}. {rest.capitalize()}.", "en", "s", 50))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    texts = {r["id"]: (r["prediction"], r["reference"]) for r in queries.whole_predictions(spark, str(tmp_path)).collect()}
    assert texts
    fewest = {r["id"]: r["meteor"] for r in queries.meteor_fewest(spark, str(tmp_path)).collect()}
    stemmed = {r["id"]: r["meteor"] for r in queries.meteor_stems(spark, str(tmp_path)).collect()}
    assert set(fewest) == set(stemmed) == set(texts)
    for key, (h, r) in texts.items():
        h, r = ([w.strip(".").lower() for w in t.split()] for t in (h, r))

        def meteor(m, chunks):
            p, q = m / len(h), m / len(r)
            return 10 * p * q / (q + 9 * p) * (1 - 0.5 * (chunks / m) ** 3) if m else 0.0

        assert fewest[key] == pytest.approx(meteor(*fewest_by_trying_all(h, r, lambda w: w)), abs=1e-6)
        # paired in order: as many matches, and no fewer chunks
        m, chunks = fewest_by_trying_all(h, r, porter_stem)
        assert meteor(m, m) - 1e-6 <= stemmed[key] <= meteor(m, chunks) + 1e-6
