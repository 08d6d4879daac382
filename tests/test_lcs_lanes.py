"""LCS in lanes against the full table, pair by pair."""

from __future__ import annotations

import random
import re
import time

import pyarrow as pa
import pytest

from briefloom.functions.lcs import covered_places, lcs_positions, union_lcs_hits
from briefloom.functions.lcs_lanes import MAX_LANES, lcs_lengths, union_hits, union_hits_of_rows
from briefloom.plans.queries import QUERIES, _with_next

SF_DIR = "/root/testdata/sf0.001"


def brute(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


def words(rng, n, kinds):
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_lengths_of_any_size(seed):
    rng = random.Random(seed)
    kinds = rng.choice((2, 6, 60))
    size = lambda: rng.randrange(0, rng.choice((3, 64, 66, 200, 64 * MAX_LANES + 80)))
    rows = [(words(rng, size(), kinds), words(rng, size(), kinds)) for _ in range(12)] + [([], ["x"]), (None, None), (["a"] * 64, ["a"] * 65)]
    kind = pa.list_(pa.string())
    got = lcs_lengths(pa.array([a for a, _ in rows], kind), pa.array([b for _, b in rows], kind))
    assert got.tolist() == [brute(a or [], b or []) for a, b in rows]
    part = pa.array([a for a, _ in rows], kind).slice(3, 5), pa.array([b for _, b in rows], kind).slice(3, 5)
    assert lcs_lengths(*part).tolist() == got.tolist()[3:8]
    assert lcs_lengths(*(pa.array([], kind),) * 2).tolist() == []


@pytest.mark.parametrize("seed", range(4))
def test_lines_follow_the_same_path(seed):
    rng = random.Random(seed)
    for _ in range(15):
        kinds = rng.choice((2, 5, 40))
        side = lambda: [words(rng, rng.randrange(0, rng.choice((4, 12, 90))), kinds) for _ in range(rng.randrange(0, 14))]
        a, b = side(), side()
        assert union_hits(a, b) == union_lcs_hits(a, b)
    long = [words(rng, 64 * MAX_LANES + 5, 30)], [words(rng, 20, 30) for _ in range(60)]
    assert union_hits(*long) == union_lcs_hits(*long)


def test_many_lines_are_quick():
    rng = random.Random(1)
    a, b = ([words(rng, 10, 3000) for _ in range(400)] for _ in range(2))
    union_hits(a[:60], b[:60])
    start = time.perf_counter()
    union_hits(a, b)
    assert time.perf_counter() - start < 1.5  # one pair after the other takes about three seconds


def tokens(text):
    return re.findall("[a-z0-9]+", text.lower())


def scores(m, h, r):
    return tuple(round(x, 6) for x in ((m / h, m / r, 2 * m / (h + r)) if m else (0.0, 0.0, 0.0)))


def test_whole_text_queries(spark):
    from briefloom.plans.queries import document_pairs

    got = {r["id"]: (r["p"], r["r"], r["f"]) for r in QUERIES["rougeL_whole"](spark, SF_DIR).collect()}
    want = {}
    for row in document_pairs(spark, SF_DIR).collect():
        h, r = tokens(row["dialogue"]), tokens(row["summary"])
        want[row["id"]] = scores(brute(r, h), len(h), len(r))
    assert got == want

    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    lines = lambda text: [t for line in text.split("\n") if line and (t := tokens(line)) is not None]
    rows, seen = QUERIES["rougeLsum_whole"](spark, SF_DIR).collect(), {}
    for ident in sorted(docs, reverse=True):
        own = docs[ident]
        key = (own["lang"], ident // 100)
        if key in seen:
            r, h = lines(own["text"]), lines(docs[seen[key]]["text"])
            m = union_lcs_hits(r, h)
            want[f"sum{ident}"] = scores(m, len(tokens(docs[seen[key]]["text"])), len(tokens(own["text"])))
        seen[key] = ident
    assert {f"sum{r['id']}": (r["p"], r["r"], r["f"]) for r in rows} == {k: v for k, v in want.items() if k.startswith("sum")}


@pytest.mark.parametrize("held", [0, 1 << 27])
def test_covered_places_follow_the_same_path(held):
    """Words that one side lacks and stretches without matches are passed in one step; ties stay as they were."""
    rng = random.Random(11)
    for _ in range(400):
        a = words(rng, rng.randrange(0, 90), rng.choice((2, 5, 40)))
        others = [words(rng, rng.randrange(0, 90), rng.choice((2, 5, 40, 200))) for _ in range(3)]
        want = set().union(*(lcs_positions(a, b) for b in others))
        got = covered_places(a, others, held)
        assert {i for i in range(len(a)) if got >> i & 1} == want and got >> len(a) == 0


def test_union_hits_of_a_batch():
    kind = pa.list_(pa.list_(pa.string()))
    left = [[["a", "b"], ["c"]], None, [], [[], ["x", "y"]], [["p"], ["p"]]]
    right = [[["b"], ["c", "a"]], [["a"]], [["a"]], [["y", "x"]], [["p"]]]
    batches = (pa.array([None, *rows], kind)[1:] for rows in (left, right))
    assert union_hits_of_rows(*batches).tolist() == [union_lcs_hits(a or [], b) for a, b in zip(left, right)]
    assert union_hits_of_rows(pa.array([], kind), pa.array([], kind)).tolist() == []


def test_every_document_meets_the_next_of_its_language(spark, tmp_path):
    """Also across groups of ids, over gaps, and with null and repeated ids."""
    rng = random.Random(5)
    ids = [None, None, 3, 7, 7, 99, 100, 101, 250, 251, 9_000, 10**12, 10**12, 10**12 + 1]
    rows = [(i, " ".join(words(rng, 6, 4)), lang) for lang in ("a", "b", None) for i in ids] + [(5, "alone", "c"), (105, None, "a")]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = [(r["id"], r["prediction"], r["reference"]) for r in _with_next(spark.read.parquet(str(tmp_path / "documents.parquet"))).collect()]
    want = []
    for lang in ("a", "b", "c", None):
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        want += [(None if x[0] is None else str(x[0]), y[1], x[1]) for x, y in zip(own, own[1:]) if y[1] is not None]
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 3 * 13
    assert QUERIES["rougeLsum_whole"](spark, str(tmp_path)).count() == len(got)
