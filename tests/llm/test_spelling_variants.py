"""Spelling variants: all near pairs, forms and roots, against comparing every word with every other."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from briefloom.llm.spelling_variants import index_keys, lookups, near_pairs, op11_spelling_variants, pivots_of, prefix_of, roots_of, spelling_variants

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF_DIR = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def edits(word, letters):
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in letters)
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + c + word[i + 1 :] for c in letters)


def brute(rows, spoil=True):
    counts = Counter()
    for ident, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if spoil and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    cut = {}
    for w in counts:
        for i in range(len(w)):
            cut.setdefault((w[:i] + w[i + 1 :]), set()).add(w)
    out, form = {}, {}
    for w, n in counts.items():
        close = {x for i in range(len(w)) for x in cut.get(w[:i] + w[i + 1 :], ())} | cut.get(w, set())
        close |= {w[:i] + w[i + 1 :] for i in range(len(w)) if w[:i] + w[i + 1 :] in counts}
        close = {x for x in close if one_edit(w, x)}
        top = min(close, key=lambda x: (-counts[x], x), default=None)
        form[w] = top if top is not None and counts[top] >= 10 * n else None
        out[w] = [n, len(close), form[w], counts[form[w]] if form[w] else None]
    for w in out:
        root = w
        while form[root]:
            root = form[root]
        out[w].append(root)
    return sorted((w, *v) for w, v in out.items())


def plain(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def test_every_edit_is_found_under_a_key():
    """For any order of bigrams: the word whose prefix ends earlier finds the other by one of its keys."""
    rng = random.Random(5)
    for trial in range(300):
        letters = "ab" if trial % 3 else "abcdé"
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(7, 12)))
        ranks = {a + b: rng.random() for a in "abcdé" for b in "abcdé"}
        ranks = {g: i for i, g in enumerate(sorted(ranks, key=ranks.get))}
        for other in set(edits(word, letters)) - {word}:
            if len(other) < 7:
                continue
            (p, _, last), (q, _, other_last) = prefix_of(word, ranks), prefix_of(other, ranks)
            met = []
            if last <= other_last:
                met.append(set(lookups(word, p)) & set(index_keys(other, prefix_of(other, ranks)[1])))
            if other_last <= last:
                met.append(set(lookups(other, q)) & set(index_keys(word, prefix_of(word, ranks)[1])))
            assert met and all(met), (word, other)


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(2)
    for _ in range(500):
        places = rng.sample(range(9), rng.randrange(3, 6))
        costs = [rng.randrange(5) for _ in places]
        cost = dict(zip(places, costs))
        want = min(cost[a] + cost[b] for a in places for b in places if b - a >= 2)
        a, b = pivots_of(places, costs)
        assert b - a >= 2 and cost[a] + cost[b] == want


def texts(seed=4):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(7, 11))) for _ in range(30)]
    rows = []
    for i in range(60):
        own = []
        for _ in range(rng.randrange(1, 60)):
            word = rng.choice(stems[: 1 + rng.randrange(30)])
            if rng.random() < 0.15:
                word = rng.choice(list(edits(word, "abé")))
            own.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((i, rng.choice((" ", "\n", "-", "1")).join(own), "en", "s", 1))
    rows += [(90, None, None, None, None), (91, "", None, None, None), (92, "12 34", None, None, None), (None, rows[0][1], None, None, None), rows[1], rows[1]]
    return rows


def test_variants_are_those_of_all_comparisons(spark):
    rows = texts()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    want = brute(rows)
    assert sum(r[3] is not None for r in want) > 10 and max(r[2] for r in want) > 3
    assert plain(op11_spelling_variants(docs)) == want
    assert plain(spelling_variants(docs)) == brute(rows, spoil=False)
    clash = docs.select("*", *[F.lit("x").alias(c) for c in ("word", "n", "key", "form", "root", "near", "last")])
    assert plain(op11_spelling_variants(clash)) == want


def test_the_given_table_by_all_comparisons(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert plain(op11_spelling_variants(docs)) == brute([tuple(r) for r in docs.collect()])


def test_chains_of_forms_end_at_the_last(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "w5"), ("y", "z")]
    got = dict(tuple(r) for r in roots_of(spark.createDataFrame(chain, "word string, form string")).collect())
    assert got == {**{f"w{i}": "w37" for i in range(37)}, "x": "w37", "y": "z"}


def test_many_words_with_common_letters_stay_cheap(spark):
    """A hot bigram: words that share their beginning and end meet only where all but two letters agree."""
    words = [(f"qz{chr(97 + a)}{chr(97 + b)}{chr(97 + c)}{chr(97 + d)}qz", 2) for a in range(8) for b in range(8) for c in range(8) for d in range(8)]
    near = near_pairs(spark.createDataFrame(words, "word string, n long"))
    assert near.count() == 8**4 * 4 * 7


def test_empty_table(spark):
    assert op11_spelling_variants(spark.createDataFrame([], DOCS)).collect() == []
    with pytest.raises(ValueError):
        spelling_variants(spark.createDataFrame([], DOCS), least_length=6)
