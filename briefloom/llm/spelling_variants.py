"""Spelling variant grouping with pivotal grams: all pairs of words one edit apart, and what each word is a form of.

Bigrams are ordered by the number of words that have them, rare ones first. A word's *prefix* is
its three first bigrams in that order (with all that tie with the third). One edit
changes at most two overlapping bigrams, so of two disjoint bigrams one survives: the word's
*pivots* are the cheapest disjoint two of its three, chosen by dynamic programming. If two
words are one edit apart, the pivots of the one whose prefix ends earlier in the order
that survive are in the other's prefix: pivots are looked up in the index of prefixes.

Position limits. An edit lies on one side of a surviving pivot, so all letters on its other side
are in place. A pivot is therefore looked up with everything before it, or with everything
after it, which fixes its place from one end; and because where the edit lies also says
which other letters are in place, with two letters more (``lookups`` has the cases).
A key so holds four letters or more (three in some words of seven). Candidates whose lengths
differ by at most one are verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from briefloom.llm.helpers import stored

FLUSH = 400_000  # words a task holds before it hands its counts on
GRAMS_USED = 3  # bigrams one edit can change, and one more
ENTRY = "key string, word string, n long, last int"


def runs_of(text: str | None, least: int) -> Counter:
    """Maximal runs of at least ``least`` Latin letters (U+00C0 to U+00FF included), A-Z lower-cased."""
    return Counter(re.findall(f"[a-zÀ-ÿ]{{{least},}}", text.encode().lower().decode())) if text else Counter()


def word_counts(
    docs: DataFrame, ident: str, text: str, least_length: int, least_count: int,
    spoil: Callable[[int | None], Callable[[str], str]] | None = None,
) -> DataFrame:
    """(word, n) of all words of ``least_length`` letters that occur ``least_count`` times.

    ``spoil(doc_id)`` gives the function that says as what a run of that text is counted.
    Counts are summed in the task before they are shuffled.
    """

    def rows(counts: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    def run(batches):
        counts: dict[str, int] = {}
        for batch in batches:
            for ident_, text_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = runs_of(text_, least_length)
                change = spoil(ident_) if spoil and found else None
                for word, n in found.items():
                    if change is not None:
                        word = change(word)
                        if len(word) < least_length:
                            continue
                    counts[word] = counts.get(word, 0) + n
                if len(counts) > FLUSH:
                    yield rows(counts)
                    counts = {}
        yield rows(counts)

    source = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def gram_order(words: DataFrame) -> dict[str, int]:
    """Rank of every bigram by (number of words, bigram); there are at most 90 * 90 of them."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.col("word").substr(i, F.lit(2)))
    counts = words.select(F.explode(F.array_distinct(grams)).alias("gram")).groupBy("gram").count().collect()
    return {r["gram"]: i for i, r in enumerate(sorted(counts, key=lambda r: (r["count"], r["gram"])))}


def pivots_of(places: list[int], costs: list[int]) -> list[int]:
    """Two disjoint bigrams (by place) with the least sum of costs.

    Dynamic programme over the bigrams in text order: the best pair that ends with a bigram is that bigram with the
    cheapest one that ends before it begins.
    """
    order = sorted(range(len(places)), key=places.__getitem__)
    best, chosen, cheapest, behind = None, [], None, 0
    for i in order:
        while places[order[behind]] + 2 <= places[i]:
            if cheapest is None or costs[order[behind]] < costs[cheapest]:
                cheapest = order[behind]
            behind += 1
        if cheapest is not None and (best is None or costs[i] + costs[cheapest] < best):
            best, chosen = costs[i] + costs[cheapest], [places[cheapest], places[i]]
    return chosen


def prefix_of(word: str, ranks: dict[str, int]) -> tuple[list[int], list[int], int]:
    """(places of the two pivots, places of the prefix, rank of the prefix's last bigram); four letters or more."""
    own = [ranks[word[i : i + 2]] for i in range(len(word) - 1)]
    order = sorted(range(len(own)), key=lambda i: (own[i], i))
    first = order[:GRAMS_USED]
    last = own[first[-1]]
    return pivots_of(first, [own[i] for i in first]), [i for i in order if own[i] <= last], last


# Kinds of keys: a bigram with all letters before it (up to its end) or after it (from its beginning
# on), alone, with the two letters next to it on the other side, or with the word's last or first two.
def _before(word: str, at: int) -> str:
    return "<" + word[: at + 2]


def _before_next(word: str, at: int) -> str:
    return "<+" + word[: at + 4]


def _before_end(word: str, at: int) -> str:
    return "<|" + word[: at + 2] + "|" + word[-2:]


def _after(word: str, at: int) -> str:
    return ">" + word[at:]


def _after_previous(word: str, at: int) -> str:
    return ">+" + word[at - 2 :]


def _after_start(word: str, at: int) -> str:
    return ">|" + word[:2] + "|" + word[at:]


def lookups(word: str, pivots: list[int]) -> list[str]:
    """Keys under which every word one edit away is found, if its prefix ends no earlier.

    With the pivots at p < q, the edit lies before p (all from p on is in place), after q (all up to
    q's end), between them (all up to p's end, and the last two letters), in q (all but q's letters),
    or in p (all but p's letters).
    """
    p, q = pivots
    keys = [_after(word, p), _before(word, q), _before_end(word, p)]
    if q - p >= 4:
        return [*keys, _before_next(word, p), _after_previous(word, q)]
    if len(word) - q < 4:  # else the key for an edit between the pivots serves
        keys.append(_before(word, p))
    keys.append(_after_start(word, q) if p >= 2 else _after(word, q))
    return keys


def index_keys(word: str, prefix: list[int]) -> list[str]:
    """Keys under which the index has a word: all kinds for each bigram of its prefix."""
    keys, size = [], len(word)
    for at in prefix:
        if at >= 1:
            keys.append(_before(word, at))
        if at <= size - 3:
            keys.append(_after(word, at))
        if at + 4 <= size:
            keys += [_before_next(word, at), _before_end(word, at)]
        if at >= 2:
            keys += [_after_previous(word, at), _after_start(word, at)]
    return keys


def _entries(words: DataFrame, ranks: dict[str, int], index: bool) -> DataFrame:
    def run(batches):
        for batch in batches:
            keys, row, lasts = [], [], []
            for i, word in enumerate(batch.column(0).to_pylist()):
                pivots, prefix, last = prefix_of(word, ranks)
                own = index_keys(word, prefix) if index else lookups(word, pivots)
                keys += own
                row += [i] * len(own)
                lasts += [last] * len(own)
            place = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), batch.column(0).take(place), batch.column(1).take(place), pa.array(lasts, pa.int32())],
                ["key", "word", "n", "last"],
            )

    return words.select("word", "n").mapInArrow(run, ENTRY).withColumn("key", F.xxhash64("key"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n), both ways round, for all pairs of ``words`` (word, n) one edit apart.

    ``words`` are different, of seven letters or more; pass a stored table. Both sides of the join
    are spread by key; a key that many words share is one of letters that they share.
    """
    ranks = gram_order(words)
    ask = _entries(words, ranks, index=False).alias("a")
    have = _entries(words, ranks, index=True).alias("b")
    size = F.length("a.word") - F.length("b.word")
    found = ask.join(have, F.col("a.key") == F.col("b.key")).filter(
        (F.col("a.last") <= F.col("b.last")) & (F.abs(size) <= 1) & (F.levenshtein("a.word", "b.word", 1) == 1)
    )
    pairs = found.select(
        F.explode(F.array(
            F.struct(F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n")),
            F.struct(F.col("b.word").alias("word"), F.col("b.n").alias("n"), F.col("a.word").alias("near"), F.col("a.n").alias("near_n")),
        )).alias("p")
    )
    return pairs.select("p.*").dropDuplicates(["word", "near"])


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) for the words of ``forms`` (word, form): forms are followed to the last one.

    Every round follows all found paths at once, so the rounds are the logarithm of the longest.
    """
    roots = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = stored(roots.join(on, "root", "left").select("word", "root", "further"))
        roots = joined.select("word", F.coalesce("further", "root").alias("root"))
        if joined.filter(F.col("further").isNotNull()).limit(1).count() == 0:
            return roots


def spelling_variants(
    docs: DataFrame, least_length: int = 7, least_count: int = 2, ratio: int = 10, ident: str = "doc_id", text: str = "text",
    spoil: Callable[[int | None], Callable[[str], str]] | None = None,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for all words of the texts that are long and frequent enough.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased. ``form`` is the most
    frequent word one edit away (ties: the smallest) if it is ``ratio`` times as frequent, else
    null; ``root`` is what following forms leads to. Null and empty texts have no words; repeated
    rows count as often as they occur; null ids matter to ``spoil`` only; other columns are not read.
    Of the words, bigram counts alone (90 * 90 at most) reach the driver.
    """
    if least_length < 7:
        raise ValueError("words have seven letters or more")
    words = stored(word_counts(docs, ident, text, least_length, least_count, spoil))
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("form"))).alias("best")
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    taken = -F.col("best.order") >= ratio * F.col("n")
    rows = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.form")).alias("form"), F.when(taken, -F.col("best.order")).alias("form_n"),
    ))
    roots = roots_of(rows.filter(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def spoiled(doc_id: int | None) -> Callable[[str], str]:
    """The contract's misspelling: every 31st run of a text (by crc32 of id and run) loses a letter. A
    null id counts as empty."""
    begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def change(word: str) -> str:
        h = zlib.crc32(word.encode(), begun)
        if h % 31:
            return word
        at = h % len(word)
        return word[:at] + word[at + 1 :]

    return change


def op11_spelling_variants(docs: DataFrame) -> DataFrame:
    return spelling_variants(docs, spoil=spoiled)
