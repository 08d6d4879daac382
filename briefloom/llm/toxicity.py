"""Toxic passages by maximum-scoring segment search.

A token is a word or the beginning of a word, so that inflected and compound forms share what is
known of their stem. Its score is its log-odds between toxic and other labelled texts under a
Dirichlet prior proportional to its frequency in the whole corpus. A word scores as its best
token; words without a token that stands out cost a constant. One linear scan of a text's word scores finds all maximal scoring
segments. Extreme-value statistics, with parameters from the non-toxic labelled texts, say how
surprising a segment is in a text of that length; the significant ones are the passages, and
their evidence, summed and calibrated, is the text's score.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from briefloom.llm.helpers import fold_of, stored
from briefloom.llm.learning import calibrated, calibration, one_label
from briefloom.scaling import MAX_BROADCAST_ROWS, row_count_at_most

TOKEN = re.compile(r"[^\W\d_]+")
COUNTS = "token string, n_all long, n_toxic long, n_other long"
FLUSH = 400_000  # tokens a task holds before it hands its counts on


STEMS = range(4, 9)  # lengths of word beginnings that count as tokens
CACHE = 300_000  # words whose score a task remembers


def words_of(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def tokens_of(word: str) -> list[str]:
    """The word (marked by a full stop) and its beginnings."""
    return [word + ".", *(word[:k] for k in STEMS if k < len(word))]


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, texts, toxic texts, other texts) over all rows of (text, label); label may be null.

    A text counts once for each of its different words, so that repetition inside a text has no
    say. Words are counted within a task before the shuffle, and the counts of their beginnings are
    summed from the counts of words, not from texts.
    """

    def run(batches):
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                place = None if label is None else 1 if label else 2
                for word in set(words_of(text)):
                    own = counts.get(word)
                    if own is None:
                        own = counts[word] = [0, 0, 0]
                    own[0] += 1
                    if place:
                        own[place] += 1
                if len(counts) > FLUSH:
                    yield _count_rows(counts)
                    counts = {}
        yield _count_rows(counts)

    sums = [F.sum(c).alias(c) for c in ("n_all", "n_toxic", "n_other")]
    of_words = docs.select("text", "label").mapInArrow(run, COUNTS).groupBy("token").agg(*sums)
    beginnings = [F.when(F.length("token") > k, F.substring("token", 1, k)) for k in STEMS]
    tokens = F.explode(F.array_compact(F.array(F.concat("token", F.lit(".")), *beginnings)))
    return of_words.select(tokens.alias("token"), "n_all", "n_toxic", "n_other").groupBy("token").agg(*sums)


def _count_rows(counts: dict[str, list[int]]) -> pa.RecordBatch:
    columns = list(zip(*counts.values())) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), *[pa.array(c, pa.int64()) for c in columns]],
        ["token", "n_all", "n_toxic", "n_other"],
    )


def log_odds(counts: DataFrame, prior: float = 0.01) -> DataFrame:
    """(token, delta, z): log-odds of toxic against other texts, and its standard score.

    The prior of a token is ``prior`` times its share in the corpus times all labelled counts.
    """
    total = counts.agg(*[F.sum(c).alias(c) for c in ("n_all", "n_toxic", "n_other")]).first()
    n_all, n_toxic, n_other = (float(x or 0) for x in total)
    mass = max(prior * (n_toxic + n_other), 1e-9)
    a = F.col("n_all") * F.lit(mass / max(n_all, 1.0))
    toxic, other = F.col("n_toxic") + a, F.col("n_other") + a
    delta = F.log(toxic / (n_toxic + mass - toxic + 1e-9)) - F.log(other / (n_other + mass - other + 1e-9))
    return counts.select("token", delta.alias("delta"), (delta / F.sqrt(1 / toxic + 1 / other)).alias("z"))


def segments(scores: list[float], places: list[int], cost: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), by one scan from left to right.

    ``scores`` are the positive tokens at ``places``; every other token costs ``cost``. Candidates
    are kept with the running totals before and after them. A new one is joined with the
    nearest earlier candidate that starts lower if it ends higher, and so on; each candidate is
    joined at most once, so the work is linear in the positive tokens.
    """
    found: list[list[float]] = []  # first, last, total before, total after, link to the nearest lower start
    total, at = 0.0, 0
    for place, score in zip(places, scores):
        total -= cost * (place - at)
        at = place + 1
        new = [place, place, total, total + score, -1]
        total += score
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = int(found[j][4])
            if j < 0 or found[j][3] >= new[3]:
                new[4] = j
                found.append(new)
                break
            new[0], new[2] = found[j][0], found[j][2]
            del found[j:]
    return [(int(a), int(b), after - before) for a, b, before, after, _ in found]


@dataclass
class Lexicon:
    """Scores of the tokens that stand out; any other word costs ``cost``."""

    scores: dict[str, float]
    cost: float

    def score_of(self, word: str) -> float | None:
        return max((s for t in tokens_of(word) if (s := self.scores.get(t)) is not None), default=None)

    def scan(self, text: str | None, known: dict[str, float | None]) -> tuple[list[tuple[int, int, float]], int]:
        """(maximal segments, number of words); ``known`` remembers word scores between texts."""
        words = words_of(text)
        for word in set(words).difference(known):
            known[word] = self.score_of(word)
        hits = [(i, s) for i, s in enumerate(map(known.__getitem__, words)) if s is not None]
        if len(known) > CACHE:
            known.clear()
        return segments([s for _, s in hits], [i for i, _ in hits], self.cost), len(words)


def fit_lexicon(rows: DataFrame, z: float = 4.0, least_delta: float = 1.0, cost: float = 0.05, prior: float = 0.01,
                max_tokens: int = MAX_BROADCAST_ROWS) -> Lexicon:
    """Lexicon from all rows of (text, label); rows without a label count towards the prior.

    Tokens with standard score ``z`` and log-odds ``least_delta`` get their log-odds as score. A
    token needs several toxic texts for that, so the table grows far slower than the corpus; it is
    counted, and the fit stops with an error where it would not fit every task.
    """
    odds = stored(log_odds(stored(token_counts(rows)), prior).filter((F.col("z") >= z) & (F.col("delta") >= least_delta)))
    if (size := odds.count()) > max_tokens:
        raise ValueError(f"{size} telling tokens; raise z to keep the table below {max_tokens}")
    return Lexicon({r["token"]: float(r["delta"]) for r in odds.select("token", "delta").collect()}, cost)


SEGMENTS = "array<struct<first:int,last:int,score:double>>"


def scan(rows: DataFrame, lexicon: Lexicon, keep: tuple[str, ...]) -> DataFrame:
    """Columns ``keep``, number of words and maximal scoring segments of every whole text."""
    kinds = dict(rows.dtypes)
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        known: dict = {}
        for batch in batches:
            found, sizes = zip(*(lexicon.scan(t, known) for t in batch.column(0).to_pylist())) if batch.num_rows else ((), ())
            spans = [[{"first": a, "last": b, "score": s} for a, b, s in f] for f in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(sizes, pa.int64()), pa.array(spans, kind)], [*keep, "n_words", "segments"]
            )

    shape = ", ".join([*(f"{c} {kinds[c]}" for c in keep), "n_words long", f"segments {SEGMENTS}"])
    return rows.select("text", *keep).mapInArrow(run, shape)


def background(scanned: DataFrame, cost: float) -> tuple[float, float]:
    """(lambda, K) from the non-toxic labelled rows of a scan.

    The number of segments that score x or more in n words has mean K n exp(-lambda x).
    lambda solves sum p exp(lambda s) = 1 over the scores of these texts; K is their number
    of segments a word, carried back to score 0.
    """
    clean = scanned.filter("label = 0")
    words = max(clean.agg(F.sum("n_words")).first()[0] or 0, 1)
    # in tenths, and all above 100 alike: at most 1,001 bins
    tenth = F.floor(F.least(F.col("s"), F.lit(100.0)) * 10).alias("bin")
    bins = clean.select(F.explode("segments.score").alias("s")).groupBy(tenth).count()
    hits = {r["bin"] / 10 + 0.05: float(r["count"]) for r in bins.collect()}
    # never fewer than half a segment in all: absence of evidence is worth as much as the data are
    hits[5.0] = hits.get(5.0, 0.0) + 0.5
    share = {s: v / words for s, v in hits.items()}
    rest = 1 - min(sum(share.values()), 0.5)

    def excess(rate: float) -> float:
        return sum(p * math.exp(min(rate * s, 700)) for s, p in share.items()) + rest * math.exp(-rate * cost) - 1

    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    decay = max(low, 1e-3)
    scale = sum(v * math.exp(min(decay * s, 700)) for s, v in hits.items()) / words
    return decay, min(max(scale, 1e-12), 1.0)


def weighed(scanned: DataFrame, decay: float, scale: float, significance: float) -> DataFrame:
    """A scan with ``passages`` (significant segments and their p-value) and the texts' ``evidence``.

    A segment's surprise is minus the logarithm of the number of such segments expected by
    chance in a text of this length; evidence is the sum of positive surprises, up to 100, plus a
    little for each segment.
    """
    surprise = lambda s: F.lit(decay) * s["score"] - F.log(F.lit(scale) * F.greatest("n_words", F.lit(1)))
    chance = lambda s: -F.expm1(-F.exp(-F.greatest(F.least(surprise(s), F.lit(700.0)), F.lit(-700.0))))
    marked = F.transform("segments", lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), s["score"].alias("score"), chance(s).alias("p")))
    total = F.aggregate("segments", F.lit(0.0), lambda acc, s: acc + F.greatest(F.lit(0.0), surprise(s)))
    return scanned.withColumn("passages", F.filter(marked, lambda s: s["p"] <= significance)).withColumn(
        "evidence", F.least(F.lit(100.0), total) + F.least(F.lit(20), F.size("segments")) / 20
    )


def toxic_passages(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 4, held_out: int = 2,
    ident: str = "doc_id", text: str = "text", threshold: float = 0.3, significance: float = 0.01,
) -> DataFrame:
    """(doc_id, held_out, score, evidence, passages, predicted) for every row of ``docs``.

    Passages are spans of word numbers (runs of letters, lower-cased). Learns labels outside the
    held-out fold only; the prior counts the words of all texts. Null, empty and letterless texts
    have no passage and the score of no evidence. Without labels the scores are 0.5. Null ids have no
    label; repeated rows get equal scores; other columns are not read. Texts are read twice: to
    count words and to scan.
    """
    rows = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("held_out", fold_of("doc_id", folds) == held_out)
    # a left join: unlabelled texts count for the prior
    known = stored(one_label(labels, label).filter(fold_of("doc_id", folds) != held_out))
    marked = rows.join(F.broadcast(known) if row_count_at_most(known, MAX_BROADCAST_ROWS) else known, "doc_id", "left")
    lexicon = fit_lexicon(marked)
    scanned = stored(scan(marked, lexicon, ("doc_id", "held_out", "label")))
    found = weighed(scanned, *background(scanned, lexicon.cost), significance)
    curve = calibration(found.filter("label is not null"), "evidence", "label", 0.05)

    def run(batches):
        for batch in batches:
            evidence = np.array(batch.column(2).to_pylist(), np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(calibrated(evidence, curve), pa.float64())],
                ["doc_id", "held_out", "evidence", "passages", "score"],
            )

    kind = dict(found.dtypes)["passages"]
    return found.select("doc_id", "held_out", "evidence", "passages").mapInArrow(
        run, f"doc_id long, held_out boolean, evidence double, passages {kind}, score double"
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op10_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return toxic_passages(docs, labels).select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))
