"""Training of a unigram piece table by expectation-maximisation (Kudo 2018).

The corpus is reduced to its different words and their counts. In each round tasks compute, for their
words, how often each piece is expected over all segmentations (forward and backward sums over the lattice of
pieces), and the sums become the new probabilities; the likelihood of the words never falls. Between
rounds the pieces whose removal costs the least likelihood go, until the table has its size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from briefloom.operators.encode import send_table
from briefloom.operators.pieces import Trie
from briefloom.operators.vocab import FIRST_WORD_ID, pieces_of_counts, word_counts
from briefloom.scaling import MAX_BROADCAST_ROWS, materialise, spread

LIKELIHOOD = ""  # the name under which the words' log-likelihood travels with the pieces' sums; no piece is empty
LEAST = 1e-4  # expected count below which a letter does not fall, so that every word keeps a segmentation


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values)) if top > -math.inf else top


def expectations(word: str, trie: Trie) -> tuple[float, dict[int, float]]:
    """(log-likelihood, expected number of each piece by code) over all segmentations of a word.

    (-inf, {}) where the pieces do not make up the word.
    """
    edges = [list(trie.edges(word, start)) for start in range(len(word))]
    into: list[list[float]] = [[] for _ in range(len(word) + 1)]
    forward = [0.0] + [-math.inf] * len(word)
    for start, own in enumerate(edges):
        if start:
            forward[start] = _log_sum(into[start]) if into[start] else -math.inf
        if forward[start] > -math.inf:
            for end, score, _ in own:
                into[end].append(forward[start] + score)
    total = _log_sum(into[-1]) if into[-1] else (0.0 if not word else -math.inf)
    if total == -math.inf:
        return total, {}
    backward = [-math.inf] * len(word) + [0.0]
    expected: dict[int, float] = {}
    for start in range(len(word) - 1, -1, -1):
        out = [score + backward[end] for end, score, _ in edges[start]]
        if out:
            backward[start] = _log_sum(out)
        if forward[start] > -math.inf:
            for (_, _, code), rest in zip(edges[start], out):
                if rest > -math.inf:
                    expected[code] = expected.get(code, 0.0) + math.exp(forward[start] + rest - total)
    return total, expected


def _trie_of(sent) -> tuple[Trie, list[str]]:
    if "trie" not in sent.built:
        names = sent.table.column("piece").to_pylist()
        sent.built["trie"] = Trie(zip(names, sent.table.column("logp").to_pylist(), range(len(names)))), names
    return sent.built["trie"]


def _sent(pieces: DataFrame, max_rows: int):
    sent = send_table(pieces.select("piece", "logp"), max_rows)
    if sent is None:
        raise ValueError(f"seeds beyond {max_rows} pieces: lower size or seed_factor")
    return sent


def expected_counts(words: DataFrame, pieces: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """(piece, expected): expected counts over (word, count) rows, and the log-likelihood under the empty name."""
    sent = _sent(pieces, max_rows)

    def run(batches):
        trie, names = _trie_of(sent.value)
        sums, likelihood = [0.0] * len(names), 0.0
        for batch in batches:
            for word, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total, own = expectations(word, trie)
                if total > -math.inf:
                    likelihood += count * total
                    for code, value in own.items():
                        sums[code] += count * value
        some = [(n, v) for n, v in zip(names, sums) if v] + [(LIKELIHOOD, likelihood)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), (pa.string(), pa.float64()))], ["piece", "expected"])

    made = words.select("word", "count").mapInArrow(run, "piece string, expected double")
    return made.groupBy("piece").agg(F.sum("expected").alias("expected"))


def losses(pieces: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``pieces`` (piece, expected, logp) with ``loss``: what the likelihood loses, about, when a piece goes and its
    occurrences are made of the best others; null for letters, which stay."""
    sent = _sent(pieces, max_rows)

    def run(batches):
        trie, _ = _trie_of(sent.value)
        for batch in batches:
            out = []
            for piece, expected, score in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if len(piece) == 1:
                    out.append(None)
                    continue
                best = [0.0] + [-math.inf] * len(piece)
                for start in range(len(piece)):
                    for end, other, _ in trie.edges(piece, start):
                        if end - start < len(piece):
                            best[end] = max(best[end], best[start] + other)
                out.append(expected * (score - best[-1]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], ["piece", "expected", "logp", "loss"])

    return pieces.select("piece", "expected", "logp").mapInArrow(run, "piece string, expected double, logp double, loss double")


@dataclass
class Trained:
    """A trained table (piece, expected, logp, id), and the log-likelihood before each round, by table size."""

    pieces: DataFrame
    likelihoods: list[tuple[int, float]] = field(default_factory=list)


def train_pieces(
    df: DataFrame, text_col: str = "text", size: int = 8_000, longest: int = 8, seed_factor: int = 3, shrink: float = 0.6,
    rounds: int = 2, unicode: bool = False, max_rows: int = MAX_BROADCAST_ROWS,
) -> Trained:
    """A table of ``size`` pieces (more if there are more letters), trained on the words of a text column.

    Seeds are the ``seed_factor * size`` most frequent substrings. ``rounds`` rounds of
    expectation-maximisation follow every cut to ``shrink`` of the pieces, and the last one. Ids go by
    falling expected count, ties by piece. The table of seeds must fit ``max_rows``; a corpus without words gives no pieces.
    """
    # a text is read once; the different words are few bytes, which Spark joins into few tasks, but each is much work
    words = materialise(spread(materialise(word_counts(df, text_col, unicode))))
    pieces = materialise(pieces_of_counts(words, seed_factor * size, longest).select("piece", "logp"))
    out = Trained(pieces)
    while True:
        for _ in range(rounds):
            found = materialise(expected_counts(words, pieces, max_rows))
            n, total, likelihood = found.agg(
                F.count(F.lit(1)), F.sum(F.when(F.col("piece") != LIKELIHOOD, F.col("expected"))),
                F.sum(F.when(F.col("piece") == LIKELIHOOD, F.col("expected"))),
            ).first()
            letters = pieces.filter(F.length("piece") == 1).select("piece")
            kept = found.filter(F.col("piece") != LIKELIHOOD).join(letters.withColumn("letter", F.lit(True)), "piece", "full")
            value = F.coalesce("expected", F.lit(0.0))
            value = F.when(F.col("letter"), F.greatest(value, F.lit(LEAST))).otherwise(value)
            pieces = materialise(
                kept.select("piece", value.alias("expected")).filter(F.col("expected") > 0)
                .withColumn("logp", F.log(F.col("expected") / F.lit(max(total or 1.0, LEAST))))
            )
            out.likelihoods.append((n - 1, likelihood or 0.0))
        letters = pieces.filter(F.length("piece") == 1)
        n, n_letters = pieces.count(), letters.count()
        if n <= max(size, n_letters):
            break
        room = max(size, math.ceil(n * shrink)) - n_letters
        best = losses(pieces, max_rows).filter(F.col("loss").isNotNull()).orderBy(F.desc("loss"), "piece").limit(max(room, 0))
        pieces = materialise(best.select("piece", "expected", "logp").unionByName(letters.select("piece", "expected", "logp")))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc(F.round("expected", 6)), "piece")  # a table of limited size
    ranked = pieces.withColumn("id", (F.row_number().over(order) + (FIRST_WORD_ID - 1)).cast("int"))
    out.pieces = ranked.select("piece", "expected", F.round("logp", 6).alias("logp"), "id")
    return out
