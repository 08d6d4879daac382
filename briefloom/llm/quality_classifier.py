"""Quality classifier: Gaussian-kernel ridge regression on document statistics.

Random Fourier features approximate the kernel. The normal equations are sums over rows: every
partition adds up its own, and only sums of fixed size are combined and solved. Ridge scores
are then calibrated by isotonic regression on the training rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from briefloom.llm.helpers import fold_of, stored
from briefloom.llm.kernels import Words, mix, slices
from briefloom.llm.learning import calibrated, calibration, summed, with_labels

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
STATISTICS = (
    "log_words", "word_length", "length_spread", "different_words", "top_word", "same_as_before", "repeated_windows",
    "upper", "digits", "punctuation", "symbols", "exclamations", "other_bytes", "spaces", "lines", "sentence_ends",
    "capital_words", "symbol_ends", "pipes", "repeated_lines",
)


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return np.diff(total[offsets])


def statistics(texts: pa.Array) -> np.ndarray:
    """Row of ``STATISTICS`` for each whole text; zeros for a text without words."""
    out = np.zeros((len(texts), len(STATISTICS)))
    for i, j in slices(texts):
        w = Words(texts.slice(i, j - i))
        raw, n = w.raw, np.maximum(w.counts, 1)
        size = np.maximum(np.diff(w.offsets), 1)
        length = (w.end - w.start).astype(np.float64)
        of = w.text_of_word()
        mean = np.bincount(of, length, len(n)) / n
        spread = np.sqrt(np.maximum(np.bincount(of, length**2, len(n)) / n - mean**2, 0))
        first, last = raw[w.start], raw[w.end - 1]
        same = np.zeros(len(of), bool)
        same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (of[1:] == of[:-1])
        upper, symbol = (raw >= 65) & (raw <= 90), np.isin(raw, _SYMBOLS)
        punct = np.isin(raw, np.frombuffer(b".,;:?'\"()-", np.uint8))
        at, windows = w.windows(8)
        cuts = np.searchsorted(at, w.bounds)
        newline = np.flatnonzero(raw == 10)
        # distinct words, most frequent word, windows and lines met before: per text
        different, top, again, lines_again = (np.zeros(len(n)) for _ in range(4))
        word_line = np.searchsorted(newline, w.start)
        for k in range(len(n)):
            a, b = w.bounds[k], w.bounds[k + 1]
            if b == a:
                continue
            _, counts = np.unique(w.hashes[a:b], return_counts=True)
            different[k], top[k] = len(counts) / (b - a), counts.max() / (b - a)
            own = windows[cuts[k] : cuts[k + 1]]
            if len(own):
                again[k] = 1 - len(np.unique(own)) / len(own)
            starts = np.flatnonzero(np.diff(word_line[a:b], prepend=-1))
            if len(starts) > 1:
                place = np.arange(b - a) - np.repeat(starts, np.diff(np.append(starts, b - a)))
                lines = np.add.reduceat(mix(w.hashes[a:b] ^ place.astype(np.uint64)), starts)
                lines_again[k] = 1 - len(np.unique(lines)) / len(lines)
        share = lambda mask: _per_text(mask, w.offsets) / size
        per_word = lambda mask: np.bincount(of, mask, len(n)) / n
        out[i:j] = np.column_stack(
            [
                np.log1p(w.counts), mean, spread, different, top, per_word(same), again, share(upper),
                share((raw >= 48) & (raw <= 57)), share(punct), share(symbol), share(raw == 33), share(raw >= 128),
                share(raw <= 32), _per_text(raw == 10, w.offsets) / n, per_word(last == 46),
                per_word((first >= 65) & (first <= 90)), per_word(np.isin(last, _SYMBOLS)), share(raw == 124), lines_again,
            ]
        )
        out[i:j][w.counts == 0] = 0
    return out


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    curve: tuple[np.ndarray, np.ndarray]

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.column_stack([waves, np.ones(len(z))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.features(stats) @ self.weights, -1, 2)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return calibrated(self.raw(stats), self.curve)


def document_statistics(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, stats) of every row."""

    def run(batches):
        for batch in batches:
            stats = statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in stats], pa.binary())], ["doc_id", "stats"]
            )

    rows = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, stats binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), len(STATISTICS))


def _partition_sums(rows: DataFrame, of_batch) -> np.ndarray:
    def run(batches):
        total = 0
        for batch in batches:
            if batch.num_rows:
                total = total + of_batch(_matrix(batch.column(0)), np.array(batch.column(1).to_pylist(), np.float64))
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["v"])

    total = summed(rows.select("stats", "label").mapInArrow(run, "v binary"))
    return np.asarray(total, np.float64)


def fit(train: DataFrame, features: int = 256, width: float = 1.0, ridge: float = 1e-3, seed: int = 5) -> QualityModel:
    """Model from (stats, label) rows, all of which are used. ``width`` is in units of the median distance."""
    d = len(STATISTICS)
    moments = _partition_sums(train, lambda x, y: np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)]))
    if moments.ndim == 0 or not len(moments):
        moments = np.concatenate([[1.0], np.zeros(d), np.ones(d)])
    n, mean = moments[0], moments[1 : d + 1] / moments[0]
    scale = np.sqrt(np.maximum(moments[d + 1 :] / n - mean**2, 1e-12))
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(d, features)) / (width * np.sqrt(2 * d))
    model = QualityModel(mean, scale, directions, rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), (np.zeros(1), np.full(1, 0.5)))
    m = features + 1

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.features(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = _partition_sums(train, equations)
    if sums.ndim == 0 or not len(sums):
        return model
    gram = sums[: m * m].reshape(m, m)
    model.weights = np.linalg.solve(gram + ridge * n * np.diag(np.append(np.ones(features) / features, 1e-9)), sums[m * m :])
    model.curve = calibration(_scored(train, model.raw, ("label",)), "score", "label", 0.002)
    return model


def _scored(rows: DataFrame, function, keep: tuple[str, ...]) -> DataFrame:
    kinds = dict(rows.dtypes)

    def run(batches):
        for batch in batches:
            scores = function(_matrix(batch.column("stats"))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(scores, pa.float64())], [*keep, "score"]
            )

    return rows.select(*keep, "stats").mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in keep), "score double"]))


def quality_scores(
    docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held_out: int = 2,
    ident: str = "doc_id", text: str = "text", threshold: float = 0.7,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Learns from every labelled row outside the held-out fold (by crc32 of the id as text), from
    nothing but text. Null and empty texts have statistics of zero and get that score. Without labels
    every score is 0.5. Null ids are never labelled. Repeated rows get equal scores. Other columns
    of ``docs`` and ``labels`` are not read.
    """
    stats = stored(document_statistics(docs, ident, text)).withColumn("fold", fold_of("doc_id", folds))
    train = with_labels(stats.filter(F.col("fold") != held_out), labels.select("doc_id", label), label)
    model = fit(stored(train.select("stats", "label")))
    rows = stats.withColumn("held_out", F.col("fold") == held_out)
    return _scored(rows, model.score, ("doc_id", "held_out")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def op3_quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return quality_scores(docs, labels)
