"""Language identification in two steps: family first, then one-versus-one within the family.

Texts become hashed counts of letter n-grams. Linear support vector machines separate every pair of
families; others, trained on one family's texts only, separate every pair of its languages,
so that closely related languages are told apart by what differs between them. Each machine
is one group of a grouped map: all are trained side by side by Spark tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from briefloom.llm.helpers import fold_of
from briefloom.llm.kernels import mix, text_bytes

DIMENSIONS = 4096
# Families of language codes. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb li nb nds nl nn no sv yi",
    "romance": "an ast ca co es fr gl it la lmo oc pms pt ro sc scn vec wa",
    "slavic": "be bg bs cs hr hsb mk pl ru sh sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd gv kw",
    "uralic": "et fi hu se",
    "turkic": "az ba kk ky tk tr tt ug uz",
    "indo-aryan": "as bn gu hi mr ne or pa sd si ur",
    "iranian": "ckb fa ku ps tg",
    "semitic": "am ar arz he mt ti",
    "dravidian": "kn ml ta te",
    "austronesian": "ceb id jv mg mi ms su tl",
    "japonic": "ja",
    "koreanic": "ko",
    "sinitic": "wuu yue zh",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().split("-")[0], lang)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


# Bytes of lower-cased text: letters stand for themselves, all other ASCII counts as a space.
_SHOWN = np.arange(256, dtype=np.uint64)
_SHOWN[:97] = 32
_SHOWN[123:128] = 32


def n_grams(texts: list[str | None]) -> np.ndarray:
    """Row of hashed 1- to 4-byte gram counts per whole text: root of the counts, length 1."""
    raw, offsets = text_bytes(pa.array([(f" {t.lower()} " if t else " ") for t in texts], pa.large_string()))
    shown = _SHOWN[raw]
    grams = np.zeros((4, len(raw)), np.uint16)
    key = np.zeros(len(raw), np.uint64)
    for k in range(4):
        key[: len(raw) - k] = key[: len(raw) - k] * np.uint64(257) + shown[k:]
        grams[k] = mix(key + np.uint64(k << 56)) % np.uint64(DIMENSIONS)
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        for k in range(4):
            if b - k > a:
                out[i] += np.bincount(grams[k, a : b - k], minlength=DIMENSIONS)
    np.sqrt(out, out)
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return out


def support_vectors(x: np.ndarray, y: np.ndarray, c: float = 1.0, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Weights and bias of a linear machine (squared hinge, L2) by dual coordinate descent; y is -1/1."""
    x = np.column_stack([x, np.ones(len(x), np.float32)])
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    # both sides weigh the same, however many rows they have
    cost = np.where(y > 0, c * len(y) / (2 * max((y > 0).sum(), 1)), c * len(y) / (2 * max((y < 0).sum(), 1)))
    diagonal = (x * x).sum(1) + 1 / (2 * cost)
    order, rng = np.arange(len(x)), np.random.default_rng(seed)
    for _ in range(rounds):
        rng.shuffle(order)
        for i in order:
            gradient = y[i] * (x[i] @ w) - 1 + alpha[i] / (2 * cost[i])
            new = max(alpha[i] - gradient / diagonal[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


@dataclass
class LanguageModel:
    languages: dict[str, list[str]]  # family -> its languages
    machines: dict[tuple[str, str, str], np.ndarray]  # (family or "", a, b) -> weights, positive for a

    def _duel(self, x: np.ndarray, level: str, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(winner, its confidence) per row: votes of all pairs, ties by summed margin."""
        if len(names) == 1:
            return np.zeros(len(x), np.int64), np.ones(len(x))
        votes, margins = np.zeros((2, len(x), len(names)))
        for i, j in combinations(range(len(names)), 2):
            w = self.machines[level, names[i], names[j]]
            m = x @ w[:-1] + w[-1]
            votes[:, i] += m > 0
            votes[:, j] += m <= 0
            margins[:, i] += m
            margins[:, j] -= m
        best = np.argmax(votes + np.tanh(margins) / 4, axis=1)
        mean = margins[np.arange(len(x)), best] / (len(names) - 1)
        return best, 1 / (1 + np.exp(-4 * np.clip(mean, -8, 8)))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        families = sorted(self.languages)
        names, score = ["und"] * len(texts), np.zeros(len(texts))
        asked = [i for i, t in enumerate(texts) if has_letter(t)]
        if not families or not asked:
            return names, score
        x = n_grams([texts[i] for i in asked])
        family, sure = self._duel(x, "", families)
        for f, name in enumerate(families):
            rows = np.flatnonzero(family == f)
            if len(rows):
                best, within = self._duel(x[rows], name, self.languages[name])
                for r, b, p in zip(rows, best, within):
                    names[asked[r]] = self.languages[name][b]
                    score[asked[r]] = sure[r] * p
        return names, score


def fit(rows: DataFrame, per_language: int = 1500) -> LanguageModel:
    """Model from (text, lang) rows; about ``per_language`` different texts per language, at least one, are sampled.

    There is one machine for each pair of families and each pair of languages of a family: ``lang``
    is taken to hold some hundred codes at most.

    The sample is a fixed hash threshold on the text for each language, so reruns agree; it bounds
    what a training task holds. Of the texts, all letters are used.
    """
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("hash", F.xxhash64("text"))
    rows = rows.withColumn("at", F.pmod("hash", F.lit(1_000_000_007)))
    # copies of a text are one: hashes are told apart within tasks before they are shuffled
    told = rows.select("lang", "hash", "at").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("least"))
    counts = {r["lang"]: (r["n"], r["least"]) for r in told.collect()}
    languages: dict[str, list[str]] = {}
    for lang in sorted(counts):
        languages.setdefault(family_of(lang), []).append(lang)
    model = LanguageModel(languages, {})
    duels = [("", a, b) for a, b in combinations(sorted(languages), 2)]
    duels += [(f, a, b) for f, names in languages.items() for a, b in combinations(names, 2)]
    if not duels:
        return model
    last = {k: max(least, int(min(1.0, per_language / n) * 1_000_000_007)) for k, (n, least) in counts.items()}
    chosen = rows.filter(F.col("at") <= F.create_map(*[F.lit(v) for kv in last.items() for v in kv])[F.col("lang")])
    chosen = chosen.select("text", "lang").distinct()

    def grams(batches):
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(0, len(texts), 256):
                part = [k for k in range(i, min(i + 256, len(texts))) if has_letter(texts[k])]
                x = n_grams([texts[k] for k in part]).astype(np.float16)
                out = [
                    (n, langs[k], v.tobytes())
                    for k, v in zip(part, x)
                    for n, (level, a, b) in enumerate(duels)
                    if (level == "" and family_of(langs[k]) in (a, b)) or (level and langs[k] in (a, b))
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(list(zip(*out)) or [(), (), ()], (pa.int32(), pa.string(), pa.binary()))],
                    ["duel", "lang", "x"],
                )

    def train(group: pa.Table) -> pa.Table:
        n = group["duel"][0].as_py()
        level, a, _ = duels[n]
        x = np.frombuffer(b"".join(group["x"].to_pylist()), np.float16).reshape(-1, DIMENSIONS).astype(np.float32)
        names = group["lang"].to_pylist()
        y = np.array([1 if (family_of(m) if level == "" else m) == a else -1 for m in names])
        order = np.lexsort((x @ np.arange(1, DIMENSIONS + 1, dtype=np.float32), y))  # whatever the order of arrival
        return pa.table({"duel": pa.array([n], pa.int32()), "w": pa.array([support_vectors(x[order], y[order]).tobytes()], pa.binary())})

    trained = chosen.mapInArrow(grams, "duel int, lang string, x binary").groupBy("duel").applyInArrow(train, "duel int, w binary")
    # one fixed-size row per pair of languages
    got = {r["duel"]: np.frombuffer(r["w"], np.float64) for r in trained.collect()}
    for n, duel in enumerate(duels):
        model.machines[duel] = got.get(n, np.zeros(DIMENSIONS + 1))
    return model


def identify_languages(
    docs: DataFrame, folds: int = 3, held_out: int = 1, per_language: int = 1500,
    ident: str = "doc_id", text: str = "text", lang: str = "lang",
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``.

    Learns from texts with a language outside the held-out fold (by crc32 of the id as text). A
    null or letterless text is ``und`` with score 0, as are all without any training text. With
    one language in training every text with a letter gets it. Equal texts get equal results;
    other columns are not read.
    """
    rows = docs.select(
        F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
        F.col(lang).cast("string").alias("lang"), (fold_of(ident, folds) == held_out).alias("held_out"),
    )
    model = fit(rows.filter(~F.col("held_out")).select("text", "lang"), per_language)

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            names, scores = [], []
            for i in range(0, len(texts), 256):
                a, b = model.predict(texts[i : i + 256])
                names += a
                scores.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows.select("doc_id", "text", "held_out").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double"
    )


def op4_language_id(docs: DataFrame) -> DataFrame:
    return identify_languages(docs)
