"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, names and units turn into typed placeholders, everything
else into its lower-cased core. Windows of template tokens of documents and benchmark items are
hash-joined; along each alignment the values behind the placeholders must then map one to
one, so a question asked again with other numbers or names is caught, and a text that merely has
the same shape is not. The same windows are also compared with names as plain words, and word for
word, so that a copy in other letter case, or one dense with numbers and names, is caught as well.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from briefloom.llm.helpers import stored
from briefloom.llm.kernels import mix
from briefloom.scaling import MAX_BROADCAST_ROWS

# Units of measure that become a placeholder behind a number.
UNITS = set(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t ton tons tonne tonnes lb lbs pound pounds oz "
    "ounce ounces ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours "
    "day days week weeks month months year years hz khz mhz ghz w kw mw j kj cal kcal v a k c f pa bar percent dollar "
    "dollars euro euros cent cents usd eur gbp yen mph kmh bit bits byte bytes kb mb gb tb degree degrees".split()
)
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:[eE][+-]?\d+)?(?:%|st|nd|rd|th)?[$€£]?$")
LITERAL, NUM, UNIT, CAPITAL = range(4)
PLACE = mix(np.array([11, 22, 33], np.uint64))  # number, unit, name


class Vocabulary(dict):
    """Word -> row of ``hash``, ``kind`` and ``ends`` (whether a sentence ends here); grows as words come."""

    def __init__(self):
        super().__init__()
        self.hash, self.kind, self.ends = np.zeros(1024, np.uint64), np.zeros(1024, np.int8), np.zeros(1024, bool)

    def __missing__(self, word: str) -> int:
        i = len(self)
        if i == len(self.hash):
            self.hash, self.kind, self.ends = (np.concatenate([x, np.zeros_like(x)]) for x in (self.hash, self.kind, self.ends))
        core = core_of(word)
        low = core.lower()
        data = low.encode()
        self.hash[i] = zlib.crc32(data) | zlib.crc32(data[::-1] + b"#") << 32
        if NUMBER.match(core):
            self.kind[i] = NUM
        elif low in UNITS:
            self.kind[i] = UNIT
        elif core[:1].isupper() and core[1:].islower():
            self.kind[i] = CAPITAL
        self.ends[i] = word.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", ":", "…")
        self[word] = i
        return i


def core_of(word: str) -> str:
    """The word without punctuation around it; a word of punctuation only is itself."""
    return word.strip(".,;:!?\"'()[]{}«»“”‘’…-") or word


def templates(ids: np.ndarray, first: np.ndarray, words: Vocabulary) -> list[tuple[np.ndarray, np.ndarray]]:
    """(token hashes, whether a token is a placeholder) of word rows; ``first`` marks beginnings of texts.

    Three times: with all placeholders, with names as plain words, and with plain words only.
    """
    kind, plain = words.kind[ids], mix(words.hash[ids])
    ends = words.ends[ids]
    starts = first.copy()
    starts[1:] |= ends[:-1]
    number = kind == NUM
    unit = kind == UNIT
    unit[1:] &= number[:-1]
    unit[first] = False
    name = (kind == CAPITAL) & ~starts
    folded = plain.copy()
    for mask, value in zip((number, unit), PLACE):
        folded[mask] = value
    full = folded.copy()
    full[name] = PLACE[2]
    return [(full, number | unit | name), (folded, number | unit), (plain, np.zeros(len(ids), bool))]


def _windows(hashes: np.ndarray, slots: np.ndarray, lengths: np.ndarray, width: int, literals: int, new: np.ndarray | None):
    """(first token, hash) of the windows of ``width`` tokens in one text with enough literal tokens.

    With ``new`` (a mask of tokens) only windows with one of these tokens.
    """
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def within(mask: np.ndarray) -> np.ndarray:
        filled = np.concatenate(([0], np.cumsum(mask)))
        return filled[width:] - filled[:-width]

    base = 0xD1342543DE82EF95
    total = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        total = total * np.uint64(base) + hashes[k : n - width + 1 + k]
    ends = np.repeat(np.cumsum(lengths), lengths)[: n - width + 1]
    few = within(slots) <= width - literals
    if new is not None:
        few &= within(new) > 0
    at = np.flatnonzero((np.arange(n - width + 1) + width <= ends) & few)
    return at, mix(total[at] + np.uint64(width))


def template_windows(rows: DataFrame, widths: list[int], share: float, wanted: np.ndarray | None) -> DataFrame:
    """(id, digest, pos, width, hash, slots, n_tokens) of the windows of (id, text) rows.

    A window has a row for each of its ``templates`` that differ. ``slots`` are the lower-cased values
    behind its placeholders, so equal hashes have equally many. With ``wanted`` (sorted
    hashes) only windows with one of these hashes are returned.
    """

    def run(batches):
        words = Vocabulary()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            i = 0
            while i < len(texts):
                split, n = [], 0
                while i + len(split) < len(texts) and (not split or n < 400_000):
                    split.append((texts[i + len(split)] or "").split())
                    n += len(split[-1])
                yield _of_texts(batch.column(0)[i : i + len(split)], texts[i : i + len(split)], split, words, widths, share, wanted)
                i += len(split)
                if len(words) > 400_000:
                    words = Vocabulary()

    return rows.mapInArrow(
        run, "id long, digest long, pos int, width int, hash long, slots array<string>, n_tokens int"
    )


def _of_texts(ids, texts, split, words, widths, share, wanted) -> pa.RecordBatch:
    flat = [w for s in split for w in s]
    rows = np.fromiter(map(words.__getitem__, flat), np.int64, len(flat))
    lengths = np.array([len(s) for s in split], np.int64)
    starts = np.cumsum(lengths) - lengths
    first = np.zeros(len(flat), bool)
    first[starts[lengths > 0]] = True
    out: list[tuple] = []
    levels = templates(rows, first, words)
    news = [None, *(a[1] & ~b[1] for a, b in zip(levels, levels[1:]))]
    for width, ((hashes, slots), new) in product(widths, zip(levels, news)):
        at, own = _windows(hashes, slots, lengths, width, max(1, int(np.ceil(share * width))), new)
        if wanted is not None and len(at):
            place = np.searchsorted(wanted, own)
            place[place == len(wanted)] = 0
            hit = wanted[place] == own
            at, own = at[hit], own[hit]
        of = np.searchsorted(starts, at, "right") - 1
        for a, h, t in zip(at.tolist(), own.view(np.int64).tolist(), of.tolist()):
            values = [core_of(flat[k]).lower() for k in range(a, a + width) if slots[k]]
            out.append((t, a - int(starts[t]), width, h, values))
    digests = {t: zlib.crc32(texts[t].encode()) for t in {o[0] for o in out}}
    columns = list(zip(*out)) or [()] * 5
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(columns[0], pa.int64())), pa.array([digests[t] for t in columns[0]], pa.int64()),
            pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64()),
            pa.array(columns[4], pa.list_(pa.string())), pa.array([int(lengths[t]) for t in columns[0]], pa.int32()),
        ],
        ["id", "digest", "pos", "width", "hash", "slots", "n_tokens"],
    )


def benchmark_windows(benchmark: DataFrame, width: int, least: int, share: float, ident: str, text: str) -> DataFrame:
    """Windows of every item: of ``width`` tokens, or of the whole item where it is shorter."""
    items = benchmark.select(F.col(ident).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    found = template_windows(items, list(range(least, width + 1)), share, None)
    return found.filter((F.col("width") == F.least(F.lit(width), F.col("n_tokens"))))


def conflicts(windows: list[dict]) -> set[tuple[str, str]]:
    """Pairs of an item's value and another one in the text that break the one-to-one rule.

    Of the pairs that share a value the one in most windows is taken to hold; an equal value always
    holds. Two equal numbers of an item may become two numbers: they need not mean the same.
    """
    weight = Counter((p["item_slots"], p["slots"]) for w in windows for p in w["pairs"])
    rank = {p: float("inf") if p[0] == p[1] else n for p, n in weight.items()}
    bad = set()
    for side in (0, 1):
        ranks = defaultdict(list)
        for p, n in rank.items():
            ranks[p[side]].append(n)
        tops = {v: sorted(own)[-2:] for v, own in ranks.items()}
        for p, n in rank.items():
            top = tops[p[side]]
            if len(top) > 1 and (n < top[1] or top[0] == top[1]) and not (side == 0 and NUMBER.match(p[0])):
                bad.add(p)
    return bad


def covered_tokens(windows: list[dict]) -> tuple[list[int], int, int]:
    """(covered tokens of the item, longest run of them, changed values) of the windows of one alignment.

    A run counts only if one of its windows is the item's own, not wording that many items share.
    """
    changed = {(p["item_slots"], p["slots"]) for w in windows for p in w["pairs"] if p["item_slots"] != p["slots"]}
    bad = conflicts(windows) if changed else set()
    windows = [w for w in windows if not any((p["item_slots"], p["slots"]) in bad for p in w["pairs"])]
    places = sorted({k for w in windows for k in range(w["item_pos"], w["item_pos"] + w["width"])})
    own = {w["item_pos"] for w in windows if w["own"]}
    longest = run = 0
    telling = False
    for before, place in zip([-2, *places], places):
        follows = place == before + 1
        run = run + 1 if follows else 1
        telling = (telling and follows) or place in own
        if telling:
            longest = max(longest, run)
    return places, longest, len(changed)


def matches(
    docs: DataFrame, benchmark: DataFrame, width: int = 8, least: int = 5, literals: float = 0.5, share: float = 0.5,
    run: int = 13, few: int = 3, ident: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """(doc_id, digest, item_id, covered, n_tokens, changed_slots): items found in each text.

    ``digest`` is the crc32 of the text, to tell rows with one id apart.

    An item of ``n_tokens`` is found if windows aligned with it cover ``share`` of its tokens, or
    ``run`` tokens in a row in one alignment, however long the item is. A run must hold a window that at most ``few``
    different items have: an instruction that begins many items is no excerpt of any of them. A window does not count if one
    of its placeholder values breaks the one-to-one rule of its alignment (see ``conflicts``); one with
    equal values always counts. ``changed_slots`` counts values that differ in the alignment that
    covers most: 0 for a verbatim copy. In windows with changed values, names must begin with a
    capital in both texts or be equal. Items of fewer than ``least`` tokens are not searched; null and empty
    texts and items hold nothing; rows with equal id and text count once; a null id is an id.
    Items with null ids are ignored. Extra columns are not read. Benchmark windows are broadcast
    when counted to be few; beyond that every document window takes part in a shuffled hash join.
    """
    items = stored(benchmark_windows(benchmark, width, least, literals, item, item_text).filter("id is not null"))
    # copies of an item under other ids are one item here
    held = items.groupBy("hash", "width").agg((F.countDistinct("digest") <= few).alias("own"))
    items = stored(items.join(held, ["hash", "width"])).select(
        F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), "width", "hash",
        F.col("slots").alias("item_slots"), F.col("n_tokens").alias("item_tokens"), "own",
    )
    size = items.count()
    small = size <= max_broadcast_rows
    wanted = widths = None
    if small:
        rows = items.select("hash", "width").distinct().collect()  # at most ``max_broadcast_rows``
        wanted = np.unique(np.array([r["hash"] for r in rows], np.int64).view(np.uint64))
        widths = sorted({r["width"] for r in rows})
    texts = docs.select(F.col(ident).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    if small and not len(wanted):
        texts = texts.filter(F.lit(False))
    found = template_windows(texts, widths or list(range(least, width + 1)), literals, wanted)
    matched = found.drop("n_tokens").join(F.broadcast(items) if small else items, ["hash", "width"])
    # one alignment: at most as many windows as the item has
    by_shift = matched.groupBy("id", "digest", "item_id", "item_tokens", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.collect_set(F.struct("item_pos", "width", "own", F.arrays_zip("item_slots", "slots").alias("pairs"))).alias("windows")
    )

    def cover(batches):
        for batch in batches:
            columns = list(zip(*map(covered_tokens, batch.column(4).to_pylist()))) or [()] * 3
            kinds = (pa.list_(pa.int32()), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["id", "digest", "item_id", "item_tokens", "places", "longest", "changed"],
            )

    aligned = by_shift.select("id", "digest", "item_id", "item_tokens", "windows").mapInArrow(
        cover, "id long, digest long, item_id long, item_tokens int, places array<int>, longest int, changed int"
    )
    # an insertion shifts the rest of an item: alignments of one pair add up
    per_text = aligned.select("*", F.explode("places").alias("place")).groupBy("id", "digest", "item_id", "item_tokens").agg(
        F.countDistinct("place").alias("covered"), F.max("longest").alias("longest"),
        F.max_by("changed", F.struct(F.size("places"), -F.col("changed"))).alias("changed_slots"),
    )
    enough = (F.col("covered") >= F.lit(share) * F.col("item_tokens")) | (F.col("longest") >= run)
    return per_text.filter(enough).select(
        F.col("id").alias("doc_id"), "digest", "item_id", F.col("item_tokens").cast("long").alias("n_tokens"), "covered",
        F.col("changed_slots").cast("long").alias("changed_slots"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no item is found (see ``matches`` for options)."""
    found = matches(docs, benchmark, ident=ident, text=text, **options).select(
        F.col("doc_id").alias("id_"), F.col("digest").alias("digest_")
    ).distinct()
    same = F.col(ident).eqNullSafe(F.col("id_")) & (F.crc32(F.col(text).cast("binary")) == F.col("digest_"))
    return docs.join(found, same, "left_anti")


def op7_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document id and item."""
    return (
        matches(docs, benchmark).groupBy("doc_id", "item_id", "n_tokens")
        .agg(F.max("covered").alias("covered"), F.min("changed_slots").alias("changed_slots"))
    )
