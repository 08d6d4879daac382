"""LM scoring with context-tree weighting over bytes.

A text is its words in lower case (A-Z only), each followed by a space, and an end mark; its bytes
are coded as eight binary decisions each. A decision is a node of the tree of decisions (the
bits of the byte so far) in a context of 0 to ``depth`` preceding bytes. Every node estimates its
bit by Krichevsky-Trofimov from the training texts' counts; a node's weighted probability is
half its own estimate of all its training bits and half the product of its children's (the contexts
one byte longer). Weights are the posteriors of that, so the prediction of a bit mixes the
estimates of all depths along its context. The model stays as trained while it scores.

A decision's probability depends on the last ``depth`` bytes and the byte alone, a *gram*. So
the corpus is reduced to its different grams before anything else is done:

* Tasks count the grams and words of the texts where they lie; counts go to buckets, by hash of all
  but the gram's two last-sorted bytes.
* Buckets add up; the totals go to *parts* by the ``depth - 2`` bytes nearest to the symbol.
  A part holds whole subtrees of the context tree. One subtree has at most 256**3 grams, so no
  part is unbounded, whatever the corpus.
* The upper levels are tables of nodes, aggregated from level to level and weighed back down.
* Parts mix their levels with the weights from above, and every gram's code length goes back to its
  bucket. Blocks of texts (by hash) ask the buckets for their different grams and words, once each, and
  get four or eight bytes for each in the order in which they asked.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from briefloom.llm import exchange
from briefloom.llm.helpers import fold_of, stored
from briefloom.llm.kernels import Words, mix, slices

END = 10  # stands for itself nowhere in a text: words hold no byte from 9 to 13
GRAM, WORD_KIND = 0, 1
SLICE = 1 << 20  # bytes of text whose grams are held at once
FLUSH = 1_600_000  # different grams a task holds before it hands its counts on
BLOCK = 8e6  # bytes of text a block holds; more where the input is large
PART = 200_000  # grams a part holds on average

COUNTED = "kind int, bucket long, keys binary, counts binary"
ASKED = "kind int, block long, bucket long, keys binary"
TOTAL = "kind int, bucket long, n long, known long, total long, keys binary, counts binary"
PARTED = "part long, bucket long, n long, keys binary, counts binary"
NODES = "part long, context long, node int, zeros long, ones long, log_weighted double"
VALUES = "kind int, bucket long, keys binary, answers binary"


def planes(values: np.ndarray) -> bytes:
    """Bytes of an array, all first bytes first: the shuffle's compression does the rest."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()


def unplaned(packed: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(width, -1).T).view(kind).ravel()


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x >= 0.5, by Stirling's series."""
    y, shift = np.array(x, np.float64), np.zeros(len(x))
    while (low := y < 8).any():
        shift[low] -= np.log(y[low])
        y[low] += 1
    tail = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return shift + (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + tail


_HALVES = log_gamma(np.arange(1, 8193) / 2)  # log gamma(k / 2) at k - 1


def _log_gamma_half(doubled: np.ndarray) -> np.ndarray:
    """log gamma(k / 2) of integers k >= 1; nearly all are small and read off a table."""
    out = _HALVES[np.minimum(doubled, len(_HALVES)) - 1]
    large = doubled > len(_HALVES)
    if large.any():
        out[large] = log_gamma(doubled[large] / 2)
    return out


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov probability of any sequence with these integer counts, as natural logarithm."""
    total = _log_gamma_half(2 * (zeros + ones) + 2)
    return _log_gamma_half(2 * zeros + 1) + _log_gamma_half(2 * ones + 1) - total - math.log(math.pi)


def log_half_sum(own: np.ndarray, children: np.ndarray) -> np.ndarray:
    return np.logaddexp(own, children) - math.log(2)


def stream(text: bytes) -> bytes:
    """The bytes that are coded: lower-cased words, each closed by a space, and the end mark."""
    words = text.lower().split()  # bytes: A-Z only, and white space is exactly 9-13 and 32
    return b" ".join(words) + b" \n" if words else b"\n"


def grams_of(streams: list[bytes], depth: int, leads: list[bytes] | None = None) -> np.ndarray:
    """One gram for each byte of the streams: its ``depth`` preceding bytes, the nearest
    highest, then the byte. What precedes a stream is its lead, or end marks."""
    if leads is None:
        leads = [bytes([END]) * depth] * len(streams)
    joined = b"".join([*(x for pair in zip(leads, streams) for x in pair), bytes(8)])
    raw = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(s) for s in streams])
    begins = np.cumsum(np.append(0, sizes + depth))[:-1]
    real = np.ones(len(raw) - 8, bool)
    for back in range(depth):
        real[begins + back] = False
    real = real[depth:]
    # eight bytes from every place on, the first of them lowest: the context is the lowest ``depth`` bytes
    gram = np.ndarray(len(real), "<u8", joined, 0, (1,))[real]
    gram <<= np.uint64(64 - 8 * depth)
    gram >>= np.uint64(56 - 8 * depth)
    gram |= raw[depth : depth + len(real)][real]
    return gram


def gram_slices(streams: list[bytes], depth: int):
    """(grams, stream of each part, sizes of the parts) of about SLICE bytes; a long stream is cut into parts."""
    leads, parts, rows, held = [], [], [], 0
    for row, whole in enumerate(streams):
        for begin in range(0, len(whole), SLICE):
            leads.append((bytes([END]) * depth + whole[max(0, begin - depth) : begin])[-depth:])
            parts.append(whole[begin : begin + SLICE])
            rows.append(row)
            held += len(parts[-1])
            if held >= SLICE:
                yield grams_of(parts, depth, leads), np.array(rows), np.array([len(x) for x in parts])
                leads, parts, rows, held = [], [], [], 0
    if parts:
        yield grams_of(parts, depth, leads), np.array(rows), np.array([len(x) for x in parts])


def _pieces(texts: pa.Array):
    """Slices of a block's texts: (first row, streams)."""
    for i, j in slices(texts, SLICE):
        yield i, [stream(t or b"") for t in texts.slice(i, j - i).cast(pa.large_binary()).to_pylist()]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys of all parts and the sums of their counts; ``parts`` is emptied on the way."""
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    few = 1 < len(parts) <= 10  # sorted runs, which a stable sort merges; it is slower where there are many
    parts.clear()
    order = np.argsort(keys, kind="stable" if few else None)
    keys = keys[order]
    counts = counts[order]
    del order
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _counted(keys: np.ndarray, weight: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys, and ``weight`` times the number of each."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(first, append=len(keys)) * weight


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted different keys, by sorting."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def bucket_of(kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    return exchange.bucket_of(mix(keys >> np.uint64(16)) if kind == GRAM else keys, buckets)


def in_buckets(kind: int, keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, buckets present, first, last): ``order`` sorts sorted keys by bucket, then key."""
    return by_place(bucket_of(kind, keys, buckets), buckets)


def by_place(which: np.ndarray, places: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, places present, first, last): ``order`` sorts by place and keeps the order within one."""
    sizes = np.bincount(which, minlength=places)
    present, last = np.flatnonzero(sizes), np.cumsum(sizes)
    # numbers of one or two bytes are sorted by their digits
    order = np.argsort(which.astype(np.min_scalar_type(places)), kind="stable")
    return order, present, (last - sizes)[present], last[present]


class Level:
    """Decision nodes of one depth. ``grams`` are sorted and different: the context's bytes, then the
    symbol. A node of bit b is a run of grams equal but for their last 8 - b bits. Nodes of different
    bits have nothing to do with each other, so one bit is held at a time."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams = grams
        self.counts = counts

    def nodes(self, bit: int) -> None:
        """First gram of every node of a bit, and the node of every gram."""
        prefix = self.grams >> np.uint64(8 - bit)
        new = np.append(True, prefix[1:] != prefix[:-1])
        self.first = np.flatnonzero(new)
        self.rows = (np.cumsum(new) - 1).astype(np.int32)

    def count(self, bit: int) -> None:
        """Counts of zeros and ones, and the log of the own estimate, of every node of a bit."""
        one = ((self.grams >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64)
        self.ones = np.add.reduceat(self.counts * one, self.first)
        self.zeros = np.add.reduceat(self.counts, self.first) - self.ones
        self.own = log_estimate(self.zeros, self.ones)

    def parent(self) -> tuple[Level, np.ndarray]:
        """The level whose contexts lack the oldest byte, and the place of each own gram there."""
        shorter = self.grams >> np.uint64(16) << np.uint64(8) | self.grams & np.uint64(255)
        grams, place = np.unique(shorter, return_inverse=True)
        counts = np.zeros(len(grams), np.int64)
        np.add.at(counts, place, self.counts)
        return Level(grams, counts), place

    def keys(self, bit: int) -> np.ndarray:
        """(context << 8 | node) of the nodes of a bit."""
        grams = self.grams[self.first]
        return grams >> np.uint64(8) << np.uint64(8) | np.uint64(1 << bit) | (grams & np.uint64(255)) >> np.uint64(8 - bit)


def levels_of(grams: np.ndarray, counts: np.ndarray, depth: int, top: int) -> tuple[list[Level], list[np.ndarray]]:
    """Levels ``depth`` down to ``top - 1`` over a part's sorted grams, and the place of each level's grams in the next."""
    levels, places = [Level(grams, counts)], []
    for _ in range(depth, top - 1, -1):
        level, place = levels[-1].parent()
        levels.append(level)
        places.append(place)
    return levels, places


def weigh(levels: list[Level], places: list[np.ndarray], bit: int) -> np.ndarray:
    """Gives all but the last level the weights of their own estimates; sums of the last level's children."""
    below = None
    levels[0].nodes(bit)
    for level, parent, place in zip(levels, levels[1:], places):
        level.count(bit)
        weighted = level.own if below is None else log_half_sum(level.own, below)
        level.weight = np.ones(len(weighted)) if below is None else np.exp(level.own - weighted - math.log(2))
        parent.nodes(bit)
        below = np.bincount(parent.rows[place[level.first]], weighted, len(parent.first))
    return below


def _gathered(group: pa.Table) -> tuple[np.ndarray, np.ndarray, list[int]]:
    keys = [exchange.unpack(x) for x in group["keys"].to_pylist()]
    counts = [unplaned(x, np.int64) for x in group["counts"].to_pylist()]
    return np.concatenate(keys), np.concatenate(counts), [len(k) for k in keys]


def upper_nodes(group: pa.Table, depth: int, top: int) -> pa.Table:
    """A part's share of the nodes of depth ``top - 1``: counts and summed children."""
    grams, counts, _ = _gathered(group)
    order = np.argsort(grams)
    levels, places = levels_of(grams[order], counts[order], depth, top)
    level, found = levels[-1], []
    for bit in range(8):
        children = weigh(levels, places, bit)
        level.count(bit)
        found.append((level.keys(bit), level.zeros, level.ones, children))
    keys, zeros, ones, children = (np.concatenate(x) for x in zip(*found))
    return pa.table(
        {
            "part": pa.array(np.full(len(keys), group["part"][0].as_py()), pa.int64()),
            "context": pa.array((keys >> np.uint64(8)).astype(np.int64)),
            "node": pa.array((keys & np.uint64(255)).astype(np.int32)),
            "zeros": pa.array(zeros), "ones": pa.array(ones), "log_weighted": pa.array(children),
        }
    )


def code_lengths(group: pa.Table, above: pa.Table, depth: int, top: int) -> pa.Table:
    """Bits of every gram of a part, in the order of its rows; ``above`` has, for each node of depth
    ``top - 1``, what the upper levels say for a 1 and the weight they leave to the part."""
    grams, counts, sizes = _gathered(group)
    order = np.argsort(grams)
    levels, places = levels_of(grams[order], counts[order], depth, top)
    keys = above["context"].to_numpy().astype(np.uint64) << np.uint64(8) | above["node"].to_numpy().astype(np.uint64)
    by_key = np.argsort(keys)
    keys, said, left = keys[by_key], above["said"].to_numpy()[by_key], above["left"].to_numpy()[by_key]
    total = np.zeros(len(grams))
    for bit in range(8):
        weigh(levels, places, bit)
        chance, here = None, np.arange(len(grams))
        for level, place in zip(levels, places):
            rows = level.rows[here]
            estimate = ((level.ones + 0.5) / (level.zeros + level.ones + 1))[rows]
            share = level.weight[rows]
            chance = estimate if chance is None else share * estimate + (1 - share) * chance
            here = place[here]
        rows = np.searchsorted(keys, levels[-1].keys(bit))[levels[-1].rows[here]]
        chance = said[rows] + left[rows] * chance
        one = (grams[order] >> np.uint64(7 - bit)) & np.uint64(1)
        total -= np.log2(np.where(one == 1, chance, 1 - chance))
    bits = np.empty(len(grams), np.float32)
    bits[order] = total
    return pa.table(
        {
            "kind": pa.array(np.full(len(sizes), GRAM, np.int32)),
            "bucket": group["bucket"],
            "keys": group["keys"],
            "answers": pa.array([planes(x) for x in np.split(bits, np.cumsum(sizes)[:-1])], pa.binary()),
        }
    )


def _upper_levels(shares: DataFrame, top: int) -> DataFrame:
    """(context, node, said, left) of depth ``top - 1``, from the parts' shares of that depth.

    ``said``: the probability of a 1 that depths 0 to top - 1 contribute; ``left``: the weight that
    stays for longer contexts. Every level is one aggregation of the level below and one join back,
    where a node has at most 256 children.
    """

    def weighted_rows(batches):
        for batch in batches:
            zeros, ones, children = (batch.column(c).to_numpy() for c in ("zeros", "ones", "children"))
            own = log_estimate(zeros, ones)
            weighted = log_half_sum(own, children)
            yield pa.RecordBatch.from_arrays(
                [batch.column("context"), batch.column("node"), pa.array(zeros), pa.array(ones), pa.array(weighted),
                 pa.array(np.exp(own - weighted - math.log(2)))],
                ["context", "node", "zeros", "ones", "log_weighted", "weight"],
            )

    levels = {}
    for d in range(top - 1, -1, -1):
        source = shares if d == top - 1 else levels[d + 1].withColumn("context", F.shiftrightunsigned("context", 8))
        sums = source.groupBy("context", "node").agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_weighted").alias("children")
        )
        levels[d] = stored(sums.mapInArrow(
            weighted_rows, "context long, node int, zeros long, ones long, log_weighted double, weight double"
        ))
    estimate = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
    above = None
    for d in range(top):
        level = levels[d].withColumn("estimate", estimate)
        if above is None:
            above = level.select("context", "node", (F.col("weight") * F.col("estimate")).alias("said"), (1 - F.col("weight")).alias("left"))
            continue
        parents = above.select(F.col("context").alias("parent"), "node", F.col("said").alias("_said"), F.col("left").alias("_left"))
        above = level.withColumn("parent", F.shiftrightunsigned("context", 8)).join(parents, ["parent", "node"]).select(
            "context", "node", (F.col("_said") + F.col("_left") * F.col("weight") * F.col("estimate")).alias("said"),
            (F.col("_left") * (1 - F.col("weight"))).alias("left"),
        )
    return above


def _tallies(rows: DataFrame, depth: int, buckets: int) -> DataFrame:
    """Counts in training texts of all grams and words, in rows by kind and bucket."""
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())

    def packed(parts: dict[int, list]) -> pa.RecordBatch:
        out = []
        for kind, own in parts.items():
            keys, counts = _merged(own) if own else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            order, present, first, last = in_buckets(kind, keys, buckets)
            keys, counts = keys[order], counts[order]
            del order
            out += [
                (kind, bucket, exchange.pack(keys[a:b]), planes(counts[a:b]))
                for bucket, a, b in zip(present.tolist(), first.tolist(), last.tolist())
            ]
        columns = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["kind", "bucket", "keys", "counts"])

    def run(batches):
        parts, held = {GRAM: [], WORD_KIND: []}, 0
        for batch in batches:
            texts = batch.column(0).cast(pa.large_string())
            weights = batch.column(2).to_numpy() * ~batch.column(1).to_numpy(zero_copy_only=False)
            for i, streams in _pieces(texts):
                learn = weights[i : i + len(streams)]
                own = Words(texts.slice(i, len(streams)), fold_case=True)
                of_words = np.repeat(learn, own.counts)
                for weight in np.unique(learn).tolist():  # there are few different ones
                    parts[WORD_KIND].append(_counted(own.hashes[of_words == weight], weight))
                    alike = [s for s, w in zip(streams, learn.tolist()) if w == weight]
                    for grams, _, _ in gram_slices(alike, depth):
                        parts[GRAM].append(_counted(grams, weight))
                        held += len(parts[GRAM][-1][0])
                del own, of_words
                if held > FLUSH:
                    parts = {k: [_merged(v)] for k, v in parts.items()}
                    held = len(parts[GRAM][0][0])
                    if held > FLUSH // 2:
                        yield packed(parts)
                        parts, held = {GRAM: [], WORD_KIND: []}, 0
        yield packed(parts)

    return rows.select("text", "held_out", "copies").mapInArrow(run, COUNTED)


class Block:
    """A block's texts as streams and word hashes, slice by slice, and their sorted different grams and hashes."""

    def __init__(self, texts: pa.Array, depth: int):
        self.depth, self.slices, grams, words = depth, [], [], []
        for i, streams in _pieces(texts):
            for own, _, _ in gram_slices(streams, depth):
                grams.append(distinct(own))
                if len(grams) > 1 and sum(map(len, grams[1:])) > FLUSH // 2:
                    grams = [distinct(np.concatenate(grams))]
            own = Words(texts.slice(i, len(streams)), fold_case=True)
            words.append(distinct(own.hashes))
            self.slices.append((streams, own.hashes, own.counts))
        self.keys = distinct(np.concatenate(grams)), distinct(np.concatenate(words))

    def coded(self, bits: np.ndarray, counts: np.ndarray):
        """For each slice (bits of every text, its bytes, its words, the count of every word), given what ``keys`` have."""
        for streams, hashes, n_words in self.slices:
            sizes, total = np.array([len(s) for s in streams]), np.zeros(len(streams))
            for grams, rows, part_sizes in gram_slices(streams, self.depth):
                begins = np.cumsum(np.append(0, part_sizes))[:-1]
                np.add.at(total, rows, np.add.reduceat(looked_up(grams, self.keys[GRAM], bits), begins, dtype=np.float64))
            yield total, sizes, n_words, looked_up(hashes, self.keys[WORD_KIND], counts)


def looked_up(keys: np.ndarray, known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The value of every key; ``known`` are sorted and hold all of them. Each different key is searched once."""
    if not len(keys):
        return values[:0]
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    out = np.empty(len(keys), values.dtype)
    out[order] = np.repeat(values[np.searchsorted(known, keys[first])], np.diff(first, append=len(keys)))
    return out


def _texts(group: pa.Table) -> pa.Array:
    column = group["text"].cast(pa.large_string())
    return pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)


def _asked(group: pa.Table, depth: int, buckets: int) -> pa.Table:
    out = []
    for kind, keys in zip((GRAM, WORD_KIND), Block(_texts(group), depth).keys):
        order, present, first, last = in_buckets(kind, keys, buckets)
        keys = keys[order]
        out += [
            (kind, group["block"][0].as_py(), bucket, exchange.pack(keys[a:b]))
            for bucket, a, b in zip(present.tolist(), first.tolist(), last.tolist())
        ]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("kind", "block", "bucket", "keys"), zip(*out), kinds)})


def _add_up(group: pa.Table) -> pa.Table:
    keys, counts = _merged([_gathered(group)[:2]])
    return pa.table(
        {
            "kind": group["kind"].slice(0, 1), "bucket": group["bucket"].slice(0, 1), "n": pa.array([len(keys)], pa.int64()),
            "known": pa.array([int((counts > 0).sum())], pa.int64()), "total": pa.array([int(counts.sum())], pa.int64()),
            "keys": pa.array([exchange.pack(keys)], pa.binary()), "counts": pa.array([planes(counts)], pa.binary()),
        }
    )


def _reply(asked: pa.Table, values: pa.Table) -> pa.Table:
    """What a bucket's blocks asked for, in the order in which they asked."""
    kind = asked["kind"][0].as_py()
    of = np.float32 if kind == GRAM else np.int64
    keys = np.concatenate([exchange.unpack(x) for x in values["keys"].to_pylist()])
    order = np.argsort(keys)
    keys = keys[order]
    found = np.concatenate([unplaned(x, of) for x in values["answers"].to_pylist()])[order]
    answers = [planes(found[np.searchsorted(keys, exchange.unpack(x))]) for x in asked["keys"].to_pylist()]
    return pa.table({"kind": asked["kind"], "block": asked["block"], "bucket": asked["bucket"], "answer": pa.array(answers, pa.binary())})


def _answers(group: pa.Table, kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """The answers for a block's sorted different keys."""
    of = np.float32 if kind == GRAM else np.int64
    order, present, first, last = in_buckets(kind, keys, buckets)
    got = {b: x for k, b, x in zip(*(group[c].to_pylist() for c in ("kind", "bucket", "answer"))) if k == kind}
    out = np.zeros(len(keys), of)
    for bucket, a, b in zip(present.tolist(), first, last):
        out[order[a:b]] = unplaned(got[bucket], of)
    return out


def with_copies(rows: DataFrame, most: int = 1000) -> tuple[DataFrame, bool]:
    """Rows with a column ``copies``, and whether any row now stands for several.

    Rows that are equal in id and text hash alike, so a great number of them would fill one block.
    Those that occur more than ``most`` times are found by counting ids and digests, and one of each
    stays with its number of copies. All other rows have ``copies`` 1.
    """
    marked = rows.withColumn("digest", F.md5(F.coalesce(F.col("text"), F.lit("\0null")).cast("binary")))
    many = stored(marked.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > most))
    if many.limit(1).count() == 0:
        return rows.withColumn("copies", F.lit(1).cast("long")), False
    same = F.col("r.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("r.digest") == F.col("m.digest"))
    few = marked.alias("r").join(many.alias("m"), same, "left_anti").withColumn("copies", F.lit(1).cast("long"))
    others = [F.first(c).alias(c) for c in rows.columns if c != "doc_id"]
    one = marked.alias("r").join(many.alias("m"), same, "left_semi").groupBy("doc_id", "digest").agg(
        *others, F.count(F.lit(1)).alias("copies")
    )
    columns = [*rows.columns, "copies"]
    return few.select(*columns).unionByName(one.select(*columns)), True


def context_tree_scores(
    docs: DataFrame, depth: int = 6, folds: int = 10, held_out: int = 0, ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, n_bytes, bits_per_byte).

    ``score`` is the model's log10 probability of the text as described above, ``bits_per_byte`` its
    code length by coded byte, ``base_score`` that of a smoothed word model. Both learn from the rows
    outside the fold only. Null, empty and blank texts are an end mark alone. Null ids count as an empty id for
    the fold; repeated rows count, and score, once each; other columns are not read. Without
    training texts every bit has probability 1/2. An empty table gives no rows.
    """
    if not 3 <= depth <= 7:
        raise ValueError("depth is 3 to 7 bytes, so that a gram fits 64 bits")
    rows = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    top = depth - 2
    size = exchange.total_bytes(rows, "text")
    blocks, buckets = math.ceil(max(size, 1) / max(BLOCK, min(64e6, 8e6 * math.sqrt(size / 1e9)))), exchange.sizes(size)[1]
    rows, repeated = with_copies(rows.withColumn("held_out", fold_of("doc_id", folds) == held_out))
    blocked = rows.withColumn("block", exchange.block_of(["doc_id", "text"], blocks))

    totals = stored(_tallies(rows, depth, buckets).groupBy("kind", "bucket").applyInArrow(_add_up, TOTAL))
    sums = {r["kind"]: r for r in totals.groupBy("kind").agg(*[F.sum(c).alias(c) for c in ("n", "known", "total")]).collect()}
    parts = max(1, math.ceil(sums[GRAM]["n"] / PART)) if GRAM in sums else 1

    def split(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = exchange.unpack(row["keys"]), unplaned(row["counts"], np.int64)
                order, present, first, last = by_place(exchange.bucket_of(mix((keys >> np.uint64(24)) + np.uint64(1)), parts), parts)
                for part, a, b in zip(present.tolist(), first.tolist(), last.tolist()):
                    own = order[a:b]
                    yield pa.RecordBatch.from_pylist(
                        [{"part": part, "bucket": row["bucket"], "n": len(own), "keys": exchange.pack(keys[own]),
                          "counts": planes(counts[own])}],
                        pa.schema([("part", pa.int64()), ("bucket", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]),
                    )

    parted = stored(totals.filter(F.col("kind") == GRAM).mapInArrow(split, PARTED))
    shares = stored(parted.groupBy("part").applyInArrow(lambda g: upper_nodes(g, depth, top), NODES))
    above = shares.select("part", "context", "node").join(_upper_levels(shares, top), ["context", "node"])
    lengths = parted.groupBy("part").cogroup(above.groupBy("part")).applyInArrow(
        lambda g, a: code_lengths(g, a, depth, top), VALUES
    )
    word_counts = totals.filter(F.col("kind") == WORD_KIND).select("kind", "bucket", "keys", F.col("counts").alias("answers"))
    asked = blocked.groupBy("block").applyInArrow(lambda g: _asked(g, depth, buckets), ASKED)
    replies = asked.groupBy("kind", "bucket").cogroup(
        lengths.unionByName(word_counts).groupBy("kind", "bucket")
    ).applyInArrow(_reply, "kind int, block long, bucket long, answer binary")

    # only (kind, block, bucket) and keys go to a bucket, and only its answers come back
    n_train = rows.filter(~F.col("held_out")).agg(F.sum("copies")).first()[0] or 0
    words_total, words_known = (sums[WORD_KIND]["total"], sums[WORD_KIND]["known"]) if WORD_KIND in sums else (0, 0)
    train_tokens, kinds = words_total + n_train, words_known + (n_train > 0)
    rest = math.log10(train_tokens + 0.1 * (kinds + 1))

    def score(group: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(_texts(group), depth)
        bits = _answers(answers, GRAM, block.keys[GRAM], buckets)
        counts = _answers(answers, WORD_KIND, block.keys[WORD_KIND], buckets)
        columns = {n: [] for n in ("n_tokens", "n_known", "base_score", "score", "n_bytes")}
        for total, sizes, n_words, seen in block.coded(bits, counts):
            of = np.repeat(np.arange(len(sizes)), n_words)
            columns["n_tokens"].append(n_words + 1)
            columns["n_known"].append(np.bincount(of, seen > 0, len(sizes)).astype(np.int64) + (n_train > 0))
            columns["base_score"].append(np.bincount(of, np.log10(seen + 0.1) - rest, len(sizes)) + math.log10(n_train + 0.1) - rest)
            columns["score"].append(-total * math.log10(2))
            columns["n_bytes"].append(sizes)
        found = {n: np.concatenate(v) for n, v in columns.items()}
        return pa.table(
            {
                "doc_id": group["doc_id"], "copies": group["copies"], "held_out": group["held_out"],
                "n_tokens": pa.array(found["n_tokens"], pa.int64()), "n_known": pa.array(found["n_known"], pa.int64()),
                "train_tokens": pa.array(np.full(len(group), train_tokens), pa.int64()),
                "base_score": pa.array(found["base_score"], pa.float64()), "score": pa.array(found["score"], pa.float64()),
                "n_bytes": pa.array(found["n_bytes"], pa.int64()),
                "bits_per_byte": pa.array(-found["score"] / math.log10(2) / found["n_bytes"], pa.float64()),
            }
        )

    scored = blocked.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        score,
        "doc_id long, copies long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, n_bytes long, bits_per_byte double",
    )
    if repeated:
        scored = scored.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("_copy")
    return scored.drop("copies")


def op12_context_tree(docs: DataFrame) -> DataFrame:
    return context_tree_scores(docs)
