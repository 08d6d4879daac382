"""Sub-word encoding with a unigram piece table (Kudo 2018)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from briefloom.functions.text import whitespace_tokens, word_tokens
from briefloom.operators.encode import IDS, answered, asked_words, kept_tokens, regroup, send_table
from briefloom.operators.vocab import UNKNOWN_ID, substrings
from briefloom.scaling import MAX_BROADCAST_ROWS, left_lookup, materialise

# Fixed value: an unknown character scores this much below the worst piece.
UNKNOWN_PENALTY = 10.0
# Words whose pieces a worker remembers between batches.
REMEMBERED = 500_000


class Trie:
    """Pieces by their letters: an array of nodes, walked once from each place of a word."""

    def __init__(self, pieces: Iterable[tuple[str, float, int]] = ()):
        self.next: list[dict[str, int]] = [{}]
        self.score: list[float | None] = [None]
        self.code: list[int] = [-1]
        self.worst = 0.0
        for piece, score, code in pieces:
            self.add(piece, score, code)

    def add(self, piece: str, score: float, code: int) -> None:
        node = 0
        for letter in piece:
            after = self.next[node].get(letter)
            if after is None:
                after = self.next[node][letter] = len(self.next)
                self.next.append({})
                self.score.append(None)
                self.code.append(-1)
            node = after
        self.score[node], self.code[node] = score, code
        self.worst = min(self.worst, score)

    def edges(self, word: str, start: int) -> Iterator[tuple[int, float, int]]:
        """(end, score, code) of the pieces that begin at a place, the shortest first."""
        node, after, scores = 0, self.next, self.score
        for end in range(start, len(word)):
            node = after[node].get(word[end])
            if node is None:
                return
            if scores[node] is not None:
                yield end + 1, scores[node], self.code[node]

    def best(self, word: str, unknown: float) -> list[tuple[int, int, int]]:
        """(start, end, code) of the segmentation with the largest score sum; the earliest start wins
        ties. A letter that is no piece scores ``unknown`` and has code -1."""
        best = [0.0] + [float("-inf")] * len(word)
        back = [(0, -1)] * (len(word) + 1)
        for start in range(len(word)):
            here, known = best[start], False
            for end, score, code in self.edges(word, start):
                known = known or end == start + 1
                if here + score > best[end]:
                    best[end] = here + score
                    back[end] = (start, code)
            if not known and here + unknown > best[start + 1]:
                best[start + 1] = here + unknown
                back[start + 1] = (start, -1)
        parts, end = [], len(word)
        while end:
            start, code = back[end]
            parts.append((start, end, code))
            end = start
        return parts[::-1]


def best_segmentation(word: str, scores: dict, longest: int, unknown: float) -> list[str | None]:
    """Pieces with the largest score sum (the earliest start wins ties); None = unknown char."""
    trie = Trie((p, s, i) for i, (p, s) in enumerate(scores.items()) if len(p) <= longest)
    return [None if code < 0 else word[a:b] for a, b, code in trie.best(word, unknown)]


def _strung(tokens: pa.Array, words: pa.Array, coded: list[list[int]]) -> pa.Array:
    """The codes of each list of tokens, one word after the other; ``words`` numbers the tokens' words, ``coded`` has their codes."""
    per_word = pa.array(coded, pa.list_(pa.int32())).take(words)
    ends = pc.fill_null(pc.list_value_length(per_word), 0).to_numpy(zero_copy_only=False).cumsum()
    stops = pc.cumulative_sum(pc.list_value_length(tokens)).to_numpy(zero_copy_only=False)
    totals = [int(ends[stop - 1]) if stop else 0 for stop in stops]
    lengths = [b - a for a, b in zip([0] + totals, totals)]
    return regroup(per_word.flatten(), pa.array(lengths, pa.int32()))


def _code_lists(tokens: pa.Array, codes: dict) -> pa.Array:
    words = pc.cast(tokens.flatten(), pa.string()).dictionary_encode()
    return _strung(tokens, words.indices, [codes[word] for word in words.dictionary.to_pylist()])


def piece_encoder(
    pieces: DataFrame,
    unknown: int = UNKNOWN_ID,
    word_mark: str = "",
    cased: bool = False,
    unicode: bool = False,
):
    """``encode(text column, max_length)`` over a (piece, logp, id) table.

    A worker segments each different word once, as long as it remembers it. ``word_mark`` is put before every
    word (tables trained by SentencePiece use U+2581); ``cased`` keeps case and
    punctuation and splits at white space only.
    """
    sent = send_table(pieces.select("piece", "logp", "id"))
    if sent is None:
        raise ValueError("the piece table is too large to send: use encode_by_piece_join")

    @F.arrow_udf(IDS)
    def segment(tokens: pa.Array) -> pa.Array:
        built = sent.value.built
        if "trie" not in built:
            rows = sent.value.table
            built["trie"] = Trie(zip(*(rows.column(c).to_pylist() for c in ("piece", "logp", "id"))))
        trie, known = built["trie"], built.setdefault(("segmented", word_mark), {})
        words = pc.cast(tokens.flatten(), pa.string()).dictionary_encode()
        if len(known) > REMEMBERED:
            known.clear()
        coded = []
        for word in words.dictionary.to_pylist():
            codes = known.get(word)
            if codes is None:
                best = trie.best(word_mark + word, trie.worst - UNKNOWN_PENALTY)
                codes = known[word] = [unknown if code < 0 else code for _, _, code in best]
            coded.append(codes)
        return _strung(tokens, words.indices, coded)

    def encode(text: Column, max_length: int) -> Column:
        words = whitespace_tokens(text) if cased else word_tokens(text, unicode)
        # Every word gives at least one piece, so later words cannot fit.
        fitting = F.slice(words, F.lit(1), F.lit(max_length - 1))
        return F.slice(segment(fitting), F.lit(1), F.lit(max_length - 1))

    return encode


def segmented_words(words: DataFrame, pieces: DataFrame, unknown: int = UNKNOWN_ID, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """(word, codes) for a (word) table of different words, with a piece table of any size.

    Substrings of the words that may be pieces are joined with the table, and each word is segmented with its
    own pieces, in one group of at most its length times the longest piece.
    """
    pieces = materialise(pieces.select("piece", "logp", F.col("id").cast("int").alias("id")))
    longest, worst = pieces.agg(F.max(F.length("piece")), F.min("logp")).first()
    cut = words.select("word", F.explode(F.array_distinct(substrings(F.col("word"), longest or 1))).alias("piece"))
    found = left_lookup(materialise(cut), pieces, "piece", max_rows).filter(F.col("id").isNotNull())
    own = found.groupBy("word").agg(F.collect_list(F.struct("piece", "logp", "id")).alias("own"))
    least = min(worst or 0.0, 0.0) - UNKNOWN_PENALTY

    def run(batches):
        for batch in batches:
            codes = []
            for word, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                trie = Trie((p["piece"], p["logp"], p["id"]) for p in known or ())
                codes.append([unknown if code < 0 else code for _, _, code in trie.best(word, least)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.list_(pa.int32()))], ["word", "codes"])

    return words.join(own, "word", "left").select("word", "own").mapInArrow(run, "word string, codes array<int>")


def encode_by_piece_join(
    rows: DataFrame, pieces: DataFrame, text_col: str, max_length: int, name: str = "ids", unicode: bool = False,
    unknown: int = UNKNOWN_ID, max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """``rows`` (from ``encode.numbered``) with unpadded piece ids ``name``, for piece tables of any size.

    Each different word is segmented once, and each block of rows asks once for the codes of its words. Texts without
    words get an empty array.
    """
    words = kept_tokens(F.col(text_col), max_length, unicode)
    asked = asked_words(rows, words)
    coded = segmented_words(asked.select("word").distinct(), pieces, unknown, max_rows)
    whole = answered(rows, {name: words}, asked, coded, _code_lists, IDS, max_rows=max_rows)
    return whole.withColumn(name, F.slice(name, F.lit(1), F.lit(max_length - 1)))
