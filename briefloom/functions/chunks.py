"""Word alignments with as many matches as possible and, among these, as few chunks as possible.

Which copy of a repeated word is matched with which decides how many chunks there are. For equal words alone the fewest
chunks follow from the most links (see ``links``). With keys a row's words are taken in turn; what is kept of the choices
so far is the places taken opposite, as long as they matter, and the last one.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from briefloom.functions.links import most_links
from briefloom.functions.overlap import alignment

# Choices kept open at a word at first: at most ``STATES``, and fewer in rows where this many over all words would be exceeded.
STATES = 64
OPEN_CHOICES = 60_000
LEAST_STATES = 8
# Where choices were given up and fewer chunks are possible, the search is repeated with so many times as many.
WIDER = 8

# Words compared to put places in order; the order decides only which choices are given up.
LOOK_AHEAD = 32
# Places up to which these are compared one by one.
FEW_PLACES = 32

NOWHERE = -2


class _Row:
    """Two lists of word codes and the keys of the words; a key is a function of the word."""

    def __init__(self, left: np.ndarray, right: np.ndarray, keys_left: np.ndarray, keys_right: np.ndarray):
        self.left, self.right = left, right
        self.key_of = dict(zip(left.tolist(), keys_left.tolist())) | dict(zip(right.tolist(), keys_right.tolist()))
        n_left, n_right = Counter(left.tolist()), Counter(right.tolist())
        # copies that equal words leave over: on one side only, for each word
        self.over_left = {w: n - n_right[w] for w, n in n_left.items() if n > n_right[w]}
        self.over_right = {w: n - n_left[w] for w, n in n_right.items() if n > n_left[w]}
        spare_left, spare_right = Counter(), Counter()
        for over, spare in ((self.over_left, spare_left), (self.over_right, spare_right)):
            for w, n in over.items():
                spare[self.key_of[w]] += n
        self.skips = {k: n - min(n, spare_right[k]) for k, n in spare_left.items()}
        self.lenders, self.leavers = defaultdict(list), defaultdict(list)
        for w in self.over_right:
            self.lenders[self.key_of[w]].append(w)
        for w in self.over_left:
            self.leavers[self.key_of[w]].append(w)
        self.places, self.mask, self.key_mask = defaultdict(list), defaultdict(int), defaultdict(int)
        for j, w in enumerate(right.tolist()):
            self.places[w].append(j)
            self.mask[w] |= 1 << j
        for w, mask in self.mask.items():
            self.key_mask[self.key_of[w]] |= mask
        self.words, self.opposite = left.tolist(), right.tolist()
        self.last = {self.key_of[w]: i for i, w in enumerate(self.words)}
        # for each key the places right before its own
        self.before = defaultdict(set)
        for j, w in enumerate(self.opposite[1:]):
            self.before[self.key_of[w]].add(j)

    def alone(self, word: int) -> bool:
        """Whether ``word`` occurs opposite and its copies can meet nothing but each other."""
        key = self.key_of[word]
        return word in self.mask and not self.lenders.get(key) and self.leavers.get(key, [word]) == [word]

    def ahead(self, i: int, places: list[int]) -> list[int]:
        """Places where word ``i`` could begin a chunk, those with most equal words after them first."""
        if len(places) <= FEW_PLACES:
            return sorted(places, key=lambda j: -self._equal_after(i, j)) if len(places) > 1 else places
        alive, length = np.array(places), np.zeros(len(places), np.int64)
        at, k = np.arange(len(places)), 1
        while len(at) and k <= LOOK_AHEAD and i + k < len(self.left):
            inside = alive[at] + k < len(self.right)
            at = at[inside]
            at = at[self.right[alive[at] + k] == self.left[i + k]]
            length[at] = k
            k += 1
        return alive[np.argsort(-length, kind="stable")].tolist()

    def _equal_after(self, i: int, j: int) -> int:
        most = min(LOOK_AHEAD, len(self.words) - 1 - i, len(self.opposite) - 1 - j)
        k = 0
        while k < most and self.words[i + k + 1] == self.opposite[j + k + 1]:
            k += 1
        return k

    def choices(self, word: int, used: int, seen: Counter) -> tuple[list[int], bool]:
        """(words opposite that a copy of ``word`` may meet, whether it may stay without one).

        Equal words are matched as often as they can be, then equal keys as often as those left over can be.
        """
        key, met = self.key_of[word], [word] if word in self.mask else []
        spent = seen[word] - (used & self.mask.get(word, 0)).bit_count()
        if spent >= self.over_left.get(word, 0):
            return met, False
        lent = {w: (used & self.mask[w]).bit_count() - seen[w] for w in self.lenders[key]}
        left = sum(seen[w] - (used & self.mask.get(w, 0)).bit_count() for w in self.leavers[key])
        met += [w for w, n in lent.items() if n < self.over_right[w]]
        return met, left - sum(lent.values()) < self.skips[key]


def _search(row: _Row, bound: int, states: int) -> tuple[int, bool]:
    """(fewest chunks, or ``bound`` if there are not fewer; whether no choice was given up)."""
    seen: Counter = Counter()
    layer = {(NOWHERE, 0): 0}
    whole = True
    words, opposite, nothing = row.words, row.opposite, frozenset()
    for i, word in enumerate(words):
        key = row.key_of[word]
        if key not in row.key_mask:
            continue  # it meets nothing: no place is gone on from before it, and no choice is made
        going = row.before.get(row.key_of[words[i + 1]], nothing) if i + 1 < len(words) else nothing
        # places taken matter until the last copy of their key has had its turn
        live = ~row.key_mask[key] if row.last[key] == i else -1
        alone, mask, over, own, n_seen = row.alone(word), row.mask.get(word, 0), row.over_left.get(word, 0), [word], seen[word]
        starts: dict[int, list[int]] = {}
        new: dict[tuple[int, int], int] = {}
        for (before, used), chunks in layer.items():
            if alone:
                met, may_stay = own, n_seen - (used & mask).bit_count() < over
            else:
                met, may_stay = row.choices(word, used, seen)
            if may_stay:
                state = (NOWHERE, used & live)
                if chunks < new.get(state, bound):
                    new[state] = chunks
            here = before + 1
            if before >= 0 and opposite[here] in met and not used >> here & 1:
                state = (here if here in going else NOWHERE, (used | 1 << here) & live)
                if chunks < new.get(state, bound):
                    new[state] = chunks
            for other in met if chunks + 1 < bound else ():
                if other not in starts:
                    starts[other] = row.ahead(i, row.places[other])
                free = 0
                for j in starts[other]:
                    if j == here or used >> j & 1:
                        continue
                    free += 1
                    if free > states:
                        whole = False
                        break
                    state = (j if j in going else NOWHERE, (used | 1 << j) & live)
                    if chunks + 1 < new.get(state, bound):
                        new[state] = chunks + 1
        seen[word] += 1
        if len(new) > states:
            whole = False
            new = dict(sorted(new.items(), key=lambda s: (s[1], s[0][0] == NOWHERE, s[0]))[:states])
        layer = new
    return min(layer.values(), default=bound), whole


def _fewest_keyed(row: _Row, found: int, least: int, states: int) -> int:
    """The fewest chunks, no more than ``found`` and no fewer than ``least``: more choices are kept until none is given up."""
    whole = False
    while found > least and not whole:
        found, whole = _search(row, found, states)
        states *= WIDER
    return found


def fewest_chunks(*stages: pa.Array, states: int = STATES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(matches, chunks, exact) per row, for lists of words and, optionally, of keys of the words.

    Matches are as in ``alignment``: k-th copies give a first number of chunks, and rows in which words repeat are
    searched for fewer. The chunks are the least there are in every row, so ``exact`` is 1; ``states`` is how many choices
    the search with keys begins with.
    """
    if len(stages) not in (2, 4):
        raise ValueError("fewest chunks are found for equal words and at most one more stage")
    matches, chunks = alignment(*stages)
    exact = np.ones(len(chunks), np.int32)
    for r in np.flatnonzero(chunks > 1):
        lists = [column[int(r)].values for column in stages]
        sizes = np.cumsum([0] + [len(values) for values in lists])
        # words and keys are coded apart
        codes = np.concatenate([
            pa.concat_arrays(lists[k : k + 2]).dictionary_encode().indices.to_numpy() for k in range(0, len(lists), 2)
        ]).astype(np.int64)
        parts = [codes[a:b] for a, b in zip(sizes, sizes[1:])]
        # of keys alone: at least as many links as words and keys allow
        least = int(matches[r]) - most_links(*parts[-2:])
        if len(stages) == 2 or chunks[r] <= least:
            chunks[r] = least
            continue
        most = min(states, max(LEAST_STATES, OPEN_CHOICES // len(parts[0])))
        chunks[r] = _fewest_keyed(_Row(*parts), int(chunks[r]), least, most)
    return matches, chunks, exact
