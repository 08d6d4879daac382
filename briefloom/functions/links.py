"""The most links of two lists of words: pairs of neighbours on one side that are matched with neighbours on the other.

A link (i, j) matches word i with j and word i + 1 with j + 1. Links agree if no word is matched with two. Any links that
agree can be filled up to an alignment with as many matches as possible, so its fewest chunks are its matches less the
most links that agree. Links that do not touch are searched apart, and most are decided by a bound or by others that
leave at least as much open; of the rest all choices are tried that the bounds allow.
"""

from __future__ import annotations

import heapq
import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

# Bytes of sets of links whose most links are remembered; beyond that they are found anew.
REMEMBERED = 64 << 20


def links_of(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) where two words in a row are equal, for lists of codes."""
    if min(len(left), len(right)) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kinds = int(max(left.max(), right.max())) + 1
    a, b = (x[:-1].astype(np.int64) * kinds + x[1:] for x in (left, right))
    order = np.argsort(a, kind="stable")
    begins, ends = (np.searchsorted(a[order], b, side) for side in ("left", "right"))
    counts = ends - begins
    j = np.repeat(np.arange(len(b)), counts)
    inside = np.arange(len(j)) - np.repeat(np.cumsum(counts) - counts, counts)
    return order[begins[j] + inside], j


def most_links(left: np.ndarray, right: np.ndarray) -> int:
    """The most links that agree, for lists of codes of words."""
    i, j = links_of(left, right)
    return sum(_most(part) for part in _apart(i.tolist(), j.tolist())) if len(i) else 0


def _apart(left: list[int], right: list[int]) -> Iterator[list[tuple[int, int]]]:
    """Links in groups that share no word, and no neighbours, with one another."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    # places on the right are told apart as negative numbers
    for i, j in zip(left, right):
        above.setdefault(i, i)
        above.setdefault(~j, ~j)
        above[top(i)] = top(~j)
    for x in list(above):
        if x + 1 in above and (x >= 0) == (x + 1 >= 0):
            above[top(x)] = top(x + 1)
    groups = defaultdict(list)
    for link in zip(left, right):
        groups[top(link[0])].append(link)
    yield from groups.values()


def _most(links: list[tuple[int, int]]) -> int:
    if len(links) == 1:
        return 1
    # links of one place on either side exclude each other
    bound, found = min(len({link[side] for link in links}) for side in (0, 1)), _longest_first(links)
    if found < bound:
        bound = min(_one_side(links, side) for side in (0, 1))
    return found if found == bound else max(found, _Search(links).most(found))


def _one_side(links: list[tuple[int, int]], side: int) -> int:
    """The most links if words of the other side could be matched any number of times: no fewer than those that agree."""
    reach: dict[int, int] = defaultdict(int)
    runs: dict[tuple[int, int], int] = {}
    for i, j in sorted(links, reverse=True):
        n = runs[i, j] = runs.get((i + 1, j + 1), 0) + 1
        place = (i, j)[side]
        reach[place] = max(reach[place], n)
    total, after = 0, -1
    for place in sorted(reach):
        if place >= after:
            # the longest run from the first place that is open
            total += reach[place]
            after = place + reach[place] + 1
    return total


def _longest_first(links: list[tuple[int, int]]) -> int:
    """Links that agree when the longest runs are taken first."""
    runs: list[tuple[int, int, int]] = []

    def add(run: list[tuple[int, int]]) -> None:
        begin = 0
        for k in range(1, len(run) + 1):
            if k == len(run) or run[k] != (run[k - 1][0] + 1, run[k - 1][1] + 1):
                heapq.heappush(runs, (begin - k, *run[begin]))
                begin = k

    add(sorted(links, key=lambda link: (link[0] - link[1], link[1])))
    taken, other, total = {}, {}, 0
    while runs:
        n, i, j = heapq.heappop(runs)
        run = [(i + k, j + k) for k in range(-n)]
        free = [
            (a, b) for a, b in run
            if taken.get(a, b) == b and taken.get(a + 1, b + 1) == b + 1 and other.get(b, a) == a and other.get(b + 1, a + 1) == a + 1
        ]
        if len(free) < len(run):
            add(free)
            continue
        total += len(run)
        for k in range(len(run) + 1):
            taken[i + k], other[j + k] = j + k, i + k
    return total


def _bits(mask: int) -> Iterator[int]:
    while mask:
        low = mask & -mask
        yield low.bit_length() - 1
        mask ^= low


class _Search:
    """Sets of links are integers, a bit for each link."""

    def __init__(self, links: list[tuple[int, int]]):
        links = sorted(links, key=lambda link: (link[1], link[0]))
        by_left, by_right, by_run = defaultdict(int), defaultdict(int), defaultdict(int)
        for v, (i, j) in enumerate(links):
            by_left[i] |= 1 << v
            by_right[j] |= 1 << v
            by_run[i - j] |= 1 << v
        # what a link does not agree with
        self.against = []
        for i, j in links:
            near = 0
            for d in (-1, 0, 1):
                near |= by_left.get(i + d, 0) | by_right.get(j + d, 0)
            self.against.append(near & ~by_run[i - j])
        self.all, self.places = (1 << len(links)) - 1, (list(by_left.values()), list(by_right.values()))
        self.known: dict[int, int] = {}
        self.most_known = max(1, 8 * REMEMBERED // len(links))
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * len(links) + 1_000))

    def most(self, need: int) -> int:
        """The most links that agree, if there are more than ``need``; otherwise a number up to it."""
        return self._parts(self.all, self.all, need)

    def _parts(self, links: int, changed: int, need: int) -> int:
        found, links = self._decided(links, changed)
        parts = sorted(self._apart(links), key=int.bit_count)
        bounds = [self._bound(part) for part in parts]
        open_ = sum(bounds)
        for part, bound in zip(parts, bounds):
            if found + open_ <= need:
                break
            open_ -= bound
            found += self._tried(part, bound, need - found - open_)
        return found + open_ if found + open_ <= need else found

    def _decided(self, links: int, changed: int) -> tuple[int, int]:
        """Drops links that exclude all that another one does, and takes those that nothing is left against."""
        against, found = self.against, 0
        while changed:
            low = changed & -changed
            changed ^= low
            if not low & links:
                continue
            v = low.bit_length() - 1
            near, gone = against[v] & links, 0
            for u in _bits(near):
                if not near & ~gone & ~(against[u] | 1 << u):
                    gone |= 1 << u
            links &= ~gone
            for u in _bits(gone):
                changed |= against[u] & links
            if near == gone:
                found += 1
                links ^= low
        return found, links

    def _apart(self, links: int) -> Iterator[int]:
        while links:
            part = front = links & -links
            while front:
                near = 0
                for v in _bits(front):
                    near |= self.against[v]
                front = near & links & ~part
                part |= front
            yield part
            links ^= part

    def _bound(self, links: int) -> int:
        """The fewest groups found of links that all exclude each other."""
        bound = min(sum(1 for place in side if place & links) for side in self.places)
        groups = 0
        while links:
            low = links & -links
            links ^= low
            fit = self.against[low.bit_length() - 1] & links
            while fit:
                low = fit & -fit
                links ^= low
                fit &= self.against[low.bit_length() - 1]
            groups += 1
        return min(bound, groups)

    def _tried(self, links: int, bound: int, need: int) -> int:
        if links in self.known:
            return self.known[links]
        if bound <= need:
            return bound
        against = self.against
        v = max(_bits(links), key=lambda u: (against[u] & links).bit_count())
        near, beyond = against[v] & links, 0
        for u in _bits(near):
            beyond |= against[u]
        links_left = links & ~(1 << v)
        best = 1 + self._parts(links_left & ~near, beyond & links_left & ~near, need - 1)
        best = max(best, self._parts(links_left, near, max(need, best)))
        if best > need:
            if len(self.known) >= self.most_known:
                self.known.clear()
            self.known[links] = best
        return best
