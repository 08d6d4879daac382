"""HTML extraction by consensus of a host's pages.

Every page scores its containers, each named by its generalised path of tags and classes. The
scores are summed per host and path, the best path of a host wins, and every page is read again
at its host's winning path, widened to the ancestors that hold the title or prose around it. A page
that lacks the path falls back on its own best container.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from briefloom.llm.helpers import stored
from briefloom.scaling import MAX_BROADCAST_ROWS, row_count_at_most

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(?P<raw>script|style|textarea|noscript|iframe|template|svg|select)\b(?!(?<=svg)(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>)(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
    r".*?(?:</(?P=raw)\s*>|$)|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/a-zA-Z][^>]*>",
    re.S | re.I,
)
# A tag whose quotes do not pair up.
ODD_TAG = re.compile(r"<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>[^>]*)>")
ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
SPACES = re.compile(r"[ \t\n\r\f\v ]+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose text is never part of an article.
DROPPED = set("head title nav footer aside form button script style noscript template iframe svg select dialog menu".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
CONTAINERS = set("article main section div td body blockquote".split())
# An opening tag of the key ends open elements of the values (up to the next container).
IMPLIED = {
    "body": {"head"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
# Words of a class or id that mark what surrounds an article.
CHROME = set(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu sidebar widget widgets footer cookie cookies consent gdpr notice notices alert popup modal overlay comment "
    "comments disqus respond replies reply share sharing social related recommended recommendations newsletter subscribe "
    "subscription signup login breadcrumb breadcrumbs pagination pager toolbar masthead copyright legal disclaimer skip "
    "hidden rail aside topbar".split()
)
CHROME_ROLES = set("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
# The same as the beginning or the end of a longer word; and words that take the meaning away ("has-sidebar").
CHROME_BEGINS = ("comment", "advert", "adsby", "sidebar", "breadcrumb", "newsletter", "cookie", "sponsor", "promo", "disqus")
CHROME_ENDS = ("footer", "sidebar", "navbar", "menu", "banner", "comments")
# Those that also name parts of an article: an element counts as chrome only if it is not most of the page's prose.
WEAK = set("widget widgets notice notices legal related banner promo promotion alert overlay modal share social sharing recommended".split())
NO_CHROME = ("commenta",)  # commentary, commentable
# Names of reader comments; no share of the page's text makes these its article.
COMMENTS = ("comment", "disqus", "respond", "replies", "reply")
LAYOUT = {"has", "with", "no", "without", "layout"}
INSIDE = {"article", "main"}


def is_chrome(name: str, inside: bool) -> bool:
    """Whether a class or id names what surrounds an article; a header only outside of one."""
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    if LAYOUT & set(words):
        return False
    if not inside and words and words[-1].endswith("header") and not set(words) & {"post", "entry", "article", "content"}:
        return True
    return any(_chrome_word(w) for w in words)


def _chrome_word(word: str) -> bool:
    return not word.startswith(NO_CHROME) and (word in CHROME or word.startswith(CHROME_BEGINS) or word.endswith(CHROME_ENDS))


def is_weak(name: str) -> bool:
    """Whether a class or id names chrome only by words that also occur in articles."""
    return all(w in WEAK for w in re.split(r"[^a-z]+", name) if w and _chrome_word(w))


def is_comments(name: str) -> bool:
    return any(w.startswith(COMMENTS) and _chrome_word(w) for w in re.split(r"[^a-z]+", name) if w)


# How sure it is that an element is chrome: not at all; by words that articles use too; by a name that a
# wrapper of the whole page may have as well ("content-sidebar-wrap"); for certain.
NOT, WEAKLY, NAMED, SURELY = range(4)


def _attributes(attrs: str, inside: bool) -> tuple[str, int]:
    """(generalised class part of a path step, how sure it is that the element is chrome)."""
    names: list[str] = []
    sure = NOT
    if attrs.strip():
        for name, *values in ATTR.findall(attrs):
            name, value = name.lower(), html.unescape(next((v for v in values if v), "")).lower()
            if name in ("class", "id"):
                own = value.split()
                if name == "class":
                    names += [re.sub(r"\d+", "", x) for x in own]
                for mark in own:
                    if is_chrome(mark, inside):
                        by_word = any(map(_chrome_word, re.split(r"[^a-z]+", mark)))
                        weak = by_word and is_weak(mark)
                        sure = max(sure, SURELY if is_comments(mark) else WEAKLY if weak else NAMED)
            elif name == "role" and value in CHROME_ROLES:
                sure = max(sure, WEAKLY if value == "form" else SURELY)
            elif name != "role" and (name == "hidden" or value == "true"):
                sure = SURELY
    return "".join(f".{x}" for x in sorted(set(names)) if x), sure


class Page:
    """Blocks of text of a page in order, each with the containers around it.

    ``blocks`` holds (text, link characters, containers) and ``paths`` the path of each container.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[str, int, tuple[int, ...]]] = []
        self.paths: list[str] = []
        self.parents: list[int] = []
        self.titles: set[int] = set()  # blocks in an h1
        self.plain_core = False  # an article, main element or title outside of doubtful elements
        stack: list[tuple[str, str, bool, int, int]] = []  # tag, path step, dropped, container or -1, doubtful or -1
        doubts: list[tuple[int, ...]] = []  # per block the doubtful elements around it
        doubtful: list[list[bool]] = []  # per doubtful element: in an article, named as chrome, holds an article or title
        buffer: list[str] = []
        links = 0
        pos = 0

        def flush() -> None:
            nonlocal links
            text = SPACES.sub(" ", html.unescape("".join(buffer))).strip(" ")
            if text:
                if any(x[0] == "h1" for x in stack):
                    self.titles.add(len(self.blocks))
                self.blocks.append((text, links, tuple(x[3] for x in stack if x[3] >= 0)))
                doubts.append(tuple(x[4] for x in stack if x[4] >= 0))
            buffer.clear()
            links = 0

        def dropped() -> bool:
            return bool(stack) and stack[-1][2]

        def add(text: str) -> None:
            nonlocal links
            if text and not dropped():
                buffer.append(text)
                if any(x[0] == "a" for x in stack):
                    links += len(text.strip())

        def pop_to(depth: int) -> None:
            if any(x[0] in BLOCKS for x in stack[depth:]):
                flush()
            del stack[depth:]

        for m in TOKEN.finditer(source):
            add(source[pos : m.start()])
            pos = m.end()
            m = m if m["tag"] or m["raw"] else ODD_TAG.match(m[0])
            if m is None or not m["tag"]:
                continue
            tag = m["tag"].lower()
            if m["close"]:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == tag:
                        pop_to(depth)
                        break
                    # a stray end tag of inline text does not close the container around it
                    if stack[depth][0] in CONTAINERS and tag not in BLOCKS:
                        break
                else:
                    if tag in BLOCKS:
                        flush()
                continue
            if tag == "br":
                add(" ")
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            if tag in BLOCKS:
                flush()
                for depth in range(len(stack) - 1, -1, -1):  # an open paragraph ends at any block
                    if stack[depth][0] == "p":
                        del stack[depth:]
                        break
                    if stack[depth][0] in BLOCKS:
                        break
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in IMPLIED.get(tag, ()):
                    pop_to(depth)
                    break
                if stack[depth][0] in CONTAINERS or stack[depth][0] in ("ul", "ol", "table", "dl"):
                    break
            if m["attrs"].rstrip().endswith("/") and tag not in BLOCKS:
                continue
            inside = any(x[0] in INSIDE for x in stack)
            if tag == "h1" or tag in INSIDE:
                around = [x[4] for x in stack if x[4] >= 0]
                self.plain_core |= not around and not dropped()
                for x in around:
                    doubtful[x][2] = True
            classes, sure = _attributes(m["attrs"], inside)
            chrome = sure > NOT
            drop = tag in DROPPED or chrome and tag not in ("html", "body", *INSIDE) or tag == "header" and not inside
            doubt = -1
            open_ = tag == "form" and sure <= WEAKLY or tag not in DROPPED and tag != "header" and sure in (WEAKLY, NAMED)
            if drop and not dropped() and tag in BLOCKS and open_:
                # the whole page decides
                doubt, drop = len(doubtful), False
                doubtful.append([inside and tag != "form", sure == NAMED, False])
            drop |= dropped()
            container = -1
            step = tag + classes
            if tag in CONTAINERS and not drop:
                container = len(self.paths)
                self.parents.append(next((x[3] for x in reversed(stack) if x[3] >= 0), -1))
                self.paths.append(">".join([x[1] for x in stack if x[0] in BLOCKS] + [step]))
            stack.append((tag, step, drop, container, doubt))
        add(source[pos:])
        flush()
        if doubtful:
            self._decide(doubts, doubtful)

    def _decide(self, doubts: list[tuple[int, ...]], doubtful: list[list[bool]]) -> None:
        """Drops blocks in forms and in elements named as chrome.

        Forms and weakly named elements are kept if they hold most of the page's text outside links,
        and within an article if they have more text outside links than in them. Others are kept if
        they hold most of the page's text and an article, a main element or a title, or nearly all the text of a
        page that has none of these elsewhere.
        """
        prose, linked = [0] * len(doubtful), [0] * len(doubtful)
        for (text, links, _), around in zip(self.blocks, doubts):
            for i in around:
                prose[i] += max(0, len(text) - 2 * links)
                linked[i] += links
        total = sum(max(0, len(text) - 2 * links) for text, links, _ in self.blocks)
        kept = [
            (core and 2 * p > total or not self.plain_core and 10 * p > 9 * total) if named else 2 * p > total or inside and p > n
            for p, n, (inside, named, core) in zip(prose, linked, doubtful)
        ]
        left = [k for k, around in enumerate(doubts) if all(kept[i] for i in around)]
        self.titles = {new for new, old in enumerate(left) if old in self.titles}
        self.blocks = [self.blocks[k] for k in left]

    def scores(self) -> list[float]:
        """Score of each container: characters of text outside links, shared out over the depth.

        A block counts in full for the container directly around it and half as much for
        every further one, so the narrowest container of most of the text wins. An article
        or main element counts double.
        """
        total = [0.0] * len(self.paths)
        for text, links, around in self.blocks:
            weight = max(0, len(text) - 2 * links)
            for container in reversed(around):
                total[container] += weight
                weight *= 0.5
        kind = [p.rpartition(">")[2].partition(".")[0] for p in self.paths]
        return [t * (2 if k in INSIDE else 1) for t, k in zip(total, kind)]

    def widened(self, wanted: set[int]) -> set[int]:
        """Ancestors in place of containers that hold only a part of the article.

        A container gives way to the outermost ancestor, up to an article or main element, that
        has a title or prose (a twentieth of the container's) of its own, or further sections.
        """
        kind = [p.rpartition(">")[2].partition(".")[0] for p in self.paths]
        own, total = [0] * len(kind), [0] * len(kind)
        titled: set[int] = set()
        for i, (text, links, around) in enumerate(self.blocks):
            weight = max(0, len(text) - 2 * links)
            for container in around:
                total[container] += weight
            if around:
                own[around[-1]] += weight
                if i in self.titles:
                    titled.add(around[-1])
        sections = [0] * len(kind)
        for i, parent in enumerate(self.parents):
            if parent >= 0 and kind[i] == "section":
                sections[parent] += total[i]
        out = set()
        for i in wanted:
            top, at = i, i
            while at >= 0 and kind[at] not in INSIDE:
                below, at = at, self.parents[at]
                if at < 0:
                    break
                others = sections[at] - (total[below] if kind[below] == "section" else 0)
                if at in titled or 20 * own[at] > total[top] or kind[below] == "section" and others > 0:
                    top = at
            out.add(top)
        return out

    def at(self, path: str | None) -> str:
        """Text of the containers with this path; else of the best container; else of all blocks.

        Containers are ``widened``.
        """
        wanted = {i for i, p in enumerate(self.paths) if p == path}
        if not any(wanted & set(around) for *_, around in self.blocks):
            scores = self.scores()
            best = max(scores, default=0)
            wanted = {scores.index(best)} if best > 0 else set()
        wanted = self.widened({i for i in wanted if any(i in around for *_, around in self.blocks)})
        return "\n".join(t for t, _, around in self.blocks if not wanted or wanted & set(around))


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; null when there is none."""
    return F.lower(F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))


VOTE = "host string, path string, votes double"


def host_paths(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """(host, path): for every host the path with the largest sum of page shares.

    A page's containers share one vote by score. Votes are added up within a task before they
    are shuffled, so that a host with most of the pages sends one row per path and task.
    """

    def run(batches):
        votes: dict[tuple[str, str], float] = {}
        for batch in batches:
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if host is None or not text:
                    continue
                page = Page(text)
                scores = page.scores()
                total = sum(scores)
                for path, score in zip(page.paths, scores):
                    if score > 0:
                        votes[host, path] = votes.get((host, path), 0.0) + score / total
            if len(votes) > 100_000:
                yield _votes(votes)
                votes = {}
        yield _votes(votes)

    votes_of = pages.select(host_of(F.col(url)).alias("host"), F.col(source).cast("string").alias("html"))
    votes_of = votes_of.mapInArrow(run, VOTE).groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    # the sums of floating votes may differ in the last digits between runs; ties go by path
    ranked = F.struct(F.round("votes", 6).alias("v"), F.col("path"))
    return votes_of.groupBy("host").agg(F.max(ranked)["path"].alias("path"))


def _votes(votes: dict[tuple[str, str], float]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"host": [h for h, _ in votes], "path": [p for _, p in votes], "votes": list(votes.values())},
        pa.schema([("host", pa.string()), ("path", pa.string()), ("votes", pa.float64())]),
    )


def extract_pages(
    pages: DataFrame, ident: str = "page_id", url: str = "url", source: str = "html",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """(page_id, url, host, path, text): the main text of every row of ``pages``.

    Blocks of text are joined by one line break; text is empty for a null or empty page or one
    without text. A page without a host (null or odd URL) is read at its own best container. Equal
    rows give equal results; an empty table gives none; other columns are not read.
    The table of winning paths (one row a host) is broadcast if it is counted to be small;
    beyond that, pages are shuffled by host, in which adaptive skew joins split a hot host.
    """
    paths = stored(host_paths(pages, url, source))
    rows = pages.select(
        F.col(ident).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        host_of(F.col(url)).alias("host"), F.col(source).cast("string").alias("html"),
    )
    small = row_count_at_most(paths, max_broadcast_rows)
    placed = rows.join(F.broadcast(paths) if small else paths, "host", "left")

    def run(batches):
        for batch in batches:
            texts = [
                Page(source).at(path) if source else ""
                for source, path in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), batch.column(4), pa.array(texts, pa.string())],
                ["page_id", "url", "host", "path", "text"],
            )

    return placed.select("page_id", "url", "host", "html", "path").mapInArrow(
        run, "page_id long, url string, host string, path string, text string"
    )


def op2_html_extract(pages: DataFrame) -> DataFrame:
    return extract_pages(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "host", "path"
    )
