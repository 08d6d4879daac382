"""Operators that learn, and HTML extraction: kernels against brute force, queries on held-out rows."""

from __future__ import annotations

import html as markup
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from briefloom.llm.helpers import table
from briefloom.llm.html_extract import Page, extract_pages, op2_html_extract
from briefloom.llm.language_id import has_letter, identify_languages, n_grams, support_vectors
from briefloom.llm.learning import isotonic
from briefloom.llm.quality_classifier import STATISTICS, quality_scores, statistics
from briefloom.llm.toxicity import segments, toxic_passages

SF = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string"

PAGE = """<!DOCTYPE html><html><head><title>Head</title><style>p{}</style></head><body class="page no-sidebar">
<header><h1>Site</h1></header><div class="cookie-notice">We use cookies, accept them.</div><nav><ul><li><a href=x>Home</ul></nav>
<!-- <p>not this</p> --><div id="wrap"><div class="story-%d"><h2>Title &amp; more</h2><p>First   para
 with <b>bold</b> &eacute;&#233; text that goes on for a while.<p>Second para<br>line, a little longer than the first one was.
<ul><li>one<li>two</ul><form><label>Mail</label><input></form><script>if(a<b){x="</p>"}</script><noscript>off</noscript>
<div class="ad">Buy now</div><blockquote>Quoted</blockquote></div>
<div class="sidebar"><p>Side text that is long enough to matter, with many words in it for a trap.</p></div>
<section id="comments"><p>A comment that is a good deal longer than the article itself, to see that it is left out. %s</p></section>
</div><footer>foot</footer></body></html>"""
WANT = "Title & more\nFirst para with bold éé text that goes on for a while.\nSecond para line, a little longer than the first one was.\none\ntwo\nQuoted"


def test_the_article_is_cut_out():
    page = Page(PAGE % (7, "word " * 50))
    assert page.at(None) == WANT
    assert page.at("html>body.no-sidebar.page>div>div.story-") == WANT
    assert page.at("html>body>nowhere") == WANT


@pytest.mark.parametrize("html, want", [
    ("", ""), ("plain text &lt;b&gt;", "plain text <b>"), ("<p>a<p>b", "a\nb"), ("<div><p>x</div>y", "x"),
    ("<article><header><h1>T</h1></header><p>b</p><footer>f</footer></article><p>tail", "T\nb"),
    ("<body><p title='it's'>odd quotes</p>", "odd quotes"), ("<p>cut off in <a href=\"x", "cut off in <a href=\"x"),
    ("<main>1 < 2 <i>yes</i></main>", "1 < 2 yes"), ("<script>never closed <p>x", ""), ("<aside><p>only aside</p></aside>", ""),
])
def test_odd_markup(html, want):
    assert Page(html).at(None) == want


def test_hosts_vote_for_a_path(spark):
    """One page of the host has a longer comment block without a telling class; the host's path still wins."""
    usual = "<body><div class='c1'><p>{}</p></div><div class='x'><p>short</p></div></body>"
    trap = "<body><div class='c2'><p>the story</p></div><div class='x'><p>{}</p></div></body>".format("long " * 60)
    rows = [(i, "https://H.example.com/%d" % i, usual.format("story words " * 9)) for i in range(6)] + [(9, "https://h.example.com/9?x", trap)]
    rows += [(10, None, trap), (11, "odd", None), (12, "http://h.example.com", ""), (9, "https://h.example.com/9?x", trap)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("host", F.lit("x")).withColumn("path", F.lit("y"))
    for limit in (10, 0):
        got = sorted((r["page_id"], r["text"]) for r in extract_pages(pages, max_broadcast_rows=limit).collect())
        assert [t for i, t in got if i == 9] == ["the story"] * 2
        assert [t for i, t in got if i in (11, 12)] == ["", ""] and len(got) == len(rows)
    assert extract_pages(pages.limit(0)).collect() == []


def test_every_given_page_is_read_to_the_end(spark):
    got = {r["page_id"]: r for r in op2_html_extract(table(spark, SF, "pages")).collect()}
    for page in table(spark, SF, "pages").collect():
        text = got[page["page_id"]]["text"]
        body = page["html"].split("<article>")[1].split("</article>")[0].split("<footer>")[0]
        spans = "".join(re.split(r"<[^>]*>", body))
        assert "".join(text.split()) == "".join(markup.unescape(spans).split())
        assert got[page["page_id"]]["n_chars"] == len(text)


@pytest.mark.parametrize("html, want", [
    ("<div class=post><h1>Title</h1><p>intro</p><section><p>{0}</p></section><section><p>{0}</p></section></div>", "Title\nintro\n{0}\n{0}"),
    ("<div class=post><h1>Title</h1><section class=a><p>{0} {0} {0}</p></section><section class=b><p>{0}</p></section></div>", "Title\n{0} {0} {0}\n{0}"),
    ("<div class=post><p>before it</p><blockquote>{0}</blockquote><p>after it</p></div>", "before it\n{0}\nafter it"),
    ("<div class=all><div class=c><p>{0}</p></div><div class=x><p>short</p></div></div>", "{0}"),
])
def test_the_title_and_other_parts_of_an_article_stay(spark, html, want):
    prose = "words of the story " * 4 + "end"
    page = "<body>" + html.format(prose) + "</body>"
    rows = [(i, f"https://h.example.com/{i}", page) for i in range(3)]
    got = extract_pages(spark.createDataFrame(rows, PAGES)).collect()
    assert [r["text"] for r in got] == [want.format(prose)] * 3


@pytest.mark.parametrize("html, want", [
    ("<body><form id=aspnetForm><nav>menu</nav><div><p>{0}</p></div></form></body>", "{0}"),
    ("<body><div class='elementor-widget elementor-widget-text-editor'><p>{0}</p></div><div class=widget>short</div></body>", "{0}"),
    ("<body><div class=commentary><p>{0}</p></div></body>", "{0}"),
    ("<article><p>{0}</p><p class=notice>take note of it</p><div class=related>a <a href=x>link to more</a></div></article>", "{0}\ntake note of it"),
    ("<body><div class=c><p>before <svg class=icon viewBox='0 0 1 1'/> after</p><p>{0}</p></div></body>", "before after\n{0}"),
    ("<body><div class=c><p>before <svg><path d='M0'/></svg> after</p><form><p>Mail</p></form><p>{0}</p></div></body>", "before after\n{0}"),
])
def test_chrome_words_do_not_take_the_main_text(html, want):
    prose = "words of the story " * 4 + "end"
    assert Page(html.format(prose)).at(None) == want.format(prose)


@pytest.mark.parametrize("wrapper", [
    'div class="content-sidebar-wrap"', 'div class="nav-fixed"', 'div id="page" class="menu-closed"', 'div id="ad-astra-story"',
    'div class="commentable-article"', 'section class="sidebar-right footer-dark"',
])
@pytest.mark.parametrize("inner", ["{}", "<main>{}</main>", "<div class=x><article>{}</article></div>"])
def test_wrappers_named_like_chrome_keep_the_page(wrapper, inner):
    article = "<h1>Title</h1><p>" + "Some words of the story. " * 9 + "</p><p>" + "More of it here. " * 9 + "</p>"
    side = '<div class="sidebar"><p>About us, in prose.</p></div><div class="menu"><a href=x>One</a></div>'
    comments = f'<div id="comments"><article class="comment"><h1>Re</h1><p>{"I agree. " * 400}</p></article></div>'
    page = f"<html><body><nav><a href=x>Home</a></nav><{wrapper}>{inner.format(article)}{side}{comments}</{wrapper.split()[0]}>" \
        '<div class="footer">Imprint</div></body></html>'
    assert Page(page).at(None) == f"Title\n{('Some words of the story. ' * 9).strip()}\n{('More of it here. ' * 9).strip()}"


def test_long_notices_are_not_taken_for_the_article():
    page = f'<body><div class="cookie-consent"><p>{"We use cookies. " * 60}</p></div><div class="post"><h1>Hi</h1><p>Short story.</p></div></body>'
    assert Page(page).at(None) == "Hi\nShort story."


def test_isotonic_is_the_closest_rising_curve():
    rng = np.random.default_rng(0)
    x, n = np.arange(40.0), rng.integers(1, 9, 40).astype(float)
    p = np.minimum(n, rng.integers(0, 9, 40)).astype(float)
    centres, rates = isotonic(x, p, n)
    assert (np.diff(rates) > 0).all() and (np.diff(centres) > 0).all()
    assert (rates * 0 + 1).sum() == len(rates) and np.isclose(p.sum(), sum(r * w for r, w in zip(rates, _weights(centres, x, n))))


def _weights(centres, x, n):
    """Total weight of the blocks whose weighted centres are given."""
    out, i = [], 0
    for c in centres:
        j = i + 1
        while not np.isclose((x[i:j] * n[i:j]).sum() / n[i:j].sum(), c):
            j += 1
        out.append(n[i:j].sum())
        i = j
    assert i == len(x)
    return out


def brute_segments(scores):
    """Maximal scoring segments by their recursive definition."""
    best = max(((sum(scores[i:j]), -(j - i), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0,))
    if best[0] <= 1e-12:
        return []
    _, _, i, j = best
    return [*brute_segments(scores[:i]), (i, j - 1), *((a + j, b + j) for a, b in brute_segments(scores[j:]))]


def test_segments_are_the_maximal_ones():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randrange(0, 14)
        scores = [rng.choice((-0.37, -0.37, rng.random() + 0.01)) for _ in range(n)]
        at = [i for i, s in enumerate(scores) if s > 0]
        got = [(a, b) for a, b, _ in segments([scores[i] for i in at], at, 0.37)]
        assert got == brute_segments(scores), scores


def test_statistics_of_odd_texts():
    import pyarrow as pa

    got = statistics(pa.array([None, "", " \n", "A a a a a a a a a a a", "x# y|\nx# y|\nz"], pa.string()))
    assert (got[:3] == 0).all()
    by = dict(zip(STATISTICS, got[3]))
    assert by["same_as_before"] == pytest.approx(9 / 11) and by["different_words"] == pytest.approx(2 / 11) and by["repeated_windows"] > 0
    by = dict(zip(STATISTICS, got[4]))
    assert by["repeated_lines"] == pytest.approx(1 / 3) and by["symbol_ends"] == pytest.approx(4 / 5)


def test_support_vectors_separate():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5)).astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0.2, 1, -1)
    w = support_vectors(x, y, c=10.0, rounds=40)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.97


def test_n_grams_ignore_case_and_digits():
    a, b, c, d = n_grams(["Schön 12", "schön 99", None, "1 2"])
    assert np.allclose(a, b) and not has_letter("1 2 !") and has_letter("é") and not has_letter(None)
    assert (c >= 0).all() and (d >= 0).all()


def odd_rows(docs):
    """Rows with nulls, an empty and a very long text, a repeated row, and clashing columns."""
    spark = docs.sparkSession
    rows = [(10**6, None, "en"), (10**6 + 1, "", "en"), (10**6 + 2, "12 !? 34", None), (None, "plain text", "en"), (10**6 + 3, "wort und satz " * 40_000, "de")]
    more = spark.createDataFrame(rows + rows[-1:], "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang").unionByName(more)
    return both.select("*", *[F.lit("x").alias(c) for c in ("label", "stats", "score", "held_out", "fold", "segments", "at", "digest")])


def held_out_accuracy(got, truth, guess):
    both = got.merge(truth, on="doc_id")
    both = both[both.held_out]
    return (both[guess[0]] == both[guess[1]]).mean()


def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = quality_scores(odd_rows(docs), labels.withColumn("stats", F.lit(1))).toPandas()
    assert len(got) == docs.count() + 6 and got.score.between(0, 1).all() and got.held_out.notna().all()
    assert held_out_accuracy(got, labels.toPandas(), ("predicted", "quality")) > 0.95
    none = quality_scores(docs.limit(20), labels.limit(0)).toPandas()
    assert len(none) == 20 and none.score.between(0.4, 0.6).all()
    assert quality_scores(docs.limit(0), labels).count() == 0


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    rows = toxic_passages(odd_rows(docs), labels.withColumn("label", F.lit(1)))
    got = rows.toPandas()
    assert len(got) == docs.count() + 6 and got.score.between(0, 1).all()
    truth = labels.toPandas()
    assert held_out_accuracy(got, truth, ("predicted", "toxic")) > 0.97
    both = got.merge(truth, on="doc_id")
    both = both[both.held_out]
    assert both[both.toxic == 1].predicted.mean() > 0.85 and both[both.toxic == 0].predicted.mean() < 0.03
    assert toxic_passages(docs.limit(0), labels).count() == 0
    assert toxic_passages(docs.limit(20), labels.limit(0)).count() == 20


def test_languages_on_held_out_rows(spark):
    docs = table(spark, SF, "documents")
    got = identify_languages(odd_rows(docs)).toPandas()
    assert len(got) == docs.count() + 6 and got.score.between(0, 1).all()
    assert held_out_accuracy(got, docs.select("doc_id", "lang").toPandas(), ("lang_pred", "lang")) > 0.98
    odd = got[got.doc_id.isin([10**6, 10**6 + 1, 10**6 + 2])]
    assert (odd.lang_pred == "und").all() and (odd.score == 0).all()
    assert identify_languages(docs.limit(0)).count() == 0
    one = identify_languages(docs.filter("lang = 'fr'").limit(30)).toPandas()
    assert set(one.lang_pred) <= {"fr", "und"}


def test_copies_do_not_keep_a_language_from_the_sample(spark):
    """Few texts with many copies: some of the sample's texts are those of each language."""
    rows = [(i, f"der satz nummer {chr(97 + i % 3)} ist kurz", "de") for i in range(300)]
    rows += [(1000 + i, f"the sentence of {chr(97 + i % 26)}{chr(97 + i // 26)} is short", "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = identify_languages(docs, per_language=1).toPandas()
    assert set(got[got.doc_id < 1000].lang_pred) == {"de"}
    assert "en" in set(got[got.doc_id >= 1000].lang_pred)
