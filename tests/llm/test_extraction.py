"""Main texts of pages written for the test, and of the given ones."""

from __future__ import annotations

import html
import re

import pytest

from millrace.llm import extraction
from millrace.llm.common import table
from millrace.llm.queries import QUERIES

PAGES = "page_id long, url string, html string"
WORDS = "A sentence that is long enough to count as part of an article, with a comma."


def text(source, winners=()):
    return extraction.main_text(source, list(winners))[0]


SITE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a = "<p>no</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1><p>Slogan of the site</p></header>
<nav><ul><li><a href="/">Home</a></li><li><a href="/b">B</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies, and we are proud of it, so click here.</p></div>
<div id="wrap"><{open}><h2>Title &amp; more</h2><p>First&nbsp;of <b>two</b>
 lines.<br>{words}</p><form><p>Your mail</p><input name=q></form><div class="ad">Buy this</div>
<ul><li>One point</li><li>Two <a href=x>points</a></li></ul><ul><li><a href=1>See</a></li><li><a href=2>also</a></li></ul></{close}>
<aside><p>Side text that is not the article, however long it may be, and it is long.</p></aside>
<section class="comments"><article class="comment"><p>{words}</p><p>{words}</p><p>{words}</p></article></section></div>
<footer>&copy; <p>All rights reserved by the people who made this page</p></footer></body></html>"""
ARTICLE = f"Title & more\nFirst of two lines. {WORDS}\nOne point\nTwo points"


@pytest.mark.parametrize("name", ["article", "main", 'div class="post-content"', 'section itemprop="articleBody"', "div"])
def test_an_article_among_everything_else(name):
    assert text(SITE.format(open=name, close=name.split()[0], words=WORDS)) == ARTICLE


@pytest.mark.parametrize(
    "source, expected",
    [
        (None, ""),
        ("", ""),
        ("no markup at all", "no markup at all"),
        ("<p>one<p>two", "one\ntwo"),
        ("<article><p><b>one<br><p>two</b></p>three", "one\ntwo\nthree"),
        ("<article><p>a &lt; b &amp;amp; c &#8364; &am &notit;</article>", "a < b &amp; c € &am ¬it;"),
        ("<article><p>cut off <a href='x", "cut off"),
        ("<article><p>1 < 2 <!-- <p>no</p> --> and 3 > 2</article>", "1 < 2 and 3 > 2"),
        ("<article><p>x</p><script>if (a < b) { '</p>' }</script><p>y<!-- never closed <p>z", "x\ny"),
        ("<article><h1>Title</h1><table><tr><td>a<td>b<tr><td>c</table></article>", "Title\na\nb\nc"),
        ("<article title='a > b'><p title=\"</article>\">x</p></article>", "x"),
        ("<article><p>x <span class='share'>Share</span> y</p></article>", "x\ny"),
        ("<article><p hidden>x</p><p style='display: none'>y</p><p>z</p></article>", "z"),
        ("<article><header><h1>T</h1><p>by A</p></header><p>z</p></article>", "T\nz"),
        ("<nav><a href=1>a</a><article><p>z</p></article>", "z"),
        ("<article></article><div class='ad'>Buy</div>", ""),
        ("<form action=x><div><p>" + WORDS + "</p></div><input></form>", WORDS),
        ("<article><pre>a\n  b</pre><blockquote>c</blockquote></article>", "a b\nc"),
        ("<ARTICLE><P>x</P></ARTICLE>", "x"),
        ("\x00<article>\U0001f600\xa0 x</article>", "\U0001f600 x"),
    ],
)
def test_single_pages(source, expected):
    assert text(source) == expected


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + f"<p>{WORDS}</p>" + "</div>" * 5000
    assert text(deep) == WORDS
    long = "<article>" + f"<p>{WORDS}</p>" * 20000 + "</article>"
    assert text(long) == "\n".join([WORDS] * 20000)
    assert text("<a b='" * 3000) == "" and text("<" * 100000) == "<" * 100000


def page(kind: str, n: int) -> str:
    body = f"<p>{WORDS} {n}</p>" * 4
    long = f"<p>{WORDS}</p>" * 9
    if kind == "usual":
        return f"<div class=top><p>Top</p></div><div class='box n{n}'>{body}</div><div class=low><p>{WORDS}</p></div>"
    return f"<div class=top><p>Top</p></div><div class='box n{n}'><p>Short {n}.</p></div><div class=low>{long}</div>"  # the page alone would mislead


def test_a_host_outvotes_its_odd_pages(spark):
    rows = [(i, f"http://Example.org/{i}", page("usual", i)) for i in range(12)]
    rows += [(50, "https://example.org?x", page("odd", 50)), (51, "https://other.org/", page("odd", 51))]
    got = {r["page_id"]: r for r in extraction.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[50]["text"] == "Short 50." and got[50]["path"] == "div.box.n0" and got[50]["host"] == "example.org"
    assert got[51]["text"] == "\n".join([WORDS] * 9)
    assert got[3]["text"] == "\n".join([f"{WORDS} 3"] * 4)


def test_a_path_inside_the_winning_one():
    source = f"<div class=wrap><p>Top of the page</p><article><p>{WORDS}</p></article></div>"
    assert extraction.main_text(source, ["div.wrap", "div.wrap/article"]) == (WORDS, "div.wrap/article")
    assert extraction.main_text(source, ["div.wrap"])[1] == "div.wrap"
    assert extraction.main_text(source, ["div.none"])[1] == "div.wrap/article"


def test_all_pages_of_a_path_are_taken():
    source = f"<div><section class='part1'><p>{WORDS}</p></section><p>x</p><section class=part22><p>b</p></section></div>"
    assert extraction.main_text(source, ["div/section.part0"])[0] == f"{WORDS}\nb"


def test_nulls_repeats_clashes_and_empty_tables(spark):
    rows = [(1, None, f"<p>{WORDS}"), (1, None, f"<p>{WORDS}"), (None, "nothing", None), (2, "http://a/", ""), (3, "http://a/", f"<article>{WORDS}</article>")]
    frame = spark.createDataFrame(rows, PAGES)
    got = sorted((tuple(r) for r in extraction.extract(frame).collect()), key=repr)
    n = len(WORDS)
    assert [r[:4] for r in got] == sorted(
        [(1, None, WORDS, n)] * 2 + [(None, "nothing", "", 0), (2, "http://a/", "", 0), (3, "http://a/", WORDS, n)], key=repr
    )
    assert {r[4] for r in got} == {"", "a"} and {r[0]: r[5] for r in got}[3] == "article" and {r[0]: r[5] for r in got}[None] is None
    clashing = frame.selectExpr("*", *[f"'x' as {name}" for name in "host path text n_chars winners votes total less".split()])
    assert sorted((tuple(r) for r in extraction.extract(clashing).collect()), key=repr) == got
    assert extraction.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_given_pages(spark, sf_dir):
    """These pages hold headings and paragraphs in one article."""
    got = {r["page_id"]: r for r in QUERIES["op13_html"](spark, sf_dir).collect()}
    given = table(spark, sf_dir, "pages").collect()
    assert len(got) == len(given)
    for row in given:
        inner = re.search("<article>(.*?)</article>", row["html"], re.S).group(1)
        blocks = re.split("</?(?:p|h1)>", inner)
        plain = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
        expected = "\n".join(b for b in plain if b)
        assert got[row["page_id"]]["text"] == expected and got[row["page_id"]]["n_chars"] == len(expected)
