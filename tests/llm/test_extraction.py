"""Main text of pages: the given tables against a plain reading of their markup, and templates of other kinds."""

import html
import re

import numpy as np
import pytest

from caseloom.llm import extraction as X
from caseloom.llm.queries import QUERIES

SENTENCE = "It was a bright cold day in April, and the clocks were striking thirteen; nobody had asked them to."
LONG = " ".join([SENTENCE] * 4)

PAGES = {
    "semantic": (
        f"<header><a href='/'>Site</a> The daily paper of the town</header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>"
        f"<main><article><header><h1>A headline</h1></header><p>{LONG}</p><p>Short.</p><aside><p>{LONG}</p></aside><p>Last &amp; least&nbsp;&#33;</p>"
        f"<section class='comments'><h2>Comments</h2><article class='comment'><p>{LONG} I agree.</p></article></section></article></main><footer><p>{LONG}</p></footer>",
        ["A headline", LONG, "Short.", "Last & least !"],
    ),
    "classes": (
        f"<div id='page-header'><h1>The Site</h1><p>{SENTENCE}</p></div><div class='cookie-notice'><p>{LONG}</p></div><div class='mainMenu'><a href=1>A</a> <a href=2>B</a></div>"
        f"<div class='layout has-sidebar'><div class='post'><div class='post-header'><h2>Title</h2></div><div class='post-body'><p>{LONG}</p><blockquote>Quoted.</blockquote><p>{SENTENCE}"
        f"<p>Not closed<ul><li>first</li><li>second</ul></div></div><div class='sidebar'><p>{LONG}</p></div><div class='ad'>{LONG}</div></div>"
        f"<div id='disqus_thread'><p>{LONG}</p></div><form><p>{LONG}</p><input></form><div class=footer>{SENTENCE}</div>",
        ["Title", LONG, "Quoted.", SENTENCE, "Not closed", "first", "second"],
    ),
    "no container": (f"<body><ul><li><a href=1>Start</a><li><a href=2>About</a></ul><h1>Head</h1><p>{LONG}<p>Tiny.<p>{LONG}<p><a href=3>Next page</a></body>", ["Head", LONG, "Tiny.", LONG]),
    "no hints": (
        f"<div><div><ul><li><a href=1>Start</a></li><li><a href=2>About us</a></li><li><a href=3>Contact</a></li></ul></div><div><h1>Head</h1><p>{LONG}</p><p>Tiny.</p><p>{LONG}</p></div>"
        f"<div><span>About</span><a href=4>Terms</a><a href=5>Privacy</a></div></div>",
        ["Head", LONG, "Tiny.", LONG],
    ),
    "framed": (f"<form id=aspnet><div class='nav'><a href=1>x</a></div><div class=content><p>{LONG}</p><p>End.</p></div></form>", [LONG, "End."]),
    "menu class on the page": (f"<div class='menu-open'><article><p>{LONG}</p></article></div>", [LONG]),
    "one short line": ("<html><body><article><p>Hi.</p></article><div class=ad>Buy this now, it is much longer than the text.</div></body></html>", ["Hi."]),
    "text only": ("just &lt;some&gt;\n\t text", ["just <some> text"]),
    "line breaks": ("<article>one<br>two<br/>three <b>bold<i> and</b> more</article>", ["one two three bold and more"]),
    "hidden": (f"<article><p style='display: none'>no</p><p hidden>no</p><p>{LONG}</p><script>var x = '<p>no</p>';</script><style>p > a {{}}</style><!-- no --></article>", [LONG]),
    "table": (f"<article><p>{LONG}</p><table><tr><td>a</td><td>b</td></tr><tr><td>c<td>d</table></article>", [LONG, "a b", "c d"]),
    "two articles": (f"<main><article><h2>A</h2><p>{LONG}</p></article><article><h2>B</h2><p>{LONG}</p></article></main>", ["A", LONG, "B", LONG]),
    "paragraph of a link": (f"<article><p>{LONG}</p><p><a href=1>{SENTENCE}</a></p><p>{LONG}</p></article>", [LONG, SENTENCE, LONG]),
    "article of a link": (f"<nav><a href=1>x</a></nav><article><a href=1>{SENTENCE}</a></article><p><a href=2>y</a></p>", [SENTENCE]),
    "links only": ("<p><a href=1>x</a></p><p><a href=2>y</a></p>", []),
    "repeated lines": (f"<article><p>{SENTENCE}</p><p>{SENTENCE}</p><p>{SENTENCE}</p></article>", [SENTENCE] * 3),
    "nothing": ("<nav>Menu</nav><script>x()</script>", []),
    "empty": ("", []),
    "broken": (f"<article><p>{LONG}</div></span></p></nav><p>a < b &unknown; &amp<p><<>>", [LONG, "a < b &unknown; &", "<<>>"]),
}


@pytest.mark.parametrize("name", PAGES)
def test_templates(name):
    page, blocks = PAGES[name]
    assert X.main_text(page).split("\n") == (blocks or [""])


def test_null_page():
    assert X.main_text(None) == ""


def test_smoothing_is_the_weighted_mean():
    ratios = np.array([0.0, 10, 0, 0, 40, 2, 0])
    weight = {d: np.exp(-0.5 * (d / X.SIGMA) ** 2) for d in range(-X.RADIUS, X.RADIUS + 1)}
    for i, got in enumerate(X.smoothed(ratios)):
        near = [(w, ratios[i + d]) for d, w in weight.items() if 0 <= i + d < len(ratios)]
        assert got == pytest.approx(sum(w * r for w, r in near) / sum(w for w, _ in near))
    assert X.smoothed(np.array([3.0])).tolist() == [3.0]


def article(page):
    """The given pages have their article in one element of headings and paragraphs."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:h1|p)>", inside)]
    return "\n".join(b for b in blocks if b)


def test_query_against_plain_reading(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op13_html_extraction"](spark, sf)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html) and r.url == pages[r.page_id].url and r.n_chars == len(r.text)


def test_tables(spark):
    rows = [(1, "u", "<p>Hello"), (1, "u", "<p>Hello"), (None, None, None), (2, "u", ""), (3, "u", f"<article>{'<p>word é😀 &amp; more' * 30_000}</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "7 AS text", "'x' AS n_chars", "8 AS kind")
    got = X.extract(df).collect()
    assert sorted((str(r.page_id), r.text[:5], r.n_chars, r.kind) for r in got) == [
        ("1", "Hello", 5, 8), ("1", "Hello", 5, 8), ("2", "", 0, 8), ("3", "word ", 30_000 * 14 + 29_999, 8), ("None", "", 0, 8)
    ]
    assert X.extract(df.limit(0)).columns == ["page_id", "url", "html", "kind", "text", "n_chars"] and X.extract(df.limit(0)).count() == 0
