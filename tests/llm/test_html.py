"""Main text beside its SQL on the test pages, and on pages of other make."""

import duckdb
import pytest

from snapfold.llm import html_blocks as op

SF = "/root/testdata/sf0.01"
BODY = "This paragraph of the article says a lot, and goes on for long enough to be taken for text."
PAGES = {
    "no article element": (
        f'<html><head><title>t</title></head><body><header><h1>Site</h1></header><div id="menu"><a href=x>home</a></div>'
        f'<div class="cookie-notice">We use cookies</div><div class="content"><h2>My title</h2><p>{BODY}</p><p>Short.</p>'
        f'<div class="ad-slot">Buy</div><p>{BODY} &lt;ok&gt;</p><ul><li>one</li></ul><form><label>Mail</label><input></form></div>'
        f'<div class="sidebar"><p>{BODY}</p></div><section id="comments"><p>{BODY}</p></section><footer>c</footer></body></html>',
        f"My title {BODY} Short. {BODY} <ok> one"),
    "article with parts that are not its text": (
        "<article><h1>T</h1><p>One</p><aside>no</aside><p class=\"promo\">no<p>Two<script>if (a<b) {}</script><style>x</style>"
        "<div class='share'>no</div><blockquote>Three</blockquote><form>no</form><section class='comments'><p>no</p></section></article>"
        "<article class='comment'>no</article><footer>no</footer>", "T One Two Three"),
    "inline markup, references, white space": (
        "<main><p>a<b>b</b>c &amp;amp; &#233;&eacute;&copy;\n\t d&nbsp;e<br>f<!-- no --></p>  <td>x</td></main>", "abc &amp; éé© d e f x"),
    "cut off in a tag": ("<article><p>One</p><p cla", "One"),
    "cut off in a reference": ("<article><p>One &am", "One &am"),
    "cut off in a left-out element": ("<article><p>One</p></article><footer>no", "One"),
    "left-out element not closed": ("<nav><a>no</a><article><p>One</p></article>", "One"),
    "hidden": ("<article><p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p>a < b</article>", "a < b"),
    "quotes with signs in attributes": ('<article><p title="a>b">One</p><p title="x>Two</p></article>', None),
    "head not closed": (f'<html><head class="site-nav"><meta charset=utf-8><title>t</title><style>p {{}}</style><body><p>{BODY}</p></body></html>', BODY),
    "story in a div, teasers in articles": (
        f"<body><div><h1>My title</h1><p>{BODY}</p><p>Short.</p><p>{BODY}</p></div>"
        + "<article><h2><a href=x>More</a></h2><p>A teaser of some words</p></article>" * 4 + f"<article><p>{BODY}</p></article></body>",
        f"My title {BODY} Short. {BODY}"),
    "story and teasers in articles": (
        f"<article><h1>T</h1><p>{BODY}</p><p>End.</p></article><article class=card><h2>A teaser</h2><p>of some words</p></article>",
        f"T {BODY} End."),
    "links inside an article": (
        f"<article><ul><li><a href=x>Home</a><li><a href=y>News</a></ul><h1>T</h1><p>One</p><p>{BODY} <a href=z>more</a></p>"
        + "<p><a href=x>Read this as well, it is long enough to be text if links counted</a></p>" * 4 + "</article>", f"T One {BODY} more"),
    "main around an article": (f"<main><h1>T</h1><ul><li><a>x</a></ul><article><p>{BODY}</p></article><p>End.</p></main>", f"T {BODY} End."),
    "nothing": ("", ""), "menu only": ("<nav><ul><li><a>x</a></li></ul></nav>", ""), "white space": (" \n ", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(name):
    html, want = PAGES[name]
    assert op.main_text(html) == want if want is not None else isinstance(op.main_text(html), str)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    got = sorted(map(tuple, op.op3_html_blocks(spark, SF).collect()))
    assert got == sorted(con.execute(op.OP3_SQL).fetchall())
    assert sum(bool(r[2]) for r in got) > 200


def test_edges_of_input(spark):
    long_ = "<article>" + "<p>word &amp; word</p>" * 50_000 + "</article>"
    rows = [(1, None, None), (None, "u", "<article>x</article>"), (1, "u", "<article>x</article>"), (2, "u", long_), (3, "u", "<p>" * 20000)]
    df = spark.createDataFrame([(*r, "old", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = op.extract(df)
    assert sorted(got.columns) == sorted(df.columns)
    assert [len(r.text) for r in got.collect()] == [0, 1, 1, 12 * 50_000 - 1, 0]
    assert op.extract(df.limit(0)).count() == 0
