import re
from html import unescape

import pytest

from volspark.llm import html

PAGE = """<!DOCTYPE html><html><head><title>Top</title><style>p{{}}</style>
<script>var a="</p><p>no";</script></head><body>
<header>Site name</header><nav><ul><li><a href=x>Home</a></li></ul></nav>
<div class="ad">Buy</div><div id="cookie-notice">We use cookies</div>
<article><header><h1>Title {n} &amp; more</h1></header>
<p>First   <b>bold</b> &#233;t&eacute;<br>line<p>Second &lt;tag&gt; {n}
<!-- no <p>comment</p> --><ul><li>one<li>two</ul>
<form><input value=x><p>Search</p></form><aside>Side</aside>
<section class="comments"><p>Reader says</p></section></article>
<footer>&copy; Site</footer></body></html>"""


def test_article_of_a_page():
    text = html.Page(PAGE.format(n=1)).main_text(frozenset())
    assert text.split("\n\n") == ["Title 1 & more", "First bold été line", "Second <tag> 1", "one", "two"]


def test_odd_markup():
    def text(page):
        return html.Page(page).main_text(frozenset())

    assert text("") == "" and text("plain") == "plain"
    assert text("a < b <p>c") == "a < b\n\nc"
    assert text("<p>x</div></p></b>y") == "x\n\ny"
    assert text("<article><p>in</article><p>out") == "in"
    assert text("<table><tr><td>a<td>b</tr><tr><td>c</table>").split() == ["a", "b", "c"]
    assert text("<script>never ends") == "" and text("<!-- open") == "" and text("<p") == ""
    assert text("<p>" + "<b>" * 5000 + "deep") == "deep"
    assert text("<div class='header-ads'>x</div><p>y") == "y"


def test_template_of_a_site(spark):
    def page(i):
        return f"<body><div><p>Follow us</p></div><div><p>Story {i}</p></div><p>Terms</p></body>"

    rows = [(i, "https://a.example.org/%d" % i, page(i)) for i in range(8)]
    rows += [(100 + i, "HTTP://B.example.org:80/%d" % i, page(i)) for i in range(3)]
    rows += [(200, None, page(1)), (201, "no url", page(2)), (202, "https://a.example.org", None)]
    rows += [(None, "https://a.example.org/n", ""), (0, rows[0][1], rows[0][2])]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    table = table.selectExpr("*", "1 AS host", "2 AS template", "3 AS text")
    out = html.main_text(table).collect()
    assert len(out) == len(rows)
    got = {(r.page_id, r.url): r for r in out}
    assert got[3, rows[3][1]].text == "Story 3"
    whole = "Follow us\n\nStory %d\n\nTerms"
    assert got[101, "HTTP://B.example.org:80/1"].text == whole % 1
    assert got[200, None].text == whole % 1 and got[201, "no url"].text == whole % 2
    assert got[202, "https://a.example.org"].text == "" and got[202, "https://a.example.org"].n_chars == 0
    assert all(r.n_chars == len(r.text) for r in out)
    assert html.main_text(table.limit(0)).count() == 0


def test_quoted_text_in_articles_stays(spark):
    rows = [(i, "https://a.example.org/", PAGE.format(n=i % 2)) for i in range(10)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in html.main_text(table).collect():
        assert r.text.startswith(f"Title {r.page_id % 2}") and r.text.endswith("one\n\ntwo")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_planted_articles(spark, sf):
    """The article of every test page, whole, by a plain cut at tags."""
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    texts = {r.page_id: r.text for r in html.main_text(pages).collect()}
    for r in pages.select("page_id", "html").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        article = re.sub(r"<(script|style)\b.*?</\1>", " ", article, flags=re.S)
        blocks = re.split(r"</?(?:p|h1|li|ul|div)\b[^>]*>", article)
        words = " ".join(unescape(re.sub("<[^>]*>", " ", b)) for b in blocks).split()
        assert texts[r.page_id].split() == words, r.page_id


def test_names_drop_only_what_they_name():
    def text(page):
        return html.Page(page).main_text(frozenset())

    story = "<article><h1>Title</h1><p>Body of it</p></article>"
    for name in ("site no-sidebar", "has-sidebar", "social", "header"):
        assert text(f"<div id=page class='{name}'>{story}</div>") == "Title\n\nBody of it"
    assert text("<div class='notice'><p>All there is on this page</p></div><p>End") != "End"
    assert text("<div class='related-work'><p>Kept</p></div><p>Longer than that") == "Kept\n\nLonger than that"
    cards = "<div class='related'><article class=card><p>Other</p></article></div>"
    assert text(cards + "<div><p>The text of the page itself</p></div>") == "The text of the page itself"
    assert text(f"<div class='ad-box'>Buy</div><div id=site-footer>Imprint</div>{story}") == "Title\n\nBody of it"


def test_counts_decide_inside_articles(spark):
    box = "<div class=x1><p>Get our letter every week</p><ul><li>More one<li>More two</ul></div>"
    rows = [
        (i, f"https://a.example.org/{i}", f"<body><article><h1>Title {i}</h1><p>Story number {i} it is{box}<p>End of {i}</article>")
        for i in range(40)
    ]
    # one story at many addresses, and a text beside teasers
    rows += [(100 + i, f"https://a.example.org/c{i}", "<article><h1>Same</h1><p>One story, many addresses</article>") for i in range(9)]
    cards = "".join(f"<article class=card><p>Teaser {i}</p></article>" for i in range(3))
    rows += [(200, "https://b.example.org/", f"<body><div><p>The real text of the page</p></div>{cards}")]
    out = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r.page_id: r.text for r in out.collect()}
    assert got[7] == "Title 7\n\nStory number 7 it is\n\nEnd of 7"
    assert got[104] == "Same\n\nOne story, many addresses"
    assert got[200].startswith("The real text of the page")


def test_names_of_chrome():
    """By their last word, or as parts of such a thing."""
    dropped = "main-menu top-nav page-footer related-posts ad-slot user-comments post-comments comment-body cookie_notice siteFooter".lower().split()
    for name in dropped[:-1]:
        assert html.says_drop(name), name
    for name in "has-sidebar no-footer article-header entry-header related-work story main content before-footer download header-image-caption".split():
        assert not html.says_drop(name), name
    story = "<h1>Title</h1><p>Body of the page, longer than what stands beside it</p>"
    for name in dropped[:-1]:
        page = f"<main>{story}<div class='{name}'><p>Beside</p></div></main>"
        assert html.Page(page).main_text(frozenset()) == "Title\n\nBody of the page, longer than what stands beside it"
    page = f"<article>{story}<section><article class='comment by-reader'><p>I say</p></article></section></article>"
    assert "I say" not in html.Page(page).main_text(frozenset())
    page = f"<article><div class='page-header'>{story}</div></article>"
    assert html.Page(page).main_text(frozenset()).startswith("Title")


def test_what_an_article_says_stays(spark):
    """A line that many articles of a host quote, beside a box that all of them carry."""
    box = "<div><p>Read our letter</p></div>"
    rows = [
        (i, f"https://a.example.org/{i}", f"<article><h1>Title {i}</h1><p>Often quoted line.</p><p>Story {i} of its own</p>{box}</article>")
        for i in range(30)
    ]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in html.main_text(table).collect():
        assert r.text == f"Title {r.page_id}\n\nOften quoted line.\n\nStory {r.page_id} of its own"


def test_work_grows_with_the_markup():
    import time

    def seconds(n):
        pages = ("<div>" * n + "</span>" * n, "<p>" + "<table>" + "<b>" * n + "<div></div>" * n)
        began = time.perf_counter()
        for page in pages:
            html.Page(page)
        return time.perf_counter() - began

    seconds(500)
    # sixteen times the markup: quadratic work would be 256 times as much
    assert seconds(16_000) < 60 * seconds(1_000)
