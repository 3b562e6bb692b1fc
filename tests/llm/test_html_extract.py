import re
from html.parser import HTMLParser

import pytest
from govlake.llm.html_extract import extract, main_text, op2_html_extract


class Article(HTMLParser):
    """The blocks of the article element, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.depth, self.blocks = 0, [[]]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag in ("p", "h1", "article"):
            self.blocks.append([])
        if tag == "br":
            self.blocks[-1].append(" ")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag in ("p", "h1", "article"):
            self.blocks.append([])

    def handle_data(self, data):
        if self.depth:
            self.blocks[-1].append(data)

    def text(self):
        return "\n".join(x for x in (" ".join("".join(b).split()) for b in self.blocks) if x)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_pages_match_the_article(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").collect()}
    out = op2_html_extract(spark, f"/root/testdata/{sf}").collect()
    assert len(out) == len(pages)
    for r in out:
        p = Article()
        p.feed(pages[r.page_id].html)
        p.close()
        assert r.text == p.text() and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


LONG = "A sentence of the article that is long enough to stand for itself, with some more words in it."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<p></p>", ""), ("<html><body></body></html>", ""),
        ("<body><article><h1>T</h1><p>a&amp;b &lt;p&gt; &eacute;&#8364;</p></article></body>", "T\na&b <p> é€"),
        ("<nav>menu<p>x</p></nav><main><p>a\n  b\t<b>c</b>d</p><aside>x</aside><p>e</p></main><footer>f</footer>", "a b cd\ne"),
        ('<div class="ad">buy</div><article><p>a</p><div class="cookie-notice"><div>x</div>y</div><p>b</p><section id="comments"><p>c</p></section></article>', "a\nb"),
        ("<article><p>a<script>if (a < b) { '</p>' }</script>b<style>p{}</style></p><!-- <p>x</p> --><form><p>f</p></form>c</article>", "ab\nc"),
        ("<header><h1>Site</h1></header><article><header><h1>T</h1></header><p>b</p></article>", "T\nb"),
        ("<nav><ul><li>x<article><p>a</p></article>", "a"),
        ("<article><p>a <b>b<p>c<br>d</article><footer>f", "a b\nc d"),
        ("<article><p title='a>b' data-x=\"<p>\">t</p><p hidden>h</p><p style='display: none'>n</p></article>", "t"),
        ("<article><p>1 < 2 and <3</p><a href=\"x>link</a></article>", "1 < 2 and <3\nlink"),
        (f"<ul><li><a href=x>Home</a><li><a href=y>News</a></ul><div><p>Short.</p><p>{LONG}</p><p>End.</p></div><div id=footer>x</div><p>Legal</p>", f"Short.\n{LONG}\nEnd."),
        ("<article>a <b>b <i c <!-- d", "a b <i c"), ("<article>a<!-- b <p>c", "a"),
        ("<article>" + "<p>x</p>" * 3000 + "</article>", "\n".join(["x"] * 3000)),
    ],
)
def test_markup(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<article><p class="ad">Buy<p>Real text<p>More</article>', "Real text\nMore"),
        ('<article><p class="ad">Buy<div>Real</div><p>More</article>', "Real\nMore"),
        ('<article><ul><li class="ad">Buy<li>Real</ul><p>More</article>', "Real\nMore"),
        ('<article><ul><li>Real<li class="ad">Buy<ul><li>x<li>y</ul></ul><p>More</article>', "Real\nMore"),
        ('<article><dl><dt class="ad">Buy<dd>Real<dd class="ad">Buy</dl>More</article>', "Real\nMore"),
        ('<article><table><tr class="ad"><td>Buy<tr><td>Real<tr><td class="ad">Buy<td>Most</table>More</article>', "Real\nMost\nMore"),
        ('<article><section><p>Real<p class="ad">Buy</section><p>More</article>', "Real\nMore"),
    ],
)
def test_removed_elements_without_end_tags(page, text):
    assert main_text(page) == text


NOTE = "<body><h1>Title</h1><p>Short text of a brief note.</p></body>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (NOTE, "Title\nShort text of a brief note."),
        (NOTE + "<nav>x</nav><p>(c) Acme</p>", "Title\nShort text of a brief note."),
        (f'<div class="layout no-sidebar"><h1>T</h1><p>{LONG}</p></div><div class="sidebar"><p>{LONG}</p></div>', f"T\n{LONG}"),
        (f'<div class="post has-comments"><h1>T</h1><p>{LONG}</p><div class="comments"><p>{LONG}</p><p>{LONG}</p></div></div>', f"T\n{LONG}"),
        (f'<div class="ad-hoc"><p>{LONG}</p><p>{LONG}</p></div><div class="ad-leaderboard">Buy</div>', f"{LONG}\n{LONG}"),
        (f'<div class="content-sidebar"><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div><div class="ads">Buy</div>', f"T\n{LONG}\n{LONG}"),
        (f'<main><p title="the hidden cost">{LONG}</p><p hidden>x</p><p HIDDEN="">y</p><p data-hidden=1>End.</p></main>', f"{LONG}\nEnd."),
        (f'<p>{LONG}</p><p class="share-price">It rose.</p><p class="share-bar">Tell a friend</p><p>End.</p>', f"{LONG}\nIt rose."),
        (f'<article><p>{LONG}</p><p class="share-price">It rose.</p><p class="share-it"><a href=x>Tell a friend</a></p><p>End.</p></article>', f"{LONG}\nIt rose.\nEnd."),
        (f'<article><h1>T</h1><p>Short.</p><section class="comments"><p>{LONG}</p><p>{LONG}</p></section></article>', "T\nShort."),
    ],
)
def test_classes_are_evidence_only(page, text):
    assert main_text(page) == text


def test_the_distribution_decides_without_article_markup():
    page = f"<p>Legal</p><nav>x</nav><p>{LONG}</p><p>{LONG}</p><nav>x</nav><p>A caption of a picture, of medium length.</p><nav>x</nav><p>Top</p>"
    assert main_text(page) == f"{LONG}\n{LONG}"
    assert main_text(page, surge=20) == f"{LONG}\n{LONG}\nA caption of a picture, of medium length."
    assert main_text(page, surge=0) == f"Legal\n{LONG}\n{LONG}\nA caption of a picture, of medium length.\nTop"
    lines = "".join(f"<p>Line {k} here</p>" for k in range(9))
    assert main_text(f"{lines}<nav>x</nav><p>{LONG}</p><nav>x</nav>") == LONG
    assert main_text(f"{lines}<nav>x</nav><p>{LONG}</p><nav>x</nav>", width=6).startswith("Line 0")


def test_hostile_markup_is_linear():
    for page in ("<" * 50000, "<a " * 20000, '<a b="' * 20000, "<!--" * 20000, "<article>" * 5000 + "x", "<div class=ad>" * 20000, "<div class=ad><h1>" * 5000, "<div class=ad-x>a" * 20000):
        main_text(page)


def test_odd_rows(spark):
    rows = [(1, None, None, "t"), (None, "u", "<article>a</article>", "t"), (2, "u", "", "t"), (2, "u", "", "t"), (3, "u", "<article><p>" + "wört " * 200000 + "</article>", "t")]
    out = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in out) == [(0, 1), (1, 0), (2, 0), (2, 0), (3, 999999)]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert not re.search("<", "".join(r.text for r in out))
