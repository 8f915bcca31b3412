import html
import re

from panelcast.llm import html_extraction as H
from panelcast.llm import queries


def test_pages_give_their_article(spark):
    """Against a plain reading of the generated pages: everything in the article element."""
    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in queries.read(spark, sf, "pages").collect()}
    got = queries.op7_html_blocks(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", article)).split())
        assert r.n_chars == len(r.text)


def test_labelled_pages_are_learned():
    for page in H.PAGES:
        want = " ".join(b.text for b in H.blocks(page) if b.marks[0])
        assert H.main_text(page) == want


def test_page_without_article_and_broken_markup():
    page = """<body><div class=menu><a href=x>Home</a></div><div id='main-content'><p>First &amp; longest paragraph of the
    text,   with white<b>space</b> and a &#233; in it.<p>Second one, unclosed<script>var a = "</p><p>no</p>";</script> after
    a script.<br>Third</div><div class="cookieNotice">We use cookies.</div><!-- <p>no</p> --><footer>End"""
    assert H.main_text(page) == (
        "First & longest paragraph of the text, with whitespace and a é in it. Second one, unclosed after a script. Third"
    )


def test_neighbours_count(spark):
    plain = "<body><p>Menu</p><p><a href=1>One</a></p>%s<p><a href=2>Two</a></p><p>The end.</p></body>"
    long = "<p>" + "This paragraph has quite a number of words and so it is taken for text here. " * 2 + "</p>"
    assert H.main_text(plain % long) == html.unescape(re.sub("<[^>]+>", "", long)).strip()


def test_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "   "), (None, "u", "<article>x</article>"), (4, "u", "<p"), (5, "u", "a < b & c &am &nosuch;"),
            (6, "u", "<article>" + "<p>word word</p>" * 20000 + "</article>"), (1, "u", "<article>again</article>")]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = [(r.page_id, r.text[:12], r.n_chars) for r in H.extract_main_text(pages).collect()]
    assert got[:4] == [(1, "", 0), (2, "", 0), (3, "", 0), (None, "x", 1)] and got[6][2] == 20000 * 10 - 1 and got[7][1] == "again"
    assert H.extract_main_text(pages.limit(0)).collect() == []


def test_self_closing_and_unclosed_elements_swallow_nothing():
    for tag in ("<svg viewBox='0 0 1 1'/>", "<svg/>", "<math />", "<iframe src='x' />", "<object data=x>", "<noscript>", "<template>"):
        page = f"<body><article><p>One {tag} two.</p><p>Three.</p></article><footer>End</footer></body>"
        assert H.main_text(page) == "One two. Three."
    page = "<article><p>One <svg/> two <svg><text>no</text></svg> three.</p></article>"
    assert H.main_text(page) == "One two three."
    assert H.main_text("<article><p>One</p><script>no <p>no</p></article>") == "One"


def test_hints_of_the_layout_are_not_the_articles():
    text = "<h1>Title</h1><p>First words.</p><p>Then some more of them.</p>"
    for frame in (
        '<body class="has-sidebar"><article>%s</article></body>',
        '<html class="cookie"><body class="menu sidebar"><article>%s</article></body></html>',
        '<body><div class="content with-sidebar">%s</div></body>',
        '<body><div class="content-with-sidebar">%s</div></body>',
        '<body><div class="content hasSidebar">%s</div></body>',
    ):
        assert H.main_text(frame % text) == "Title First words. Then some more of them."
    assert H.main_text('<body><article><p>Text.</p><div class="sidebar"><p>Other words here.</p></div></article></body>') == "Text."
